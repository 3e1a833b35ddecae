import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import centroids, language, merkle
from tidemark.llm.common import read_table

# -- centroids ---------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dimensions, scale, seed=1):
    """Every distance of every vector, with unbounded integers."""
    kept = []
    for name, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            n = [math.floor(scale * x) for x in v]
            if max(map(abs, n)) <= centroids.LARGEST:
                kept.append((name, n))
    starts = sorted((hashlib.sha256(f"{seed}:{name}".encode()).hexdigest(), n) for name, n in kept if name is not None)[:k]
    middle = [n for _, n in starts]

    def nearest(n):
        return min((sum((a - b) ** 2 for a, b in zip(n, c, strict=True)), i) for i, c in enumerate(middle))

    for _ in range(rounds if middle else 0):
        own = [nearest(n)[1] for _, n in kept]
        for c in set(own):
            members = [n for (_, n), o in zip(kept, own, strict=True) if o == c]
            middle[c] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    return sorted((repr(name), *reversed(nearest(n))) for name, n in kept if middle), middle


def clustered(spark, rows, kind="float", **options):
    found = centroids.cluster_vectors(spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, cluster string").drop("cluster"), **options)
    return sorted((repr(r.vec_id), r.cluster, r.distance) for r in found.rows.collect()), found.centroids.tolist()


@pytest.mark.parametrize("width", [1, 2, 3, 8])
def test_clusters_equal_plain(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, rng.normal(0, 1, 7).round(3).tolist(), "") for i in range(300)] + [(1000 + i, [0.5] * 7, "") for i in range(150)]
    want = plain_clusters([r[:2] for r in rows], 5, 3, 7, 64)
    assert clustered(spark, rows, "double", k=5, dimensions=7, width=width, chunk=64) == want


def test_clusters_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2], ""), (1, [0.9, 0.2], ""), (2, None, ""), (3, [], ""), (4, [1.0], ""), (5, [nan, 1.0], ""), (6, [inf, 1.0], ""), (7, [None, 1.0], "")]
    rows += [(None, [5.0, 5.0], ""), (8, [1e300, 0.0], ""), (9, [-0.001, -0.5], ""), (10, [2.0e6, -2.0e6], "")]
    for k in (1, 2, 9):
        assert clustered(spark, rows, "double", k=k, dimensions=2) == plain_clusters([r[:2] for r in rows], k, 3, 2, 64)
    assert clustered(spark, [], dimensions=2) == ([], [])
    assert clustered(spark, [(None, [1.0, 1.0], "")], dimensions=2) == ([], [])


def test_inertia_is_per_cluster_and_in_all(spark):
    found = centroids.cluster_vectors(spark.createDataFrame([(i, [float(i), 0.0]) for i in range(20)], "vec_id int, embedding array<double>"), k=3, dimensions=2)
    rows = centroids.with_inertia(found).collect()
    assert len(rows) == 20 and {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    for r in rows:
        assert r.cluster_inertia == sum(o.distance for o in rows if o.cluster == r.cluster)


@given(st.lists(st.lists(st.integers(-(1 << 27), 1 << 27), min_size=5, max_size=5), min_size=1, max_size=30), st.integers(1, 5))
@settings(max_examples=50, deadline=None)
def test_dictionaries_lose_nothing(rows, width):
    numbers = np.array(rows, np.int64)
    chunk = centroids.Chunk(len(rows), *centroids.encode_chunk(numbers, width), 5, width)
    assert np.concatenate([d[c] for d, c in zip(chunk.dictionaries, chunk.codes, strict=True)], axis=1).tolist() == rows
    cluster, distance = chunk.nearest(numbers[:3])
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(r, c, strict=True)), i) for i, c in enumerate(numbers[:3].tolist())) for r in rows]
    assert [(int(d), int(c)) for c, d in zip(cluster, distance, strict=True)] == want


# -- merkle ------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_root(nodes, arity, at=None):
    """The root over ``nodes`` and the siblings of node ``at`` up to it."""
    siblings = []
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        if at is not None:
            own, place = runs[at // arity], at % arity
            siblings.append(("".join(own[:place]), "".join(own[place + 1 :])))
            at //= arity
        nodes = [sha("".join(r)) for r in runs]
    return nodes[0], siblings


def plain_manifest(docs, arity):
    rows = []
    for d in docs:
        doc_id, text, lang, source, n = d
        low = text
        if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        rows.append((doc_id, source, leaf_of([doc_id, source, lang, n, text]), leaf_of([doc_id, source, lang, n, low])))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    order = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for s in sources}
    subs = [plain_root([r[2] for r in order[s]], arity)[0] for s in sources]
    out = []
    for place, s in enumerate(sources):
        for at, (doc_id, _, leaf, now) in enumerate(order[s]):
            sub, low = plain_root([r[2] for r in order[s]], arity, at)
            root, high = plain_root(subs, arity, place)
            folded = merkle.fold(now, low + high)
            out.append((doc_id, leaf, sub, root, merkle.proof_digest(low + high), folded, folded == root))
    return sorted(out, key=repr)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, key string, grp string"


@pytest.mark.parametrize(("arity", "height"), [(2, 1), (2, 3), (3, 2), (16, 3)])
def test_manifest_equals_plain(spark, arity, height):
    docs = [(i, f"Text {i} É\nB", "en" if i % 3 else None, f"s{i % 7}" if i % 4 else "big", i) for i in range(150)]
    docs += [(i, "x", "en", None, None) for i in range(200, 260)] + [(5, "Text 5 É\nB", "en", "s5", 5)] * 2
    docs += [(None, "No id", None, "s1", 1), (300, None, None, "", None), (301, "", "", "é", 0), (302, "A" * 100_000, "en", "Z", 9)]
    frame = spark.createDataFrame([(*d, "a", "b", "c") for d in docs], DOCS)
    found = sorted((tuple(r) for r in merkle.check_documents(frame, height, arity).collect()), key=repr)
    assert found == plain_manifest(docs, arity)
    assert {f[-1] for f in found} == {True, False}


def test_manifest_of_little(spark):
    assert merkle.check_documents(spark.createDataFrame([], DOCS)).count() == 0
    one = merkle.check_documents(spark.createDataFrame([(7, "t", "l", "s", 1, None, None, None)], DOCS)).collect()
    leaf = leaf_of([7, "s", "l", 1, "t"])
    assert [tuple(r) for r in one] == [(7, leaf, leaf, leaf, sha(""), leaf, True)]


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_layout_is_dense_and_starts_with_the_upper_half(arity):
    for height in range(5 if arity < 16 else 3):
        for leaves in sorted({1, 2, arity, arity + 1, arity**height // 2 + 1, arity**height}):
            if leaves > arity**height:
                continue
            places = [merkle.address(leaves, height, level, np.arange(-(-leaves // arity**level)), arity) for level in range(height + 1)]
            assert sorted(np.concatenate(places).tolist()) == list(range(merkle.node_count(leaves, height, arity)))
            assert places[height].tolist() == [0]
            for level in range((height - 1) // 2 + 1, height + 1):
                tops = sum(len(p) for p in places[(height - 1) // 2 + 1 :])
                assert not height or max(places[level]) < tops


def test_lower_subtrees_are_stored_together():
    # Four levels: an upper tree of two levels, then lower trees of two levels, each one piece of 17 nodes.
    leaves = merkle.address(4096, 3, 0, np.arange(4096))
    parents = merkle.address(4096, 3, 1, np.arange(256))
    assert parents.tolist() == [17 + 17 * i for i in range(256)]
    assert leaves[:16].tolist() == list(range(18, 34)) and leaves[16] == 35


# -- language ----------------------------------------------------------------------


def plain_language(train, docs):
    """Dictionaries and sums of logarithms, one word at a time."""
    langs = sorted({lang for lang, _ in train}, key=str.encode)
    words = {lang: Counter(w for name, t in train if name == lang for w in language.words_of(t)) for lang in langs}
    grams = {n: {lang: Counter(g for w in words[lang] for g in language.ngrams_of(w, n)) for lang in langs} for n in range(1, language.LONGEST + 1)}

    def logs(tables, key):
        size = len(set().union(*tables.values()))
        return np.array([math.log((tables[name][key] + language.SMOOTHING) / (sum(tables[name].values()) + language.SMOOTHING * size)) for name in langs])

    def score(word):
        if any(words[name][word] for name in langs):
            return logs(words, word)
        for n in range(language.LONGEST, 0, -1):
            found = [g for g in language.ngrams_of(word, n) if any(grams[n][name][g] for name in langs)]
            if found:
                return sum(logs(grams[n], g) for g in found) / len(found)
        return np.zeros(len(langs))

    share = Counter(name for name, _ in train)
    prior = np.array([math.log(share[name] / len(train)) for name in langs])
    out = []
    for text in docs:
        own = language.words_of(text)
        if not own:
            out.append(("und", 0.0))
            continue
        total = prior + sum(score(w) for w in own)
        soft = np.exp((total - total.max()) / math.sqrt(len(own)))
        out.append((langs[int(total.argmax())], float(soft.max() / soft.sum())))
    return out


def test_language_equals_plain(spark):
    train = [("en", "the cat and the dog"), ("en", "a house by the sea"), ("de", "der Hund und die Katze"), ("de", "ein Haus am Meer"), ("fr", "le chien est là")]
    train += [("en", "the hound")] * 3
    texts = ["the dog", "Hund und Hütte", "thecat", "chienne", "xyzzyq", "ΨΩ", "", None, "12 ² ½ !", "là là the", "the " * 5000 + "und", "a\x00b"]
    frame = spark.createDataFrame([(i, t, "x", 0.5) for i, t in enumerate([t for _, t in train])], "doc_id int, text string, lang_pred string, score double")
    named = frame.withColumn("lang", F.element_at(F.array(*[F.lit(n) for n, _ in train]), F.col("doc_id") + 1))
    unlearned = spark.createDataFrame([(90, "das das das", None), (91, None, "de"), (92, "123", "pt")], "doc_id int, text string, lang string")
    # Copies of a text are read once, but count for the share of their language.
    model = language.learn(named.unionByName(unlearned, allowMissingColumns=True))
    assert model.languages == ["de", "en", "fr"]
    distinct = list(dict.fromkeys(train))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: r for r in language.predict(docs, model).collect()}
    want = plain_language(distinct, texts)
    share = Counter(n for n, _ in train)
    assert np.allclose(model.priors, [math.log(share[n] / len(train)) for n in model.languages])
    model.priors = np.log(np.array([Counter(n for n, _ in distinct)[n] for n in model.languages]) / len(distinct))
    for r, (lang, score) in zip(sorted(language.predict(docs, model).collect(), key=lambda r: r.doc_id), want, strict=True):
        assert r.lang_pred == lang and abs(r.score - score) < 1e-3
    assert found[6].lang_pred == found[7].lang_pred == found[8].lang_pred == "und" and found[7].score == 0


def test_nothing_learned_is_undetermined(spark):
    empty = spark.createDataFrame([], "doc_id int, text string, lang string")
    model = language.learn(empty)
    docs = spark.createDataFrame([(1, "some text"), (None, "more"), (1, None)], "doc_id int, text string")
    assert {r.lang_pred for r in language.predict(docs, model).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


def test_rows_learned_from_are_bounded(spark):
    rows = [(i, f"word{i} same text", "en") for i in range(50)] + [(100 + i, "kopie der kopie", "de") for i in range(80)] + [(1000, "x" * 5000, "fr")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    taken, shares = language.training_rows(frame, max_rows=10, max_chars=1000)
    assert Counter(r.lang for r in taken.collect()) == {"en": 10, "de": 1} and shares == {"en": 50, "de": 80, "fr": 1}
    taken, _ = language.training_rows(frame, max_rows=1000, max_chars=40)
    assert all(sum(len(r.text) for r in taken.collect() if r.lang == n) <= 40 for n in ("en", "de", "fr"))


def test_held_out_languages_are_found(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    docs = read_table(spark, folder, "documents")
    out = language.held_out(F.col("doc_id"))
    model = language.learn(docs.where(~out))
    right = language.predict(docs.where(out), model).join(docs, "doc_id").select((F.col("lang") == F.col("lang_pred")).alias("ok")).collect()
    assert sum(r.ok for r in right) >= 0.97 * len(right)
