import hashlib
import math
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import decontaminate, line_dedup, ngram_join, secrets, toxicity
from tidemark.session import folder_names, shared_dir

SCHEMA = "doc_id bigint, text string, hashes string, size string, component_id string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "h", "s", "c") for i, t in rows], SCHEMA)


LONG = "A line of more than twenty characters"
DOCS = [
    (1, f"one\n{LONG}\nshort"), (2, f" {LONG.upper()}\t\nshort"), (3, f"{LONG}\nshort\n"), (4, None), (5, ""), (None, f"{LONG}\nx"),
    (6, "twice in two documents, no more\nb"), (7, "Twice in two documents, no more"), (1, f"one\n{LONG}\nshort"), (8, "é" * 19 + "\n" + "ü" * 20), (9, "ü" * 20), (10, "ü" * 20),
]


def plain_lines(docs):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    owners = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                owners[key(line)].add(i)
    last = {k: max((o for o in own if o is not None), default=None) for k, own in owners.items() if len(own) >= 3}
    return sorted(
        ((i, "\n".join(x for x in (t or "").split("\n") if not (key(x) in last and i != last[key(x)]))) for i, t in docs), key=repr
    )


@pytest.mark.parametrize("batches", [1, 4])
def test_lines_against_brute_force(spark, batches):
    got = line_dedup.kept_lines(frame(spark, DOCS), batches=batches, fanout=2).select("doc_id", "_lines.*").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == plain_lines(DOCS)
    assert {r.doc_id: (r.n_lines, r.n_dropped) for r in got}[2] == (2, 1)


def test_lines_keep_rows_and_columns(spark):
    docs = frame(spark, DOCS)
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == len(DOCS)
    assert out.where("doc_id = 4").first().text is None
    assert line_dedup.drop_repeated_lines(frame(spark, [])).count() == 0


def test_new_lines_of_each_batch(spark):
    runs = line_dedup.LineRuns(spark, buckets=2, fanout=2)
    first = spark.createDataFrame([(1, 10, 10), (2, 10, 10), (1, 20, 20)], "doc_id bigint, h1 bigint, h2 bigint")
    assert sorted((r.h1, r.docs) for r in runs.add(first).collect()) == [(10, 2), (20, 1)]
    assert [r.h1 for r in runs.add(first.unionByName(spark.createDataFrame([(5, 30, 30)], first.schema))).collect()] == [30]
    assert len(runs.levels) == 2 and not runs.levels[0]
    assert [(r.h1, r.docs, r.last_doc) for r in runs.repeated(4).collect()] == [(10, 4, 2)]
    runs.forget()


def entropy(text):
    return -sum(c / len(text) * math.log2(c / len(text)) for c in Counter(text).values())


def test_entropy_windows_against_brute_force():
    for run in ("04dbebab91ab85687d33eeaaf9ac699e1188f962", "aaaaaaaaaaaaaaaaaaaaaaaa0b1c2d3e4f5a6b7c8d9e0f1a2b3c4d5e", "q7Zk2Lm9Xv4Tb8Nw3Rc6Yh1J" * 2):
        for window, level in ((20, 3.2), (24, 3.0)):
            hit = [k for k in range(len(run) - window + 1) if entropy(run[k : k + window]) >= level - 1e-9]
            marked = sorted({p for k in hit for p in range(k, k + window)})
            got = sorted({p for a, b in secrets.entropy_spans(run, window, level) for p in range(a, b)})
            assert got == marked


def test_base_patterns():
    text = 'Password: "abcd1234" token=short SECRET = x.y-z_1+/= AKIAABCDEFGHIJKL0 AKIA12 ' + "0123456789abcdef" * 2 + " paſſword=abcdefgh1"
    found = secrets.base_spans(text)
    assert [(k, text[a:b]) for k, a, b in found] == [
        ("assign", 'Password: "abcd1234'), ("assign", "SECRET = x.y-z_1+/="), ("access", "AKIAABCDEFGHIJKL0"), ("hex", "0123456789abcdef" * 2),
    ]
    # A first match that is too short uses its text up.
    assert secrets.base_spans("password=secret:abcdefgh12345") == []


def test_keys_glued_to_names():
    import random

    draw = random.Random(7)

    def key(symbols, size):
        return "".join(draw.choice(symbols) for _ in range(size))

    for symbols, sizes in (("0123456789ABCDEF", (40, 24, 22)), ("0123456789abcdef", (24, 31, 20))):
        for size in sizes:
            for before in ("", "url?sig=", "id-", "path/", "name_"):
                found = 0
                for _ in range(200):
                    text = f"see {before}{(own := key(symbols, size))} now"
                    low = text.index(own, 4 + len(before))
                    found += any(a < low + size and b > low for _, a, b in secrets.method_spans(text))
                assert found >= 190, (symbols, size, before, found)
    groups = ["sk-" + "-".join(key("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 11) for _ in range(4)) for _ in range(100)]
    assert sum(bool(secrets.method_spans(g)) for g in groups) >= 95
    harmless = ["path/to/file12/page-2024-01-02", "user-profile-camelCase-v2-page12", "orders/order-123456789012", "docs/release-notes/version-2024/en"]
    assert all(secrets.method_spans(t) == [] for t in harmless)
    # One class a stretch: a key alone is reported once.
    assert [k for k, _, _ in secrets.method_spans("04dbebab91ab85687d33eeaaf9ac699e1188f962")] == ["entropy_hex"]


def test_secrets_of_documents(spark):
    key = "q7Zk2Lm9Xv4Tb8Nw3Rc6Yh1J"
    docs = [(1, f"é use {key} now"), (2, None), (3, ""), (None, "id 123e4567-e89b-12d3-a456-426614174000"), (4, "antidisestablishmentarianism"), (5, "api_key=abcdefgh1 " * 3)]
    rows = {r.doc_id: r for r in secrets.span_counts(secrets.find_secrets(frame(spark, docs))).collect()}
    assert rows[1].spans == f"entropy_alnum:6:{6 + len(key)}" and rows[1].base_spans == ""
    assert all(rows[i].spans == "" for i in (2, 3, None, 4))
    assert rows[5].n_assign == 3 and rows[5].base_spans.split(",")[1] == "assign:18:35"
    assert [r.text for r in secrets.redact(frame(spark, docs[:2])).orderBy("doc_id").collect()] == ["é use [secret] now", None]
    assert secrets.find_secrets(frame(spark, [])).count() == 0


def plain_components(docs, percent=80):
    sets = {}
    for i, text in docs:
        words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        n = min(5, len(words))
        sets[i] = {" ".join(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies():
    """Chains of copies with one more word changed each, copies of a base, short texts and a shared passage."""
    words = [f"w{k}" for k in range(120)]
    docs, at = [], 0
    for k in range(12):
        own = list(words)
        for j in range(k):
            own[10 * j] = f"new{j}"
        docs.append((at := at + 1, " ".join(own)))
    for k in range(30):
        own = [f"b{j}" for j in range(90)]
        own[3 * (k % 28)] = f"edit{k}"
        docs.append((at := at + 1, " ".join(own)))
    passage = " ".join(f"p{j}" for j in range(40))
    for k in range(20):
        docs.append((at := at + 1, passage + " " + " ".join(f"u{k}x{j}" for j in range(5 + k))))
    return [*docs, (100, "a B"), (101, "A b"), (102, "a b c"), (103, ""), (104, None), (105, " \n"), (106, words[0]), (107, docs[0][1].upper())]


def test_components_against_brute_force(spark):
    docs = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_components(frame(spark, docs)).collect()}
    assert got == plain_components(docs)


def test_products_of_blocks(monkeypatch):
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.integers(0, 60, k)).astype(np.int64) for k in (0, 1, 30, 40, 50, 60, 40)]
    monkeypatch.setattr(ngram_join, "WIDTH", 7)
    got = ngram_join.overlaps(sets[:4], sets[2:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[2:]] for a in sets[:4]]
    assert not ngram_join.overlaps(sets[:1], sets[:1]).any()
    links = np.array([[True, False, False], [True, True, False], [False, False, False]])
    assert ngram_join.reached(links, np.array([9, 5, 7]), np.array([6, 8, 1])) == [(6, 5), (8, 5), (9, 5)]


def test_large_columns_against_brute_force(spark, monkeypatch):
    # Columns of four members are large here, blocks hold about three documents, and one pivot leaves much apart.
    monkeypatch.setattr(ngram_join, "HOT", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    met = []
    own = ngram_join.block_links
    monkeypatch.setattr(ngram_join, "block_links", lambda owners, *rest: (met.append(owners.count()), own(owners, *rest))[1])
    docs = near_copies()
    passage = [f"q{j}" for j in range(60)]
    for k in range(40):
        words = list(passage)
        for j in range(k % 4):
            words[(7 * k + 13 * j) % 60] = f"z{k}x{j}"
        docs.append((200 + k, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_components(frame(spark, docs), pivots=1).collect()}
    assert got == plain_components(docs) and met[0] > 10


def test_one_of_each_group_stays(spark):
    docs = [(5, "one two three four five six"), (3, "One two three four five SIX"), (None, "one two three four five six"), (4, None), (4, None)]
    out = ngram_join.keep_one(frame(spark, docs))
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [3, 4, 4, None]
    assert out.columns == frame(spark, docs).columns
    assert ngram_join.keep_one(frame(spark, [])).count() == 0


def test_one_row_of_each_group_stays(spark):
    one, two = "one two three four five six", "other words that no other row has"
    docs = [(7, one), (7, one), (7, two), (5, one), (None, one), (None, one.upper()), (9, two + " here"), (8, None), (8, None), (3, "a b"), (3, "a b")]
    out = ngram_join.keep_one(frame(spark, docs))
    assert sorted(((r.doc_id, r.text and r.text.lower()) for r in out.collect()), key=repr) == sorted(
        [(5, one), (7, two), (None, one), (9, two + " here"), (8, None), (8, None), (3, "a b")], key=repr
    )
    assert out.columns == frame(spark, docs).columns


ITEMS = [
    (1, "What is the tallest tower of the old harbour town? Answer: the lantern of saint elmo"),
    (2, "Name the river that crosses seven borders before it meets the northern sea.\nIt is called the long grey wanderer"),
    (3, None),
    (4, ""),
    (None, "Which insect sings only in the warmest week of august? The copper cicada"),
    (5, " ".join(f"step{k} of the long proof" for k in range(40))),
]


def test_leaks(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    filler = " ".join(f"word{k}" for k in range(150))
    docs = [
        (1, f"{filler} {ITEMS[0][1].upper()}!! {filler}"), (2, filler), (3, None), (4, ""), (5, ITEMS[1][1].split("\n")[0] + " " + filler),
        (6, filler + " " + ITEMS[4][1]), (7, f"{filler} {filler} {ITEMS[5][1]} {filler}"), (None, ITEMS[1][1].replace(" ", "\n")), (8, "the of a it is " * 300),
    ]
    rows = decontaminate.find_leaks(spark, frame(spark, docs), items).collect()
    assert sorted(((r.doc_id, r.item_id) for r in rows), key=repr) == sorted([(1, 1), (6, None), (7, 5), (None, 2)], key=repr)
    left = decontaminate.drop_leaked(spark, frame(spark, docs), items)
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 5, 8] and left.columns == frame(spark, docs).columns
    assert decontaminate.find_leaks(spark, frame(spark, []), items).count() == 0
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_leaks(spark, frame(spark, docs), none).count() == 0
    assert decontaminate.drop_leaked(spark, frame(spark, docs), none).count() == len(docs)


def test_short_answers_are_no_condition(spark):
    split = decontaminate.question_answer
    assert split("Who built the old harbour? A: the two masons") == (b"who built the old harbour".split(), b"the two masons".split())
    assert split("Who built the old harbour? A: masons") == (b"who built the old harbour".split(), [])
    assert split("The harbour is old. Very") == (b"the harbour is old very".split(), [])
    item = "Seven lanterns burn above the old harbour wall until the first boat leaves at dawn. Quietly."
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    filler = " ".join(f"word{k}" for k in range(150))
    docs = [(1, f"{filler} {item.removesuffix(' Quietly.')} {filler}"), (2, f"{filler} {item} {filler}"), (3, filler)]
    assert sorted(r.doc_id for r in decontaminate.find_leaks(spark, frame(spark, docs), items).collect()) == [1, 2]


def test_wand_finds_all_that_a_full_scan_finds(spark, small):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    index = next(decontaminate.build_index(items, threshold=0.3))
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    calls = []
    wand = index.wand
    index.wand = lambda terms, blocks: calls.append((terms, blocks, wand(terms, blocks))) or calls[-1][2]
    index.search(texts)
    for terms, _, found in calls:
        scores = {}
        for t in terms:
            for unit, weight in zip(*index.lists[t][:2], strict=True):
                scores[unit] = scores.get(unit, 0) + weight
        assert {u for u, s in scores.items() if s >= 0.3 - 1e-9} == {u for u, _ in found}
        assert all(abs(scores[u] - s) < 1e-9 for u, s in found)
    assert calls


def test_marginals_equal_a_full_chain():
    import numpy as np

    field = toxicity.Field({"bad": 4.0, "worse": 5.0, "mild": -1.0}, -2.0, np.array([0.3, -0.4]), np.array([[0.5, -0.3], [-0.7, 0.9]]), np.array([-3.0, 4.0, 1.0]))
    for text in ("a b bad c worse d e f g mild h i", "bad", "bad bad x", "x y z bad", "q bad " + "x " * 30 + "worse z"):
        words = toxicity._words(text)
        p = field.potentials(words)
        whole, _, _ = toxicity._marginals(np.array([p]) + field.bias, np.ones((1, len(p)), bool), field.start, field.pairs)
        active, got, _ = field.marginals(p)
        assert np.allclose(got, whole[0][active], atol=1e-6)


def test_toxic_documents(spark):
    clean = "the quiet garden was full of early light and slow birds"
    docs = [(k, f"{clean} {k} {'you rotten maggot, what a vile toad' if k % 4 == 0 else 'and rain'} {clean}") for k in range(240)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)] + [(None, 1), (7, None), (999, 1)], "doc_id bigint, toxic int")
    field = toxicity.train(toxicity.train_rows(spark, frame(spark, docs), labels))
    more = [*docs, (300, None), (301, ""), (None, "vile toad, rotten maggot"), (302, "12 34")]
    rows = toxicity.score_documents(frame(spark, more), field).collect()
    scores = {r.doc_id: r for r in rows}
    assert all((scores[k].score >= 0.3) == (k % 4 == 0) for k in range(240))
    assert scores[None].score >= 0.3 and all(scores[k].score < 0.3 and scores[k].spans == "" for k in (300, 301, 302))
    start, end = map(int, scores[0].spans.split(",")[0].split(":"))
    assert "maggot" in docs[0][1][start:end] or "rotten" in docs[0][1][start:end]
    left = toxicity.drop_toxic(frame(spark, more), field)
    assert {r.doc_id for r in left.collect()} == {k for k in range(240) if k % 4} | {300, 301, 302}
    nothing = toxicity.train(toxicity.train_rows(spark, frame(spark, docs), labels.limit(0)))
    assert toxicity.drop_toxic(frame(spark, more), nothing).count() == len(more)


def test_scores_mean_the_same_above_and_below_the_sample(spark):
    """Eight clean documents to one toxic; the weak word is in a tenth of the clean ones and in all toxic ones."""
    def text(k):
        weak = "sour " if k % 9 == 0 or k % 10 == 0 else ""
        return f"number {k} {weak}{'rotten ' if k % 9 == 0 and k % 2 else ''}garden of early light {k}"

    texts = spark.createDataFrame([(k, text(k), int(k % 9 == 0)) for k in range(1800)], "doc_id bigint, text string, toxic int")
    asked = frame(spark, [(1, "a sour garden"), (2, "a sour rotten garden"), (3, "a garden")])

    def scores(max_docs):
        field = toxicity.train(texts, max_docs=max_docs, min_odds=4.0)
        return {r.doc_id: r.score for r in toxicity.score_documents(asked, field).collect()}

    every, some = scores(1600), scores(200)
    assert all(abs(every[k] - some[k]) < 0.06 for k in every), (every, some)


def test_training_reads_whole_texts(spark):
    """Toxic spans lie far behind a first weak word; long clean texts hold many weak words."""
    plain = "the quiet garden was full of early light and slow birds "
    docs = []
    for k in range(360):
        toxic = k % 4 == 0
        weak = [f"sour {plain * 4}"] * (30 if k % 12 == 1 else 1 if toxic or k % 40 == 1 else 0)
        docs.append((k, f"{k} {''.join(weak)}{plain * 50}{'vile rotten maggot' if toxic else 'rain'} {plain}", int(toxic)))
    texts = spark.createDataFrame(docs, "doc_id bigint, text string, toxic int")
    field = toxicity.train(texts, min_odds=1.5, min_z=2.0)
    assert field.weights["maggot"] > 0.5
    rows = toxicity.score_documents(frame(spark, [(k, text) for k, text, _ in docs]), field).collect()
    assert {r.doc_id for r in rows if r.score >= 0.3} == {k for k, _, toxic in docs if toxic}


def test_stretches_hold_every_marked_word():
    words, marked = [f"w{k}" for k in range(3000)], [0, 5, 30, 500, 523, 524, 2999]
    parts = toxicity.stretches(words, marked)
    assert {w for part in parts for w in part if w} == {words[k] for k in marked} and max(map(len, parts)) == toxicity.STRETCH
    assert toxicity.stretches([], []) == []


def test_hash_of_keys_is_of_utf8():
    assert line_dedup.key_hash(line_dedup.line_key(" ÄB c ")) == hashlib.blake2b("Äb c".encode(), digest_size=16).digest()


def test_tables_of_columns_are_gone_before_blocks_are_made(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 300}" for k in range(40))) for i in range(60)]
    documents = spark.createDataFrame([*rows, (60, rows[0][1]), (61, None), (None, rows[1][1])], "doc_id bigint, text string")
    before, seen = set(folder_names(spark, shared_dir(spark))), []
    linkable = ngram_join._linkable

    def look(*given):
        found = linkable(*given)
        seen.extend(n.rsplit("-", 1)[0] for n in set(folder_names(spark, shared_dir(spark))) - before)
        return found

    monkeypatch.setattr(ngram_join, "_linkable", look)
    placed = ngram_join.link_components(documents)
    assert seen and not {"prefixes", "classes", "columns", "pairs", "apart", "pair-texts", "likely-pairs", "halves"} & set(seen)
    assert {r.component_id for r in placed.where("doc_id IN (0, 60)").collect()} == {0} and placed.count() == 63


def test_n_gram_join_in_small_parts_against_brute_force(spark, monkeypatch):
    for name, most in {"SLICE": 900, "HALVES": 500, "PAIRS": 20, "TEXT_PAIRS": 10, "SENT": 500, "HOT": 4, "BLOCK": 3}.items():
        monkeypatch.setattr(ngram_join, name, most)
    cut, of = [], ngram_join.slices
    monkeypatch.setattr(ngram_join, "slices", lambda df, key, *sizes: (cut.append((key, len(parts := of(df, key, *sizes)))), parts)[1])
    docs = near_copies()
    passage = [f"q{j}" for j in range(60)]
    for k in range(40):
        words = list(passage)
        for j in range(k % 4):
            words[(7 * k + 13 * j) % 60] = f"z{k}x{j}"
        docs.append((200 + k, " ".join(words)))
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    numbers = lambda: {int(m[1]) for m in re.finditer(r"shuffle_(\d+)_", files.getAllFiles().mkString(" "))}
    before = max(numbers(), default=-1)
    placed = ngram_join.link_components(frame(spark, docs), pivots=1)
    for _ in range(50):  # files go in the background
        if not (left := {k for k in numbers() if k > before}):
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in placed.collect()} == plain_components(docs)
    assert {key for key, parts in cut if parts > 1} == {"half", "a", "pair"}


def test_texts_are_left_out_before_they_move(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    documents = frame(spark, [(k, f"text {k}") for k in range(50)] + [(3, "text 3"), (3, "other"), (None, "x")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ngram_join.whole_texts(documents, spark.createDataFrame([(3,), (4,), (3,)], "doc_id bigint"))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, found.collect())) == [(3, "other"), (3, "text 3"), (4, "text 4")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # The join with the bitmap stands below that with the ids, which moves texts.
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 2 and "doc_id" in joins[0] and "_w" in joins[1]


def test_n_grams_of_large_columns_are_known(spark):
    passage = "nine words that stand in many of these documents"
    rows = [(k, f"{passage} {k} " + " ".join(f"u{k}x{j}" for j in range(9)) if k % 20 == 0 else f"o{k} p{k} q{k} r{k} s{k} t{k}") for k in range(2400)]
    late = set(ngram_join.frequent_shingles(frame(spark, rows)).tolist())
    assert set(ngram_join.shingles([passage])[0].tolist()) <= late
    # Those of more documents come last, and a bound leaves out the rarest.
    rows += [(k, "one two three four five") for k in range(3000, 4000)]
    own = ngram_join.frequent_shingles(frame(spark, rows))
    assert own[-1] == ngram_join.shingles(["one two three four five"])[0][0] and set(own[:-1].tolist()) == late
    assert ngram_join.frequent_shingles(frame(spark, rows), most=3).tolist() == own[-1:].tolist()
