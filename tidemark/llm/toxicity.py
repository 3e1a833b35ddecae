"""Toxic spans by a linear-chain conditional random field of two states, scores and offsets from its marginals.

Labels are given per document, so tokens are labelled first: in toxic documents the tokens whose word or word beginning is
much more frequent in toxic than in other documents are toxic; all others are clean. At most ``MAX_ROWS`` labelled rows are learned from. The field has a
weight for each hashed feature of a token (its word, its beginnings of four to six letters) and for each pair of states. It is trained by
gradient ascent with exact forward-backward marginals on at most ``max_docs`` labelled documents per class, each counting for its share of
the class: on short stretches around every word of theirs that has features. A document's score is a logistic function, fitted to the whole
texts of the same documents, of what the marginals say: how many tokens are expected to be toxic and how sure the surest is. Text alone is read: labels, language, source and doc_id are no inputs of a score.

Tokens without any known feature have equal potentials; the messages of forward-backward pass through a run of them by powers of one 2 x 2
matrix, so work per document grows with its tokens that have features. Whole texts are read.

Nulls and repeats: a null or empty text has no tokens and scores as such; labels that are null or without a document are left
out; rows that share a doc_id are scored each; a document with both labels counts as toxic. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.session import materialize

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
# Words of a stretch that the field is trained on.
STRETCH = 24
THRESHOLD = 0.3
# Labelled rows that a field is fitted to, at most.
MAX_ROWS = 20_000


def features(word: str) -> list[str]:
    """Names of a token's features: the word, and its beginnings."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


@dataclass
class Field:
    """Weights of the field: per feature the score of ``toxic`` over ``clean``, and log potentials between states."""

    weights: dict[str, float]
    bias: float
    start: np.ndarray
    pairs: np.ndarray
    logistic: np.ndarray

    def __post_init__(self):
        self._cache: dict[str, float] = {}

    def potential(self, word: str) -> float:
        """Sum of the weights of the word's features; 0 if it has none."""
        get = self.weights.get
        return sum(get(name, 0.0) for name in features(word))

    def potentials(self, words: list[str]) -> list[float]:
        cache = self._cache
        missing = set(words).difference(cache)
        if missing:
            if len(cache) > 100_000:
                cache.clear()
                missing = set(words)
            cache.update((w, self.potential(w)) for w in missing)
        return list(map(cache.__getitem__, words))

    def marginals(self, potentials: list[float]) -> tuple[list[int], np.ndarray, float]:
        """Positions with features, their probability of being toxic, and the sum of all other tokens' probabilities."""
        n = len(potentials)
        active = [at for at, p in enumerate(potentials) if p]
        if not n:
            return [], np.zeros(0), 0.0
        if not active:
            return [], np.zeros(0), self._plain(n)
        move = np.exp(self.pairs)
        idle = move * np.exp([0.0, self.bias])
        values, vectors = np.linalg.eig(idle)
        back = np.linalg.inv(vectors)
        top = values.max()

        def power(k: int) -> np.ndarray:
            return ((vectors * (values / top) ** k) @ back).real

        # Forward messages before, and backward messages after, each active token; scaled to sum to one.
        ahead, behind = [], [None] * len(active)
        message, last = np.exp(self.start), -1
        for k, at in enumerate(active):
            gap = at - last - 1
            if last < 0:
                state = message if not gap else ((message * np.exp([0.0, self.bias])) @ power(gap - 1)) @ move
            else:
                state = (message @ power(gap)) @ move
            ahead.append(state / state.sum())
            message = ahead[-1] * np.exp([0.0, min(30.0, self.bias + potentials[at])])
            message = message / message.sum()
            last = at
        message, last = np.ones(2), n
        for k in range(len(active) - 1, -1, -1):
            at = active[k]
            gap = last - at - 1
            state = power(gap) @ message if last == n else power(gap) @ (move @ message)
            behind[k] = state / state.sum()
            message = behind[k] * np.exp([0.0, min(30.0, self.bias + potentials[at])])
            last = at
        f = np.array(ahead) * np.array(behind)
        f[:, 1] *= np.exp(np.minimum(30.0, self.bias + np.array([potentials[at] for at in active])))
        p = f[:, 1] / f.sum(1)
        return active, p, self._plain(n - len(active))

    def _plain(self, count: int) -> float:
        """Expected toxic tokens among tokens without features, at the chain's own level."""
        idle = np.exp(self.pairs) * np.exp([0.0, self.bias])
        values, vectors = np.linalg.eig(idle)
        right = np.abs(vectors[:, values.argmax()].real)
        values, vectors = np.linalg.eig(idle.T)
        left = np.abs(vectors[:, values.argmax()].real)
        level = left * right
        return float(count * level[1] / level.sum())

    def score(self, active: list[int], p: np.ndarray) -> float:
        z = self.logistic @ summary(p)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def summary(p: np.ndarray) -> np.ndarray:
    """What a document's marginals say: a constant, the surest token, and the expected count on a log scale."""
    sure = float(p.max()) if len(p) else 0.0
    return np.array([1.0, sure, np.log1p(float(p.sum()) if len(p) else 0.0)])


def _words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def labelled(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, text, toxic`` of documents with a label, at most ``max_rows`` labels in the order of a hash of their ids.

    Of equal texts with equal labels one stands for all. The labels taken are few enough to be sent to every task.
    """
    own = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = documents.select("doc_id", "text").join(F.broadcast(own), "doc_id")
    return rows.groupBy(F.xxhash64("text").alias("_h"), "toxic").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text")).drop("_h")


def feature_counts(texts: DataFrame) -> DataFrame:
    """``name, toxic, clean``: how many documents of each class have a feature, over the rows of ``labelled``."""

    def run(batch: pa.RecordBatch) -> dict:
        names, toxic, clean = {}, [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for name in {f for w in set(_words(text)) for f in features(w)}:
                at = names.setdefault(name, len(names))
                if at == len(toxic):
                    toxic.append(0)
                    clean.append(0)
                if label:
                    toxic[at] += 1
                else:
                    clean[at] += 1
        # A feature of no toxic document can mark none.
        return {"name": pa.array(list(names), pa.string()), "toxic": pa.array(toxic, pa.int64()), "clean": pa.array(clean, pa.int64())}

    partial = map_batches(texts.select("text", "toxic"), run, "name string, toxic bigint, clean bigint")
    return partial.groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(texts: DataFrame, max_docs: int = 2000, max_features: int = 20_000, min_odds: float = 8.0, min_z: float = 3.3, rounds: int = 60) -> Field:
    """Fit a field to ``labelled`` documents.

    ``max_docs`` labelled documents of each class, in the order of a hash of their ids, bound what is trained on; ``max_features`` bounds the features, the most
    telling first. Features are counted over all rows of ``texts``.
    """
    texts = materialize(texts, "labelled")
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    empty = Field({}, -5.0, np.zeros(2), np.zeros((2, 2)), np.array([-30.0, 0.0, 0.0]))
    if not totals.get(0) or not totals.get(1):
        return empty
    odds = F.log((F.col("toxic") + 0.5) / totals[1]) - F.log((F.col("clean") + 0.5) / totals[0])
    # Standard errors by which the odds must exceed none: what a few documents share by chance does not.
    z = F.col("odds") / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    told = feature_counts(texts).withColumn("odds", odds).where((F.exp("odds") >= min_odds) & (z >= min_z))
    rows = told.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "name").limit(max_features).collect()
    lexicon = {r["name"]: r["odds"] for r in rows}
    if not lexicon:
        return empty
    picked = None
    for label in (0, 1):
        own = texts.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(max_docs)
        picked = own if picked is None else picked.unionByName(own)
    picked = materialize(picked.select("text", "toxic"), "picked")
    found = map_batches(picked, _stretch_rows(lexicon), "words array<string>, toxic int").groupBy("words", "toxic").agg(F.count("*").alias("n"))
    # Each document taken stands for as many of its class as were left out, so that scores mean the share among all labelled rows.
    share = {label: n / min(n, max_docs) for label, n in totals.items()}
    field = _fit(lexicon, [(r["words"], r["toxic"], r["n"] * share[r["toxic"]]) for r in found.orderBy("toxic", "words").collect()], rounds)
    said = map_batches(picked, _summary_rows(field), "sure double, sum double, toxic int").orderBy("toxic", "sure", "sum").collect()
    field.logistic = _logistic(np.array([[1.0, r["sure"], r["sum"]] for r in said]), np.array([r["toxic"] for r in said], float), np.array([share[r["toxic"]] for r in said]))
    return field


def stretches(words: list[str], marked: list[int]) -> list[list[str]]:
    """The first ``STRETCH`` words, and as many around every word in ``marked``; words not in it are empty."""
    starts, last, spots = ([0] if words else []), -1, set(marked)
    for at in marked:
        if at > last:
            starts.append(max(0, at - STRETCH // 3))
            last = starts[-1] + STRETCH - 1
    # Words without a feature are alike to the field, so they need no name.
    return [[w if low + k in spots else "" for k, w in enumerate(words[low : low + STRETCH])] for low in dict.fromkeys(starts)]


def _stretch_rows(lexicon: dict[str, float]):
    """Documents as the stretches around all their marked words, for training alone."""

    def run(batch: pa.RecordBatch) -> dict:
        out, toxic = [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = _words(text)
            known = {w for w in set(words) if any(f in lexicon for f in features(w))}
            own = stretches(words, [at for at, w in enumerate(words) if w in known])
            out += own
            toxic += [label] * len(own)
        return {"words": pa.array(out, pa.list_(pa.string())), "toxic": pa.array(toxic, pa.int32())}

    return run


def _summary_rows(field: Field):
    """What the marginals of whole texts say."""

    def run(batch: pa.RecordBatch) -> dict:
        said = [summary(field.marginals(field.potentials(_words(text)))[1]) for text in batch.column(0).to_pylist()]
        return {"sure": pa.array([x[1] for x in said], pa.float64()), "sum": pa.array([x[2] for x in said], pa.float64()), "toxic": batch.column(1)}

    return run


def _fit(lexicon: dict[str, float], parts: list[tuple[list[str], int, float]], rounds: int) -> Field:
    """The field without its logistic, from distinct stretches and how often each counts."""
    names = {name: at for at, name in enumerate(lexicon)}
    own = {w: [names[f] for f in features(w) if f in names] for w in {w for words, _, _ in parts for w in words}}
    length = STRETCH
    seqs = [[own[w] for w in words] for words, _, _ in parts]
    tags = [[int(bool(toxic and own[w])) for w in words] for words, toxic, _ in parts]
    n = max(1, len(seqs))
    mask = np.zeros((n, length), bool)
    gold = np.zeros((n, length), int)
    rows, cols, feats = [], [], []
    for i, (seq, tag) in enumerate(zip(seqs, tags, strict=True)):
        mask[i, : len(seq)] = True
        gold[i, : len(tag)] = tag
        for j, fs in enumerate(seq):
            rows += [i] * len(fs)
            cols += [j] * len(fs)
            feats += fs
    rows, cols, feats = np.array(rows, int), np.array(cols, int), np.array(feats, int)
    count = np.array([n for _, _, n in parts] or [1.0])
    w, bias, start, pairs = np.zeros(len(names)), -3.0, np.zeros(2), np.zeros((2, 2))
    grads = [np.full_like(w, 1e-8), 1e-8, np.full(2, 1e-8), np.full((2, 2), 1e-8)]
    for _ in range(rounds):
        score = np.full((n, length), bias)
        np.add.at(score, (rows, cols), w[feats])
        prob, pair, first = _marginals(score, mask, start, pairs, count)
        wrong = (gold - prob) * mask * count[:, None]
        gw = np.bincount(feats, wrong[rows, cols], len(names)) - 0.3 * w
        gb = wrong.sum() - 0.05 * bias
        seen = np.zeros((2, 2))
        both = mask[:, 1:]
        np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), np.broadcast_to(count[:, None], both.shape)[both])
        gp = seen - pair - 0.05 * pairs
        gs = np.array([((gold[:, 0] == s) * count).sum() for s in (0, 1)]) - first - 0.05 * start
        # Steps by each weight's own gradient history.
        for k, g in enumerate((gw, gb, gs, gp)):
            grads[k] = grads[k] + g * g
        w = w + 0.5 * gw / np.sqrt(grads[0])
        bias = bias + 0.5 * gb / np.sqrt(grads[1])
        start = start + 0.5 * gs / np.sqrt(grads[2])
        pairs = pairs + 0.5 * gp / np.sqrt(grads[3])
    return Field({name: float(w[at]) for name, at in names.items() if abs(w[at]) > 1e-3}, float(bias), start, pairs, np.zeros(3))


def _logistic(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Weights of ``x`` for ``y``, of which each row counts ``c`` times."""
    theta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ theta))
        h = (x * (c * (p * (1 - p) + 1e-6))[:, None]).T @ x + 1e-2 * np.eye(3)
        theta = theta + np.linalg.solve(h, x.T @ (c * (y - p)) - 1e-2 * theta)
    return theta


def _marginals(score: np.ndarray, mask: np.ndarray, start: np.ndarray, pairs: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded sequences: token marginals, expected pairs, expected first states. ``count``: how often a sequence counts."""
    n, length = score.shape
    count = np.ones(n) if count is None else count
    move, emit = np.exp(pairs), np.stack([np.ones_like(score), np.exp(np.clip(score, -30, 30))], 2)
    emit[~mask] = 1.0
    alpha, beta = np.zeros((n, length, 2)), np.ones((n, length, 2))
    alpha[:, 0] = np.exp(start) * emit[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
    for t in range(1, length):
        step = (alpha[:, t - 1] @ move) * emit[:, t]
        step /= step.sum(1, keepdims=True)
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = (emit[:, t + 1] * beta[:, t + 1]) @ move.T
        step /= step.sum(1, keepdims=True)
        beta[:, t] = np.where(mask[:, t + 1, None], step, 1.0)
    both = alpha * beta
    prob = both[:, :, 1] / both.sum(2)
    pair = np.zeros((2, 2))
    for t in range(1, length):
        joint = alpha[:, t - 1, :, None] * move * (emit[:, t] * beta[:, t])[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        pair += (joint * count[:, None, None])[mask[:, t]].sum(0)
    used = mask[:, 0] * count
    return prob * mask, pair, np.array([((1 - prob[:, 0]) * used).sum(), (prob[:, 0] * used).sum()])


def score_documents(documents: DataFrame, field: Field, span_level: float = 0.5) -> DataFrame:
    """``doc_id, score, spans``: spans are ``start:end`` in code points of runs of tokens at or above ``span_level``, comma-joined."""
    spark = documents.sparkSession
    shared, kind = spark.sparkContext.broadcast(field), dict(documents.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> dict:
        model, scores, spans = shared.value, [], []
        for text in batch.column(1).to_pylist():
            words = _words(text)
            active, p, _ = model.marginals(model.potentials(words))
            scores.append(model.score(active, p))
            hot = [at for at, x in zip(active, p, strict=True) if x >= span_level]
            spans.append(_offsets(text, hot) if hot else "")
        return {"doc_id": batch.column(0), "score": pa.array(scores, pa.float64()), "spans": pa.array(spans, pa.string())}

    return map_batches(documents.select("doc_id", "text"), run, f"doc_id {kind}, score double, spans string")


def _offsets(text: str, tokens: list[int]) -> str:
    """Where the given words are in the text. Lower-casing may change lengths; then words are found in the text itself."""
    lower = text.lower()
    places = [m.span() for m in WORD.finditer(lower if len(lower) == len(text) else text)]
    out = []
    for at in tokens:
        if at < len(places):
            start, end = places[at]
            if out and at - out[-1][2] == 1:
                out[-1] = (out[-1][0], end, at)
            else:
                out.append((start, end, at))
    return ",".join(f"{a}:{b}" for a, b, _ in out)


def train_rows(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled rows that may be learned from: those whose crc32 of the id, as text, leaves another rest than 2 by 4."""
    return labelled(documents, labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2))


def drop_toxic(documents: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without the rows that score ``threshold`` or more; nothing is shuffled."""
    shared, at = documents.sparkSession.sparkContext.broadcast(field), documents.columns.index("text")

    def run(batches):
        for batch in batches:
            model, keep = shared.value, []
            for text in batch.column(at).to_pylist():
                active, p, _ = model.marginals(model.potentials(_words(text)))
                keep.append(model.score(active, p) < threshold)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
