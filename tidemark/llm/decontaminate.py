"""Benchmark decontamination: every passage of every document queries a BM25 index of benchmark items.

Index. Items are cut into units of at most ``UNIT`` words; a unit's weight for a term is its BM25 part over the unit's score for itself, so
that a passage holding the whole unit scores 1. Term statistics are counted over all items. Units are ordered by their
commonest term and length and kept in blocks of ``BLOCK``; for each term the index has its units and the largest weight in each block. It is built by Spark and broadcast in shards
of at most ``SHARD`` units, which bounds a shard by 64 postings a unit; a larger benchmark takes more passes.

Search. A document's words are dealt into segments of ``UNIT`` words; a passage is two neighbouring segments, so every stretch as long as a unit lies
whole in one. For each passage the block maxima of its terms are summed; blocks below the threshold are skipped,
in the others document-at-a-time WAND moves to the next unit that can reach it, checks the block's maxima again and scores it.
All units at or above the threshold are found; there is no limit per passage.

Check. A found item counts if, near the passage, at least ``OVERLAP`` of its question's word triples and of its answer's words occur. The answer is
what follows a line or sentence starting with "answer" or "a:", without that mark, else the last sentence. An item whose answer has fewer than
``ANSWER_WORDS`` words, or of one sentence, is all question.

Words are runs of characters other than ASCII space, punctuation and controls, in lower case. Nulls and repeats: a null or empty text, or item, has
no words and matches nothing; equal items are all reported; a null item_id or doc_id is carried along; rows sharing a doc_id are looked at each.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import map_batches
from tidemark.session import materialize

UNIT, BLOCK, SHARD = 64, 2, 20_000
K1, B = 1.2, 0.75
THRESHOLD, OVERLAP = 0.5, 0.5
ANSWER_WORDS = 3
_OTHER = bytes(b if b > 126 or chr(b).isalnum() else 32 for b in range(256))
ANSWER = re.compile(r"(?:^|[\n.?!])\s*(?:answer\b|a:)", re.IGNORECASE)
SENTENCE = re.compile(r"[.?!\n]+\s+(?=\S)")


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_OTHER).split() if text else []


def question_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Words of an item's question and of its answer."""
    text = text or ""
    marks = [(m.start(), m.end()) for m in ANSWER.finditer(text) if m.start()]
    ends = marks or [(m.end(), m.end()) for m in SENTENCE.finditer(text)]
    cut, low = ends[-1] if ends else (len(text), len(text))
    question, answer = words_of(text[:cut]), words_of(text[low:])
    if not question:
        return answer, []
    # One or two words more or less say nothing about a leak.
    if len(answer) < ANSWER_WORDS:
        return (question if marks else question + answer), []
    return question, answer


def units_of(items: DataFrame) -> DataFrame:
    """``item, unit, length, terms`` (a map of counts as two arrays), a row per unit; ``item`` numbers the rows of ``items``."""

    def run(batch: pa.RecordBatch) -> dict:
        item, length, terms, counts = [], [], [], []
        for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            pieces = -(-len(words) // UNIT)
            for k in range(pieces):
                part = words[k * len(words) // pieces : (k + 1) * len(words) // pieces]
                own = {}
                for w in part:
                    own[w] = own.get(w, 0) + 1
                item.append(number)
                length.append(len(part))
                terms.append(list(own))
                counts.append(list(own.values()))
        return {"item": pa.array(item, pa.int64()), "length": pa.array(length, pa.int64()), "terms": pa.array(terms, pa.list_(pa.binary())), "counts": pa.array(counts, pa.list_(pa.int64()))}

    return map_batches(items.select("item", "text"), run, "item bigint, length bigint, terms array<binary>, counts array<bigint>")


def postings(items: DataFrame) -> DataFrame:
    """``unit, item, length, term, weight``: weights are parts of the unit's BM25 score for itself."""
    units = materialize(units_of(items).withColumn("unit", F.monotonically_increasing_id()), "units")
    totals = units.agg(F.count("*").alias("n"), F.avg("length").alias("mean"))
    rows = units.select("unit", "item", "length", F.explode(F.arrays_zip("terms", "counts")).alias("p")).select("unit", "item", "length", F.col("p.terms").alias("term"), F.col("p.counts").alias("tf"))
    known = rows.groupBy("term").agg(F.count("*").alias("df"))
    scored = rows.join(known, "term").join(F.broadcast(totals))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    scored = scored.select("unit", "item", "length", "term", part.alias("part"))
    own = scored.groupBy("unit").agg(F.sum("part").alias("own"))
    return scored.join(own, "unit").select("unit", "item", "length", "term", (F.col("part") / F.col("own")).alias("weight"))


class Index:
    """One shard: term to units and weights, and to blocks and their largest weights, in arrays."""

    def __init__(self, rows: list[tuple], items: dict[int, tuple], threshold: float = THRESHOLD):
        self.threshold = threshold
        # Units with the same commonest term are of one language or kind, and units of like length have weights alike.
        often: dict[bytes, int] = {}
        for r in rows:
            often[r[3]] = often.get(r[3], 0) + 1
        commonest: dict[int, tuple] = {}
        for unit, item, length, term, _ in rows:
            commonest[unit] = max(commonest.get(unit, (0, b"", 0, 0)), (often[term], bytes(term), length, item))
        order = sorted(commonest, key=lambda u: (*commonest[u], u))
        number = {unit: at for at, unit in enumerate(order)}
        self.item_of = [commonest[unit][3] for unit in order]
        self.items = items
        self.blocks = -(-len(order) // BLOCK)
        by_term: dict[bytes, list] = {}
        for unit, _, _, term, weight in rows:
            by_term.setdefault(bytes(term), []).append((number[unit], weight))
        self.vocabulary = {term: at for at, term in enumerate(by_term)}
        self.lists = []
        first, blocks, maxima = [0], [], []
        for own in by_term.values():
            own.sort()
            units, weights = [u for u, _ in own], [w for _, w in own]
            best: dict[int, float] = {}
            for u, w in own:
                best[u // BLOCK] = max(w, best.get(u // BLOCK, 0.0))
            self.lists.append((units, weights, max(weights), best))
            blocks += best
            maxima += best.values()
            first.append(len(blocks))
        self.first, self.block, self.most = np.array(first), np.array(blocks, np.int64), np.array(maxima)

    def bounds(self, passage: np.ndarray, term: np.ndarray, count: int) -> np.ndarray:
        """Sums of block maxima of the given (segment, term) pairs, as segments by blocks."""
        low, many = self.first[term], self.first[term + 1] - self.first[term]
        spot = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        return np.bincount(np.repeat(passage, many) * self.blocks + self.block[spot], self.most[spot], count * self.blocks).reshape(count, self.blocks)

    def wand(self, terms: list[int], open_blocks: set[int]) -> list[tuple[int, float]]:
        """Units in ``open_blocks`` whose score reaches the threshold, one unit at a time, skipping by maxima."""
        theta, found, blocks = self.threshold - 1e-9, [], sorted(open_blocks)
        cursors = [[*self.lists[t], 0] for t in terms if not open_blocks.isdisjoint(self.lists[t][3])]
        for c in cursors:
            _advance(c, blocks[0] * BLOCK)
        while True:
            cursors = [c for c in cursors if c[4] < len(c[0])]
            cursors.sort(key=lambda c: c[0][c[4]])
            total, pivot = 0.0, -1
            for at, c in enumerate(cursors):
                total += c[2]
                if total >= theta:
                    pivot = at
                    break
            if pivot < 0:
                return found
            unit = cursors[pivot][0][cursors[pivot][4]]
            block = unit // BLOCK
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0][cursors[pivot + 1][4]] == unit:
                pivot += 1
            near = cursors[: pivot + 1]
            if block not in open_blocks or sum(c[3].get(block, 0.0) for c in near) < theta:
                # No unit of the pivot's block before the next list's unit can reach the threshold.
                follow = bisect_right(blocks, block)
                target = blocks[follow] * BLOCK if follow < len(blocks) else self.blocks * BLOCK
                if block in open_blocks and pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0][cursors[pivot + 1][4]])
                for c in near:
                    _advance(c, target)
            elif near[0][0][near[0][4]] == unit:
                score = sum(c[1][c[4]] for c in near)
                if score >= theta:
                    found.append((unit, score))
                for c in near:
                    c[4] += 1
            else:
                for c in near:
                    _advance(c, unit)

    def search(self, texts: list[str | None], max_cells: int = 2_000_000) -> list[list[tuple]]:
        """For each text its verified items: (item, score, question overlap, answer overlap, first word of the passage)."""
        found: list[list[tuple]] = [[] for _ in texts]
        if not self.item_of:
            return found
        get, room, low = self.vocabulary.get, max(2, max_cells // self.blocks), 0
        words = [words_of(t) for t in texts]
        sizes = [-(-len(w) // UNIT) for w in words]
        while low < len(texts):
            high, segments = low, 0
            while high < len(texts) and (high == low or segments + sizes[high] <= room):
                segments += sizes[high]
                high += 1
            if segments:
                self._search(low, words[low:high], sizes[low:high], segments, get, found)
            low = high
        return found

    def _search(self, low: int, words: list[list[bytes]], sizes: list[int], segments: int, get, found: list[list[tuple]]) -> None:
        vocabulary = len(self.lists)
        ids = np.concatenate([np.fromiter(map(get, w, repeat(-1)), np.int64, len(w)) for w in words])
        lengths = np.array([len(w) for w in words])
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        segment = np.repeat(first, lengths) + place // UNIT
        kept = ids >= 0
        pairs = np.unique(segment[kept] * vocabulary + ids[kept])
        if not len(pairs):
            return
        passage, term = pairs // vocabulary, pairs % vocabulary
        bound = self.bounds(passage, term, segments)
        # A passage starts at each segment; the last one of a document stands alone.
        last = np.zeros(segments, bool)
        last[np.cumsum(sizes)[np.array(sizes) > 0] - 1] = True
        after = np.vstack([bound[1:], np.zeros((1, self.blocks))])
        after[last] = 0
        both = bound + after >= self.threshold - 1e-9
        starts = np.searchsorted(passage, np.arange(segments + 1))
        owner = np.repeat(np.arange(len(words)), sizes)
        for at in np.flatnonzero(both.any(1)):
            end = starts[at + 1] if last[at] else starts[at + 2]
            terms = np.unique(term[starts[at] : end]).tolist()
            doc = int(owner[at])
            for unit, score in self.wand(terms, set(np.flatnonzero(both[at]).tolist())):
                item, spot = self.item_of[unit], int(at - first[doc]) * UNIT
                question, answer, size = self.items[item][1:]
                region = words[doc][max(0, spot - size) : spot + 2 * UNIT + size]
                q, a = triples_found(question, region), words_found(answer, region)
                if q >= OVERLAP and a >= OVERLAP:
                    found[low + doc].append((self.items[item][0], score, q, a, spot))


def _advance(cursor: list, target: int) -> None:
    cursor[4] = bisect_left(cursor[0], target, cursor[4])


def triples_found(words: list[bytes], region: list[bytes]) -> float:
    if len(words) < 3:
        return words_found(words, region)
    own = set(zip(words, words[1:], words[2:], strict=False))
    return len(own & set(zip(region, region[1:], region[2:], strict=False))) / len(own)


def words_found(words: list[bytes], region: list[bytes]) -> float:
    own = set(words)
    return len(own.intersection(region)) / len(own) if own else 1.0


def build_index(items: DataFrame, threshold: float = THRESHOLD) -> Iterator[Index]:
    """Shards of the index of ``items(item_id, text)``."""
    numbered = materialize(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    rows = materialize(postings(numbered), "postings")
    # Shards are runs of items in the order of their numbers; each is asked for by range, so no more than one is held here.
    after = -1
    while True:
        units = rows.where(F.col("item") > after).select("item", "unit").distinct()
        ends = units.groupBy("item").agg(F.count("*").alias("n")).orderBy("item").limit(SHARD).collect()
        if not ends:
            return
        total, last = 0, ends[0]["item"]
        for r in ends:
            total += r["n"]
            if total > SHARD and r["item"] != ends[0]["item"]:
                break
            last = r["item"]
        here = (F.col("item") > after) & (F.col("item") <= last)
        own = {r["item"]: (r["item_id"], *question_answer(r["text"])) for r in numbered.where(here).collect()}
        own = {k: (*v, len(v[1]) + len(v[2])) for k, v in own.items()}
        yield Index([tuple(r) for r in rows.where(here).collect()], own, threshold)
        after = last


def find_leaks(spark: SparkSession, documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, start_word``: verified items of every document, the best passage of each."""
    doc_kind, item_kind = dict(documents.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    schema = f"doc_id {doc_kind}, item_id {item_kind}, score double, question_overlap double, answer_overlap double, start_word bigint"
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    out = spark.createDataFrame([], schema)
    for index in build_index(items, threshold):
        shared = spark.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, shared=shared) -> dict:
            owners, hits = [], []
            for at, own in enumerate(shared.value.search(batch.column(1).to_pylist())):
                best: dict = {}
                for hit in own:
                    if hit[0] not in best or hit[1] > best[hit[0]][1]:
                        best[hit[0]] = hit
                owners += [at] * len(best)
                hits += best.values()
            columns = [pa.array([h[k] for h in hits], kind) for k, kind in ((1, pa.float64()), (2, pa.float64()), (3, pa.float64()), (4, pa.int64()))]
            names = ["score", "question_overlap", "answer_overlap", "start_word"]
            ids = pa.array([h[0] for h in hits], item_type)
            return {"doc_id": batch.column(0).take(pa.array(owners, pa.int64())), "item_id": ids} | dict(zip(names, columns, strict=True))

        out = out.unionByName(map_batches(documents.select("doc_id", "text"), run, schema))
    return out


def drop_leaked(spark: SparkSession, documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without the rows that hold a verified item; nothing is shuffled."""
    at = documents.columns.index("text")
    for index in build_index(items, threshold):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                clean = [not hits for hits in shared.value.search(batch.column(at).to_pylist())]
                yield batch.filter(pa.array(clean, pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
