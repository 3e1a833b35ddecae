"""Jaccard join of documents on word n-grams: a blocked sparse product of the document by n-gram incidence matrix.

A document's set holds its distinct n-grams of words (ASCII white space parts words, A-Z is lower-cased), hashed to 64 bits; with fewer words than n
the whole sequence is one n-gram. Two documents link when 100 * |A and B| >= percent * |A or B|. Documents with equal sets are
one class, and the smallest doc_id stands for it.

Bounds. n-grams are ordered, those frequent in a sample last (the ``frequent`` most frequent; any order gives the same result, a good one
less work). Of a set of size s only the first s - ceil(percent s) + 1 n-grams are columns of the product: two sets that link share one of those.
A pair is formed in a column only if its sizes allow the overlap that a link needs, and if what is left of both sets behind that
n-gram does; a pair goes on if what both first parts share, and the larger rest behind them, leave room for a link.

Product. Columns are dealt out by a hash of their n-gram; each block multiplies its columns and adds up overlaps per pair. Large columns are not squared. In a first pass
every member is paired with a few pivots of its column, the verified links give components, and a second pass forms only the pairs of a column
that are not in one component yet, so that thousands of near copies cost what their columns hold. The exact overlap
of every remaining pair is then counted over their whole sets. No link between different sets is lost for components.

Disk. Columns are worked out ``SLICE`` entries at a time, pairs are verified ``PAIRS`` and ``TEXT_PAIRS`` at a time, and blocks meet ``SENT`` n-grams
at a time; shuffle files of each part go before the next, so what grows with the input is tables of prefixes, columns, pairs and texts.

Columns that are still large and apart then (``HOT`` members or more) make no pairs. A document goes to a block of its largest such column, blocks of about
``BLOCK`` documents that share any of them meet in one task, less the documents of whose n-grams too few are held by another document, and the product of the two blocks' incidence matrices adds up the exact overlaps there. A task returns
for each document it has linked the smallest one it reaches in the block: rows grow with documents and blocks, never with pairs.

Nulls and repeats: a null or empty text has an empty set, linked with nothing; equal texts are one class; rows that share a doc_id are
parts of its node; a document with a null doc_id has no links and its own null as component.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, components, map_batches, reduce_by_ids, shuffles_go, slices, written_parts
from tidemark.session import materialize, new_folder

N, PERCENT = 5, 80
# A sample of one in 16 finds nearly all n-grams of ``HOT`` documents, however many documents there are.
SAMPLE, FREQUENT = 16, 2_000_000
HOT, BLOCK, WIDTH = 64, 256, 4096
# What one part works on: entries of columns, half hashes, pairs before and after the bound by columns, n-grams of texts sent to blocks.
SLICE, HALVES, PAIRS, TEXT_PAIRS, SENT = 1 << 25, 1 << 25, 1 << 21, 1 << 19, 1 << 28
_KEY = "shinglesofwords!"


def words_of(text: str | None) -> list[bytes]:
    """ASCII white space parts words; A-Z is lower-cased, other letters are left alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None], n: int = N) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's n-grams, as signed 64-bit integers."""
    words = [words_of(t) for t in texts]
    flat = [w for own in words for w in own]
    if not flat:
        return [np.zeros(0, np.int64) for _ in texts]
    codes, distinct = pd.factorize(np.array(flat, object))
    hashes = pd.util.hash_array(np.array(distinct, object), hash_key=_KEY, categorize=False)[codes].astype(np.uint64)
    out, low = [], 0
    for own in words:
        h = hashes[low : low + len(own)]
        low += len(own)
        size = min(n, len(own))
        if not size:
            out.append(np.zeros(0, np.int64))
            continue
        total = np.full(len(own) - size + 1, size, np.uint64)
        for k in range(size):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[k : len(own) - size + 1 + k])
        out.append(np.unique(total.view(np.int64)))
    return out


def frequent_shingles(documents: DataFrame, n: int = N, sample: int = SAMPLE, most: int = FREQUENT) -> np.ndarray:
    """Up to ``most`` hashes met three times or more in one document of ``sample``, the rarest first. They only order n-grams."""
    own = documents.select("text").where(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0)
    rows = map_batches(own, lambda b: {"h": np.concatenate(shingles(b.column(0).to_pylist(), n) or [np.zeros(0, np.int64)])}, "h bigint")
    scratch = Scratch(documents.sparkSession)
    top = scratch.table(rows.groupBy("h").agg(F.count("*").alias("c")).where("c >= 3"), "frequent")
    # The least count that no more than ``most`` reach, so that no task sorts them all.
    counts = sorted(((r["c"], r["n"]) for r in top.groupBy("c").agg(F.count("*").alias("n")).collect()), reverse=True)
    reach = np.cumsum([k for _, k in counts])
    least = next((c for (c, _), total in zip(reversed(counts), reach[::-1], strict=True) if total <= most), None)
    found = top.where(F.col("c") >= F.lit(least)).toArrow()
    scratch.clear()
    h, c = (found.column(k).to_numpy() for k in ("h", "c"))
    return h[np.lexsort((h, c))]


def prefix_size(size: int, percent: int = PERCENT) -> int:
    return size - -(-size * percent // 100) + 1 if size else 0


def prefixes(documents: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``doc_id, size, class, prefix``: set sizes, a 128-bit digest of the set, and its first n-grams in the common order."""
    spark, kind = documents.sparkSession, dict(documents.dtypes)["doc_id"]
    late = frequent_shingles(documents, n)
    order = np.argsort(late, kind="stable")
    shared = spark.sparkContext.broadcast((late[order], order.astype(np.int32)))

    def run(batch: pa.RecordBatch) -> dict:
        values, ranks = shared.value
        sizes, digests, firsts = [], [], []
        for own in shingles(batch.column(1).to_pylist(), n):
            sizes.append(len(own))
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            keep = prefix_size(len(own), percent)
            if len(values) and len(own):
                at = np.minimum(np.searchsorted(values, own), len(values) - 1)
                common = values[at] == own
                early = own[~common][:keep]
                if len(early) < keep:
                    behind = own[common]
                    early = np.concatenate([early, behind[np.argsort(ranks[at[common]])][: keep - len(early)]])
            else:
                early = own[:keep]
            firsts.append(early)
        return {"doc_id": batch.column(0), "size": pa.array(sizes, pa.int64()), "class": pa.array(digests, pa.binary()), "prefix": pa.array(firsts, pa.list_(pa.int64()))}

    return map_batches(documents.select("doc_id", "text"), run, f"doc_id {kind}, size bigint, class binary, prefix array<bigint>")


def _needed(a: str, b: str, percent: int) -> str:
    """The overlap that two sets of these sizes need to link."""
    return f"CAST(CEIL({percent} * ({a} + {b}) / {100.0 + percent}D - 1e-9D) AS bigint)"


def _allowed(percent: int) -> str:
    """Whether sizes, and what is left behind positions, allow a link."""
    return f"100 * LEAST(size, size2) >= {percent} * GREATEST(size, size2) AND LEAST(size - pos, size2 - pos2) >= {_needed('size', 'size2', percent)}"


def similar_pairs(cells: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """``a, b``: those of the pairs in ``cells(a, b)`` that link, by the overlap of their whole sets."""
    left = cells.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches):
        for batch in batches:
            keep = []
            one, two = (shingles(batch.column(k).to_pylist(), n) for k in (2, 3))
            for x, y in zip(one, two, strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def whole_texts(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents in ``ids(doc_id)``, equal rows once; others are left out before texts move.

    Texts go where pairs are, not sets: they are half the size once compressed.
    """
    near = reduce_by_ids(documents.select("doc_id", "text"), "doc_id", ids, "doc_id")
    # Not a semi join: Spark would put that before the bitmap and move every text. Ids named twice are dropped with equal rows.
    rows = near.join(ids.select("doc_id"), "doc_id").withColumn("h", F.xxhash64("text"))
    return rows.dropDuplicates(["doc_id", "h"]).drop("h")


def link_components(documents: DataFrame, n: int = N, percent: int = PERCENT, pivots: int = 4) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` for every row of ``documents``.

    ``class_id``: the smallest doc_id with the same set; ``component_id``: the smallest doc_id reachable by links.
    """
    with shuffles_go(documents.sparkSession):
        return _link_components(documents, n, percent, pivots)


def _link_components(documents: DataFrame, n: int, percent: int, pivots: int) -> DataFrame:
    own = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scratch, texts_used, firsts, met_used = (Scratch(documents.sparkSession) for _ in range(4))
    made = scratch.table(prefixes(own, n, percent), "prefixes")
    # Equal sets are one class before anything is joined; the smallest id is found with a map-side step.
    heads = made.where("size > 0 AND doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("head"), F.max("size").alias("size"), F.first("prefix").alias("prefix"))
    heads = firsts.table(heads, "classes")
    class_ids = materialize(heads.select("class", F.col("head").alias("class_id")), "class-ids")
    sizes = materialize(made.select("doc_id", "size", "class"), "set-sizes")
    scratch.clear()
    cells = met_used.tables(_columns(heads, pivots, scratch), "columns")
    # First n-grams are in columns now, and the tables of columns go before sets of n-grams are written: disk is held by what is still read.
    firsts.clear()
    scratch.clear()

    def seen(pairs: DataFrame) -> DataFrame:
        return pairs.where(_allowed(percent)).where("id <> id2").select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()

    first = cells.select("id", "size", "pos", F.col("pivot.id").alias("id2"), F.col("pivot.size").alias("size2"), F.col("pivot.pos").alias("pos2"))
    first = met_used.table(seen(first), "pairs")
    links = _verified(own, cells, first, n, percent, texts_used)
    texts_used.clear()
    known = components(links)
    # What is still apart in a column: its members by component; columns of one component are done.
    named = cells.drop("pivot").join(known.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    apart = named.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("h")
    named = met_used.table(named.join(apart, "h", "left_semi"), "apart")
    hot = named.groupBy("h").agg(F.count("*").alias("members")).where(F.col("members") >= HOT)
    hot_cells = scratch.table(named.select("h", "id", "size").join(hot, "h"), "hot-columns")
    placed = hot_cells.groupBy("id").agg(F.max(F.struct("members", "h")).alias("m"), F.max("size").alias("size")).select("id", F.col("m.h").alias("primary"), "size")
    placed = scratch.table(placed, "hot-owners")
    # What shares a hot column has met in blocks; the other columns are joined with themselves, less the pairs of one block family.
    rare = named.join(hot, "h", "left_anti").join(placed.drop("size"), "id", "left")
    other = rare.select("h", *[F.col(c).alias(f"{c}2") for c in ("id", "size", "pos", "component", "primary")])
    family = "(primary IS NULL OR primary2 IS NULL OR primary <> primary2)"
    met = rare.join(other, "h").where(f"component < component2 AND {family}").where(_allowed(percent))
    second = met_used.table(seen(met).join(first, ["a", "b"], "left_anti"), "pairs")
    more = _verified(own, cells, second, n, percent, texts_used)
    texts_used.clear()
    met_used.clear()
    texts = texts_used.table(whole_texts(own, placed.select(F.col("id").alias("doc_id"))), "block-texts")
    held = placed.agg(F.sum("size")).first()[0] or 0
    able = scratch.table(placed.join(_linkable(texts, n, percent, scratch, held), "id", "left_semi"), "linkable")
    owners, blocked = _hot_blocks(hot_cells, able, scratch)
    sent = blocked.agg(F.sum("sent")).first()[0] or 0
    meetings = slices(blocked.drop("sent"), "pair", sent, SENT)
    within = _parts((block_links(owners, part.drop("pair"), texts, n, percent) for part in meetings), own)
    more = more.unionByName(within)
    texts_used.clear()
    scratch.clear()
    found = materialize(components(links.unionByName(more)), "components")
    classes = class_ids.join(found.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    classes = classes.select("class", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    lone = F.when(F.col("size") > 0, F.col("class"))
    rows = sizes.select("doc_id", F.col("size").alias("n_shingles"), lone.alias("class"))
    joined = rows.join(classes, "class", "left")
    alone = F.col("doc_id").isNull()
    return joined.select(
        "doc_id", "n_shingles",
        F.when(alone, F.lit(None)).otherwise(F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(alone, F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _parts(frames, documents: DataFrame) -> DataFrame:
    """Links of all parts, written one after the other."""
    spark = documents.sparkSession
    return written_parts(spark, frames, new_folder(spark, "links"))


def _columns(heads: DataFrame, pivots: int, scratch: Scratch):
    """``h, id, size, pos, members, pivot``: entries of columns of two documents or more, a slice of the half hashes after the other."""
    entries = heads.select(F.col("head").alias("id"), "size", F.posexplode("prefix").alias("pos", "h")).withColumn("half", F.shiftright("h", 32).cast("int"))
    total = heads.agg(F.sum(F.size("prefix"))).first()[0] or 0
    for own in slices(entries, "half", total, SLICE):
        # Most columns have one document. Half a hash tells nearly all of them for a fraction of the bytes; the exact count follows.
        shared = scratch.table(own.groupBy("half").agg(F.count("*").alias("members")).where("members > 1").select("half"), "shared-halves")
        own = reduce_by_ids(own, "half", shared, "half").drop("half")
        # Columns of one document end here; counts and pivots are combined before they are shuffled.
        salt = F.pmod(F.xxhash64("h"), F.lit(pivots))
        few = [F.min_by(F.struct("id", "size", "pos"), F.xxhash64("id", salt)).alias("pivot")]
        columns = own.groupBy("h").agg(F.count("*").alias("members"), *few).where("members > 1").select("h", "pivot")
        yield own.join(columns, "h")
        scratch.clear()


def _linkable(texts: DataFrame, n: int, percent: int, scratch: Scratch, held: int) -> DataFrame:
    """``id``: documents that hold enough n-grams which others of ``texts`` hold as well; no link is possible below ``percent`` of the set.

    Half hashes tell them; two n-grams with one half only let a document pass. ``held``: about how many n-grams there are.
    """
    many = max(1, -(-held // HALVES))
    names = [f"halves{at}" for at in range(many)]

    def run(batch: pa.RecordBatch) -> dict:
        sets = shingles(batch.column(1).to_pylist(), n)
        halves = [(x >> 32).astype(np.int32) for x in sets]
        parts = {name: pa.array([x[x % many == at] for x in halves] if many > 1 else halves, pa.list_(pa.int32())) for at, name in enumerate(names)}
        return {"id": batch.column(0), "size": pa.array([len(x) for x in sets], pa.int64())} | parts

    # Worked out twice if they are one part: written, half hashes take as much disk as the texts do.
    sets = map_batches(texts.select("doc_id", "text"), run, ", ".join(["id bigint", "size bigint", *(f"{x} array<int>" for x in names)]))
    if many > 1:
        sets = scratch.table(sets, "half-hashes")
    counts = []
    for name in names:
        each = sets.select("id", "size", F.explode(name).alias("half"))
        shared = scratch.table(each.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half"), "shared-halves")
        found = reduce_by_ids(each, "half", shared, "half").groupBy("id").agg(F.count("*").alias("c"), F.min("size").alias("size"))
        counts.append(scratch.table(found, "held-halves") if many > 1 else found)
    found = reduce(DataFrame.unionByName, counts).groupBy("id").agg(F.sum("c").alias("c"), F.min("size").alias("size")) if many > 1 else counts[0]
    return found.where(f"100 * c >= {percent} * size").select("id")


def _hot_blocks(cells: DataFrame, able: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``id, primary, k``: the block of every document of ``able``, and ``primary, k, primary2, k2``: blocks that share a hot column.

    The latter also have ``pair``, a number for their slice, and ``sent``, the n-grams of the texts of both.
    """
    counts = able.groupBy("primary").agg(F.count("*").alias("docs"))
    parts = F.ceil(F.col("docs") / BLOCK).cast("bigint")
    owners = scratch.table(able.join(counts, "primary").select("id", "primary", F.pmod(F.xxhash64("id"), parts).alias("k"), "size"), "hot-blocks")
    held = scratch.table(cells.select("h", "id").join(owners, "id").select("h", "primary", "k").distinct(), "held")
    other = held.select("h", F.col("primary").alias("primary2"), F.col("k").alias("k2"))
    met = held.join(other, "h").where("primary < primary2 OR (primary = primary2 AND k <= k2)")
    met = met.select("primary", "k", "primary2", "k2").distinct()
    one = owners.groupBy("primary", "k").agg(F.sum("size").alias("sent1"))
    two = one.select(F.col("primary").alias("primary2"), F.col("k").alias("k2"), F.col("sent1").alias("sent2"))
    met = met.join(one, ["primary", "k"]).join(two, ["primary2", "k2"])
    met = met.select("primary", "k", "primary2", "k2", F.xxhash64("primary", "k", "primary2", "k2").alias("pair"), (F.col("sent1") + F.col("sent2")).alias("sent"))
    return owners.drop("size"), scratch.table(met, "block-pairs")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The product of two incidence matrices: how many n-grams each set of ``left`` shares with each of ``right``.

    n-grams of one side only are left out; the others are multiplied ``WIDTH`` columns at a time.
    """
    total = np.zeros((len(left), len(right)), np.float64)
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(own) for own in x])) for x in (left, right)]
    both = np.intersect1d(sides[0][0], sides[1][0])
    if not len(both):
        return total.astype(np.int64)
    cut = []
    for values, rows in sides:
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        own = both[at] == values
        order = np.argsort(at[own], kind="stable")
        cut.append((at[own][order], rows[own][order]))
    for low in range(0, len(both), WIDTH):
        dense = []
        for (at, rows), x in zip(cut, (left, right), strict=True):
            a, b = np.searchsorted(at, [low, low + WIDTH])
            matrix = np.zeros((len(x), min(WIDTH, len(both) - low)), np.float32)
            matrix[rows[a:b], at[a:b] - low] = 1
            dense.append(matrix)
        total += dense[0] @ dense[1].T
    return total.astype(np.int64)


def reached(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Each id that is linked, with the smallest id it reaches through a matrix of links between ``left`` and ``right``."""
    high = np.iinfo(np.int64).max
    one, two = left.copy(), right.copy()
    while True:
        down = np.minimum(two, np.where(links, one[:, None], high).min(axis=0))
        up = np.minimum(one, np.where(links, down[None, :], high).min(axis=1))
        if (down == two).all() and (up == one).all():
            break
        one, two = up, down
    return sorted({(int(i), int(m)) for i, m in [*zip(left, one, strict=True), *zip(right, two, strict=True)] if i != m})


def block_links(owners: DataFrame, blocked: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """``a, b``: documents of blocks that meet, each linked one with the smallest that it reaches there."""
    own = owners.join(texts.select(F.col("doc_id").alias("id"), "text"), "id")
    keys = ["primary", "k", "primary2", "k2"]
    one = own.join(blocked, ["primary", "k"]).select(*keys, F.lit(0).alias("side"), "id", "text")
    far = own.select(F.col("primary").alias("primary2"), F.col("k").alias("k2"), "id", "text")
    two = far.join(blocked, ["primary2", "k2"]).select(*keys, F.lit(1).alias("side"), "id", "text")

    def run(table: pa.Table) -> pa.Table:
        side, ids = table.column("side").to_numpy(), table.column("id").to_numpy()
        sets = shingles(table.column("text").to_pylist(), n)
        groups = [np.flatnonzero(side == s) for s in (0, 1)]
        pairs: list[tuple[int, int]] = []
        if all(map(len, groups)):
            left, right = ([sets[i] for i in g] for g in groups)
            shared = overlaps(left, right)
            sizes = [np.array([len(x) for x in part]) for part in (left, right)]
            links = (shared > 0) & (100 * shared >= percent * (sizes[0][:, None] + sizes[1][None, :] - shared))
            pairs = reached(links, ids[groups[0]], ids[groups[1]])
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    return one.unionByName(two).groupBy(*keys).applyInArrow(run, "a bigint, b bigint")


def likely_pairs(pairs: DataFrame, cells: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs whose shared columns leave room for a link.

    All n-grams that two sets share up to the end of one of their prefixes are columns of both; behind it that
    set has no more than its rest. The bound takes the larger rest, whichever prefix ends first.
    """
    near = reduce_by_ids(cells.select("id", "size", "h"), "id", _ids(pairs, scratch), "doc_id")
    own = near.groupBy("id", "size").agg(F.collect_list("h").alias("columns"))
    one = own.select(F.col("id").alias("a"), "size", F.col("columns").alias("columns1"))
    two = own.select(F.col("id").alias("b"), F.col("size").alias("size2"), F.col("columns").alias("columns2"))
    rest = f"CAST(CEIL(GREATEST(size, size2) * {percent} / 100D - 1e-9D) AS bigint) - 1"
    met = pairs.join(one, "a").join(two, "b").where(f"size(array_intersect(columns1, columns2)) + {rest} >= {_needed('size', 'size2', percent)}")
    return met.select("a", "b").distinct()


def _ids(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.table(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ids")


def _verified(documents: DataFrame, cells: DataFrame, pairs: DataFrame, n: int, percent: int, scratch: Scratch) -> DataFrame:
    near = (likely_pairs(part, cells, percent, scratch) for part in slices(pairs, "a", pairs.count(), PAIRS))
    pairs = scratch.tables(near, "likely-pairs")
    texts = scratch.table(whole_texts(documents, _ids(pairs, scratch)), "pair-texts")
    parts = slices(pairs, "a", pairs.count(), TEXT_PAIRS)
    return _parts((similar_pairs(part, texts, n, percent) for part in parts), documents)


def keep_one(documents: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``documents`` with one row of each component, that of the smallest doc_id; rows without words stay.

    With repeated or null ids rows are numbered and linked one by one: of rows with one doc_id the first stays, and rows
    with a null doc_id, which have no place in that order, keep one row of each component among themselves.
    """
    if documents.groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1 OR doc_id IS NULL").isEmpty():
        placed = link_components(documents, n, percent)
        gone = placed.where("doc_id <> component_id").select("doc_id").distinct()
        return documents.join(gone, "doc_id", "left_anti")
    # Written once, so that numbers stay the same.
    numbered = materialize(documents.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    placed = link_components(numbered.select(F.col("_row").alias("doc_id"), "text"), n, percent)
    linked = placed.where("n_shingles > 0").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_component"))
    linked = linked.join(numbered.select("_row", "doc_id"), "_row")
    first = linked.groupBy("_component", F.col("doc_id").isNull().alias("_null")).agg(F.min(F.struct("doc_id", "_row")).alias("_first"))
    gone = linked.select("_row").join(first.select(F.col("_first._row").alias("_row")), "_row", "left_anti")
    return numbered.join(gone, "_row", "left_anti").select(documents.columns)
