"""Shards of near equal bytes, as the leaves of a k-d tree over document metadata.

Every node of the tree is split at the weighted median (weight: bytes) along its widest dimension, until the nodes hold
the target bytes. All nodes of a level are split together. A median is found by histograms: the range of values is cut into
``BINS`` bins whose bytes are summed with a map-side step, the bin that holds the median is cut again, until one value is left; documents with
that value are then parted along doc_id in the same way, so that equal values, a hot source for one, never keep a node whole.
Nothing but one row per bin and node leaves the tasks.

Dimensions are integers made of metadata: source and language (order-preserving codes of their first letters), size,
doc_id, and a CRC of the text. A dimension's width is its range in the node over its range in the whole table.

Nulls and repeats: a null text has no bytes and size 1; null metadata counts as the smallest value; rows that are equal in
all metadata stay together in one leaf. Other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import with_positions
from tidemark.session import materialize

BINS = 4096
DIMENSIONS = ("d_source", "d_lang", "d_size", "d_id")


def _code(name: Column) -> Column:
    """Order-preserving integer of the first seven bytes."""
    bytes_ = F.rpad(F.hex(F.substring(F.encode(F.coalesce(name.cast("string"), F.lit("")), "UTF-8"), 1, 7)), 14, "0")
    return F.conv(bytes_, 16, 10).cast("bigint")


def coordinates(documents: DataFrame) -> dict[str, Column]:
    """One integer per dimension, and the CRC that settles ties between rows which share every dimension."""
    raw, has = F.coalesce(F.col("text"), F.lit("")).cast("binary"), set(documents.columns)
    return {
        "d_source": _code(F.col("source")) if "source" in has else F.lit(0).cast("bigint"),
        "d_lang": _code(F.col("lang")) if "lang" in has else F.lit(0).cast("bigint"),
        "d_size": F.octet_length(raw).cast("bigint") + 1,
        "d_id": F.coalesce(F.col("doc_id"), F.lit(-(2**62))).cast("bigint"),
        "d_tie": F.crc32(raw),
    }


def metadata(documents: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` and the coordinates."""
    at = coordinates(documents)
    return documents.select("doc_id", at["d_size"].alias("size"), at["d_tie"].alias("text_crc32"), *[c.alias(n) for n, c in at.items()])


@dataclass
class Split:
    node: int
    dimension: str
    value: int
    tie: int
    last: int


def _median(rows: DataFrame, spans: dict[int, tuple[int, int, int]], value: Column) -> dict[int, tuple[int, int]]:
    """For each node the value at which its bytes reach a goal, and the bytes below that value.

    ``spans``: node to (lowest value, highest value, goal). Each round divides the range by ``BINS``.
    """
    spark, done, below = rows.sparkSession, {}, dict.fromkeys(spans, 0)
    while spans:
        steps = {n: (low, max(1, -(-(high - low + 1) // BINS)), high) for n, (low, high, _) in spans.items()}
        bounds = _values(spark, [(n, *v) for n, v in steps.items()], "node", "low", "step", "high")
        cut = rows.withColumn("v", value).join(bounds, "node").where("v BETWEEN low AND high")
        sums = cut.groupBy("node", F.expr("CAST((v - low) DIV step AS bigint)").alias("bin")).agg(F.sum("size").alias("size"))
        ahead = Window.partitionBy("node").orderBy("bin")
        goals = _values(spark, [(n, goal - below[n]) for n, (_, _, goal) in spans.items()], "node", "goal")
        reached = sums.join(goals, "node").withColumn("sum", F.sum("size").over(ahead)).where("sum >= goal").groupBy("node").agg(F.min_by(F.struct("bin", F.expr("sum - size AS before")), "bin").alias("b"))
        follow = {}
        for node, (at, before) in ((r["node"], r["b"]) for r in reached.collect()):
            low, step, high = steps[node]
            below[node] += before
            start = low + at * step
            if step == 1:
                done[node] = (start, below[node])
            else:
                follow[node] = (start, min(high, start + step - 1), spans[node][2])
        spans = follow
    return done


def kd_shards(meta: DataFrame, target_bytes: int | None = None, shards: int | None = None) -> tuple[DataFrame, list[Split]]:
    """``meta`` with ``shard``, and the splits. Give the bytes that a leaf may hold or the number of leaves, a power of two."""
    spark = meta.sparkSession
    rows = materialize(meta.withColumn("node", F.lit(1).cast("bigint")), "kd-level")
    total = rows.agg(F.sum("size")).first()[0] or 0
    whole = rows.agg(*[F.struct(F.min(d), F.max(d)).alias(d) for d in DIMENSIONS]).first()
    widths = {d: (whole[d][1] or 0) - (whole[d][0] or 0) for d in DIMENSIONS}
    depth = (shards or 1).bit_length() - 1
    if target_bytes:
        depth = 0
        while total > target_bytes << depth:
            depth += 1
    splits: list[Split] = []
    for _ in range(depth):
        stats = rows.groupBy("node").agg(F.sum("size").alias("size"), *[F.struct(F.min(d), F.max(d)).alias(d) for d in DIMENSIONS]).collect()
        chosen, spans = {}, {}
        for r in stats:
            width = {d: (r[d][1] - r[d][0]) / widths[d] if widths[d] else 0 for d in DIMENSIONS}
            best = max(DIMENSIONS, key=lambda d: width[d])
            chosen[r["node"]], spans[r["node"]] = best, (r[best][0], r[best][1], -(-r["size"] // 2))
        dims = [(n, DIMENSIONS.index(d)) for n, d in chosen.items()]
        level = rows.join(_values(spark, dims, "node", "dim"), "node").withColumn("x", F.element_at(F.array(*DIMENSIONS), (F.col("dim") + 1).cast("int")))
        found = _median(level, spans, F.col("x"))
        # Documents at the median value itself are parted along doc_id, then by the CRC of their text.
        at = level.join(_values(spark, [(n, v) for n, (v, _) in found.items()], "node", "value"), "node").where("x = value")
        goals = {n: spans[n][2] - b for n, (_, b) in found.items()}
        ids = _median(at, _range(at, "d_id", goals), F.col("d_id"))
        equal = at.join(_values(spark, [(n, v) for n, (v, _) in ids.items()], "node", "tie"), "node").where("d_id = tie")
        goals = {n: goals[n] - b for n, (_, b) in ids.items()}
        crcs = _median(equal, _range(equal, "d_tie", goals), F.col("d_tie"))
        own = [Split(n, chosen[n], found[n][0], ids[n][0], crcs[n][0]) for n in found]
        splits += own
        cuts = _values(spark, [(s.node, DIMENSIONS.index(s.dimension), s.value, s.tie, s.last) for s in own], "node", "dim", "value", "tie", "last")
        x = F.element_at(F.array(*DIMENSIONS), (F.col("dim") + 1).cast("int"))
        left = F.struct(x, F.col("d_id"), F.col("d_tie")) <= F.struct("value", "tie", "last")
        # Node numbers are those of a heap: 2n to the left, 2n + 1 to the right.
        below = rows.join(cuts, "node").withColumn("node", (F.col("node") * 2 + F.when(left, 0).otherwise(1)).cast("bigint"))
        rows = materialize(below.select(rows.columns), "kd-level")
    return rows.withColumn("shard", F.col("node") - F.lit(1 << depth)), splits


def _values(spark: SparkSession, rows: list[tuple[int, ...]], *names: str) -> DataFrame:
    """A table of one row per node of a level; there are no more nodes than shards."""
    if not rows:
        return F.broadcast(spark.range(0).select(*[F.lit(0).cast("bigint").alias(n) for n in names]))
    tuples = ", ".join("(" + ", ".join(f"{v}L" if v != -(2**63) else "CAST('-9223372036854775808' AS BIGINT)" for v in row) + ")" for row in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {tuples} AS t({', '.join(names)})"))


def _range(rows: DataFrame, name: str, goals: dict[int, int]) -> dict[int, tuple[int, int, int]]:
    """Lowest and highest value of each node, with its goal."""
    found = rows.groupBy("node").agg(F.min(name).alias("low"), F.max(name).alias("high")).collect()
    return {r["node"]: (r["low"], r["high"], goals[r["node"]]) for r in found}


def shard_documents(documents: DataFrame, shards: int = 16, target_bytes: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: slots count from 0 in each shard, by doc_id."""
    spark = documents.sparkSession
    rows, _ = kd_shards(metadata(documents), target_bytes, None if target_bytes else shards)
    rows = rows.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.lit(1).alias("one"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return with_positions(rows, ["shard"], ["doc_id", "text_crc32"], parts, "one", "slot").drop("one")


def write_shards(documents: DataFrame, folder: str, shards: int = 16, target_bytes: int | None = None) -> None:
    """Write ``documents`` as Parquet in a folder per shard. Rows find their shard by all their coordinates."""
    at = coordinates(documents)
    rows, _ = kd_shards(metadata(documents), target_bytes, None if target_bytes else shards)
    placed = rows.select(*[F.col(n).alias(f"_{n}") for n in at], F.col("shard").alias("_shard")).distinct()
    found = documents.select("*", *[c.alias(f"_{n}") for n, c in at.items()]).join(placed, [f"_{n}" for n in at])
    found.select(*[F.col(f"`{c}`") for c in documents.columns], "_shard").write.partitionBy("_shard").parquet(folder)
