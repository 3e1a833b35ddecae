"""Helpers shared by the training-data operators: settings, numbering, components, id filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import apply_settings, delete_folder, materialize, new_folder

# Small Arrow batches: texts may be long, and two workers share an executor's memory.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on."""
    apply_settings(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Within this, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.

    For steps that write tables: a frame whose own run is read later would make them again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: str) -> DataFrame:
    """Apply ``fn``, which turns a batch into columns by name, to every Arrow batch of ``df``."""
    names = [part.split()[0].strip(":") for part in _split_fields(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = fn(batch)
                yield pa.RecordBatch.from_arrays([_as_array(columns[n]) for n in names], names)

    return df.mapInArrow(run, schema)


def _as_array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def _split_fields(schema: str) -> list[str]:
    fields, depth, start = [], 0, 0
    for at, letter in enumerate(schema):
        depth += (letter == "<") - (letter == ">")
        if letter == "," and not depth:
            fields.append(schema[start:at].strip())
            start = at + 1
    return [*fields, schema[start:].strip()]


def with_positions(df: DataFrame, group: list[str], order: list[str], partitions: int, amount: str, name: str) -> DataFrame:
    """Running sums of ``amount`` before each row, in ``order`` within ``group``, without one task per group.

    Rows are dealt out by ranges of (group, order) and written once; each written partition adds
    up its own rows, the sums per partition (a few per task) are added up in turn, and both parts meet again.
    The result has the columns of ``df`` and ``name``; ``order`` must settle the order of rows up to ties.
    """
    keys = [*group, *order]
    down = [F.col(k).asc_nulls_first() for k in keys]
    parts = df.repartitionByRange(partitions, *down).sortWithinPartitions(*down).withColumn("_part", F.spark_partition_id())
    group_at, amount_at = [df.columns.index(g) for g in group], df.columns.index(amount)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            amounts = batch.column(amount_at).to_pylist()
            groups = list(zip(*[batch.column(g).to_pylist() for g in group_at], strict=True)) if group_at else [()] * batch.num_rows
            before = []
            for key, value in zip(groups, amounts, strict=True):
                if key != last:
                    last, total = key, 0
                before.append(total)
                total += value or 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], [*batch.schema.names, "_before"])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "_part int", "_before bigint"])
    written = materialize(parts.mapInArrow(run, ddl), "positions")
    share = written.groupBy("_part", *group).agg(F.sum(F.coalesce(F.col(amount), F.lit(0))).alias("_sum"))
    # One row per task and group that it holds: as few as tasks, plus one for each group's end.
    ahead = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    bases = share.withColumn("_base", F.coalesce(F.sum("_sum").over(ahead.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bases = bases.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_base")
    match = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        match = match & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = written.join(F.broadcast(bases), match, "left")
    return joined.select(*df.columns, (F.col("_base") + F.col("_before")).cast("bigint").alias(name))


def written_parts(spark: SparkSession, frames: Iterable[DataFrame], folder: str) -> DataFrame:
    for df in frames:
        df.write.mode("append").parquet(folder)
        schema = df.schema
    return spark.read.schema(schema).parquet(folder)


def slices(df: DataFrame, key: str, rows: int, most: int) -> list[DataFrame]:
    """``df`` of ``rows`` rows in parts of about ``most``, by a hash of ``key``."""
    many = max(1, -(-rows // most))
    return [df.where(F.pmod(F.xxhash64(key), F.lit(many)) == at) for at in range(many)] if many > 1 else [df]


class Scratch:
    """Tables in the shared folder that are of use only until the next ones are written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        return self.tables([df], name)

    def tables(self, frames: Iterable[DataFrame], name: str) -> DataFrame:
        """One table of frames of one schema, written one after the other; each is asked for when those before are written."""
        folder = new_folder(self.spark, name)
        self.folders.append(folder)
        return written_parts(self.spark, frames, folder)

    def clear(self) -> None:
        """Remove all tables made so far; no frame that reads them may be used afterwards."""
        for folder in self.folders:
            delete_folder(self.spark, folder)
        self.folders = []


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each node of an edge list with the smallest node that it reaches, as ``node, component``.

    Alternates two steps until nothing changes: every node sends its larger neighbours to its
    smallest one, then its smaller ones. Hubs are reduced by a minimum before any join, and each
    round is written to the shared folder, so that neither lineage nor a hub's edges gather anywhere.
    """
    links = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = materialize(links, "links")
    nodes = links
    state = _mark(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        up = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        up = materialize(up, "links")
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = down.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        links = materialize(down, "links")
        now = _mark(links)
        if now == state:
            break
        state = now
    leaves = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = nodes.select(F.col("v").alias("node")).distinct().join(leaves, "node", "left_anti").select("node", F.col("node").alias("component"))
    return leaves.unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """A count and an order-free sum of hashes, equal for equal sets of links."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


BITMAP_WORDS = 1 << 18


def reduce_by_ids(df: DataFrame, key: str, ids: DataFrame, id_name: str) -> DataFrame:
    """Rows of ``df`` whose key may be in ``ids``, before any shuffle.

    The ids set bits of a bitmap of fixed size (2^18 words of 64 bits), which is broadcast. With very many ids more
    rows pass; none that belongs is lost, and an exact join must follow.
    """
    bits = BITMAP_WORDS * 64
    spot = F.pmod(F.xxhash64(F.col(id_name)), F.lit(bits))
    words = ids.select(spot.alias("s")).groupBy(F.floor(F.col("s") / 64).cast("int").alias("_w")).agg(
        F.bit_or(F.expr("shiftleft(CAST(1 AS bigint), CAST(pmod(s, 64) AS int))")).alias("_bits")
    )
    own = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    marked = df.select("*", F.floor(own / 64).cast("int").alias("_w"), F.pmod(own, F.lit(64)).cast("int").alias("_b"))
    hit = marked.join(F.broadcast(words), "_w").where("shiftrightunsigned(_bits, _b) & 1 = 1")
    return hit.select(*df.columns)
