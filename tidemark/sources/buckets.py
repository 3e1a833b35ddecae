"""Versions in buckets of keys: a merge rewrites, and a diff reads, only the buckets that changed.

The key of a row decides its bucket: a hash over a fixed number of buckets, or, for tables whose ids grow, ranges of ids of a fixed width, so that
new and recent rows share few buckets. A version is a list of buckets, each in the folder of the write that made it; buckets that a refresh
does not touch are in the lists of both versions. The list keeps what is known of every bucket, all of it exact and additive over buckets:

- the number of rows, and order-free 128-bit sums over rows and over keys, which tell equal buckets without reading them;
- the latest date, so the date of a version is that of the rows it holds, also where the row that had it is gone;
- for each column the value classes that all its values share, whether it has nulls, and its value set if that is small.

So the profile and the date of a new version follow from its list, and cost what the rewritten buckets cost.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import all_of, as_text, col, row_digest
from tidemark.functions.ladder import class_name
from tidemark.functions.text import date_prefix
from tidemark.operators.merge import upsert
from tidemark.operators.profile import CATEGORY_LIMIT, sketch_bound
from tidemark.operators.shape import NO_FIELD
from tidemark.operators.typing import class_masks

if TYPE_CHECKING:
    from tidemark.catalog import TableConfig
    from tidemark.sources.store import VersionStore

BUCKET, WRITE = "__bucket", "__write"
SUM = "decimal(38,0)"
SUMS = ["row1", "row2", "key1", "key2"]
LIST_SCHEMA = (
    "bucket bigint, folder string, n_rows bigint, rows_distinct boolean, keys_distinct boolean, row1 decimal(38,0), row2 decimal(38,0), key1 decimal(38,0), "
    "key2 decimal(38,0), latest_date date, columns array<struct<var_name:string,mask:int,has_null:boolean,values:array<string>>>"
)


@dataclass(frozen=True)
class Layout:
    """``hash:n`` deals keys over n buckets; ``range:w`` puts w consecutive ids of a table with one key in a bucket."""

    kind: str = "hash"
    size: int = 32

    @classmethod
    def parse(cls, text: str) -> Layout:
        kind, size = text.split(":")
        if kind not in ("hash", "range") or int(size) < 1:
            raise ValueError(f"{text} is no layout")
        return cls(kind, int(size))

    def __str__(self) -> str:
        return f"{self.kind}:{self.size}"

    def bucket(self, df: DataFrame, keys: list[str]) -> Column:
        """The bucket of a row; equal keys, nulls included, have the same one."""
        texts = [as_text(k, df.schema[k].dataType) for k in keys]
        if self.kind == "hash":
            return F.pmod(F.xxhash64(F.lit(3), *[p for t in texts for p in (t, t.isNull())]), F.lit(self.size))
        if len(keys) != 1:
            raise ValueError("ranges of ids need a table with one key")
        number = texts[0].try_cast("bigint")
        return F.coalesce(F.floor((number - F.pmod(number, F.lit(self.size))) / self.size).cast("bigint"), F.lit(-1))


def _key_digest(df: DataFrame, keys: list[str]) -> Column:
    """128-bit fingerprint of a key, the same for keys that read alike."""
    parts = [p for k in keys for p in (as_text(k, df.schema[k].dataType), col(k).isNull())]
    return F.struct(*[F.xxhash64(F.lit(i), *parts).alias(f"h{i}") for i in (1, 2)])


@dataclass
class Merged:
    """A version that nobody can see yet: its list, and the buckets that were rewritten."""

    version_id: str
    path: str
    layout: Layout
    schema: T.StructType
    listing: DataFrame
    touched: set[int] | None
    rows_distinct: bool
    latest: object

    def as_row(self, table: str) -> Row:
        """The version as an entry of the manifest names it."""
        return Row(table_name=table, version_id=self.version_id, path=self.path, **self.held)

    @property
    def held(self) -> dict:
        """What the manifest keeps of the layout."""
        return {"layout": str(self.layout), "row_schema": self.schema.json()}


def schema_from(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def schema_of(row: Row) -> T.StructType:
    return schema_from(row.row_schema)


def row_sums(rows: DataFrame) -> Row:
    """Number of rows and order-free 128-bit sum over them, as the lists of buckets add up to."""
    prints = rows.select(row_digest(rows, sorted(rows.columns)).alias("__row"))
    sums = [F.sum(F.col(f"__row.h{i}").cast("decimal(20,0)")).cast(SUM).cast("string").alias(f"row{i}") for i in (1, 2)]
    return prints.agg(F.count(F.lit(1)).alias("n_rows"), *sums).first()


def sums_of(store: VersionStore, row: Row) -> Row:
    """The same of a stored version; one in buckets is not read for it."""
    if row.layout is None:
        return row_sums(store.open(row))
    sums = [F.sum(n).cast(SUM).cast("string").alias(n) for n in ("row1", "row2")]
    return store.bucket_list(row).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"), *sums).first()


def read_buckets(store: VersionStore, row: Row, only: set[int] | None = None) -> DataFrame:
    """Rows of a version in buckets, or of ``only`` some of its buckets; no other folder is listed or read."""
    schema, base = schema_of(row), store.table_folder(row.table_name)
    places = [(p.folder, p.bucket) for p in store.bucket_list(row).select("folder", "bucket").collect() if only is None or p.bucket in only]
    if not places:
        return store.spark.createDataFrame([], schema)
    paths = [f"{base}/{WRITE}={folder}/{BUCKET}={bucket}" for folder, bucket in places]
    full = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType()), T.StructField(BUCKET, T.LongType())])
    return store.spark.read.schema(full).option("basePath", base).parquet(*paths).select(*[col(n) for n in schema.names])


def _write_part(store: VersionStore, rows: DataFrame, table: str, keys: list[str], layout: Layout) -> str:
    """Write rows bucket by bucket; a bucket of unusual size is split over several files."""
    folder = uuid.uuid4().hex
    dealt = rows.withColumn(BUCKET, layout.bucket(rows, keys)).hint("rebalance", F.col(BUCKET))
    dealt.write.partitionBy(BUCKET).parquet(f"{store.table_folder(table)}/{WRITE}={folder}")
    return folder


def _measure(store: VersionStore, schema: T.StructType, cfg: TableConfig, folder: str, is_distinct: bool) -> DataFrame:
    """List rows of the buckets of one write."""
    spark, names = store.spark, schema.names
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.LongType())])
    part = spark.read.schema(full).parquet(f"{store.table_folder(cfg.table_name)}/{WRITE}={folder}")
    day = date_prefix(as_text(cfg.field, schema[cfg.field].dataType)) if cfg.field != NO_FIELD and cfg.field in names else F.lit(None).cast("date")
    rsd, highest = sketch_bound(cfg.category_limit)
    texts = [as_text(n, schema[n].dataType) for n in names]
    prints = part.select("*", row_digest(part, sorted(names)).alias("__row"), _key_digest(part, cfg.keys).alias("__id"))
    # Equal values meet in each task; only one row a bucket and task is shuffled.
    counted = prints.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.sum(F.col(c).cast("decimal(20,0)")).cast(SUM).alias(s) for s, c in zip(SUMS, ("__row.h1", "__row.h2", "__id.h1", "__id.h2"), strict=True)],
        F.max(day).alias("latest_date"),
        F.array(*[F.approx_count_distinct(t, rsd) <= highest for t in texts]).alias("__few"),
        F.array(*[F.max(t.isNull()) for t in texts]).alias("has_null"),
    )
    counted = store.scratch(counted, "bucket-sums")
    # Sets are collected where the sketch, which misses none, finds few values; one row a bucket is joined.
    flagged = part.join(F.broadcast(counted.select(F.col(BUCKET).alias("__b"), "__few")), F.col(BUCKET) == F.col("__b"))
    sets = flagged.groupBy(BUCKET).agg(F.array(*[F.array_sort(F.collect_set(F.when(F.col("__few")[i], t))) for i, t in enumerate(texts)]).alias("sets"))
    masks = spark.createDataFrame([], f"{BUCKET} bigint, masks map<string,int>")
    if cfg.infer_classes:
        found = class_masks(part, True, BUCKET)
        masks = found.groupBy(BUCKET).agg(F.map_from_entries(F.collect_list(F.struct("column", "mask"))).alias("masks"))
    joined = counted.join(sets, BUCKET).join(masks, BUCKET, "left")
    columns = [
        F.struct(
            F.lit(n).alias("var_name"), F.col("masks")[F.lit(n)].alias("mask"), F.col("has_null")[i].alias("has_null"),
            F.when(F.col("__few")[i] & (F.size(F.col("sets")[i]) <= cfg.category_limit), F.col("sets")[i]).alias("values"),
        )
        for i, n in enumerate(names)
    ]
    # Fingerprints of equal keys meet, not those of a bucket, which can be any number; both numbers come from one shuffle.
    halves = [F.col(f"__{c}.h{i}").alias(f"__{c}{i}") for c in ("id", "row") for i in (1, 2)]
    met = prints.select(BUCKET, *halves).repartition(F.col(BUCKET), F.col("__id1"), F.col("__id2"))
    if not is_distinct:
        met = met.groupBy(BUCKET, "__id1", "__id2", "__row1", "__row2").agg(F.count(F.lit(1)).alias("n"))
    else:
        met = met.withColumn("n", F.lit(1))
    alike = met.groupBy(BUCKET, "__id1", "__id2").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"))
    alike = alike.groupBy(BUCKET).agg((F.max("n") == 1).alias("rows_distinct"), (F.max(F.col("rows") * F.col("n")) == 1).alias("keys_distinct"))
    return joined.join(alike, BUCKET).select(
        F.col(BUCKET).cast("bigint").alias("bucket"), F.lit(folder).alias("folder"), "n_rows", "rows_distinct", "keys_distinct", *SUMS, "latest_date", F.array(*columns).alias("columns")
    )


def merge_buckets(
    store: VersionStore, cfg: TableConfig, base: Row | None, delta: DataFrame, live: DataFrame | None = None, layout: Layout | None = None
) -> Merged:
    """``base`` with ``delta`` merged in, and only keys in ``live`` if given, as a version that is not published yet.

    Rewritten are the buckets of the delta's keys, those whose keys differ from the live ones, and those that hold a row twice.
    """
    keys, table = cfg.keys, cfg.table_name
    in_buckets = base is not None and base.layout is not None
    layout = layout or (Layout.parse(base.layout) if in_buckets else Layout.parse(cfg.layout))
    touched, listing = None, None
    if base is None:
        rows, is_distinct = upsert(None, delta, keys, live), False
    elif not in_buckets or str(layout) != base.layout:
        rows, is_distinct = upsert(store.open(base), delta, keys, live, old_is_distinct=bool(base.rows_distinct)), True
    else:
        listing = store.bucket_list(base)
        touched = touched_buckets(listing, delta, live, keys, layout)
        old = read_buckets(store, base, touched)
        rows, is_distinct = upsert(old, delta, keys, live, old_is_distinct=bool(base.rows_distinct)), True
    folder = _write_part(store, rows, table, keys, layout)
    # Worked out by many tasks; only its few rows are written by one.
    fresh = store.scratch(_measure(store, rows.schema, cfg, folder, is_distinct), "bucket-list")
    if listing is not None:
        fresh = listing.filter(~F.col("bucket").isin(sorted(touched))).unionByName(fresh)
    version_id = uuid.uuid4().hex
    path = f"{store.table_folder(table)}/lists/{version_id}"
    fresh.coalesce(1).write.parquet(path)
    listing = store.spark.read.schema(LIST_SCHEMA).parquet(path)
    row = listing.agg(F.max("latest_date").alias("latest"), F.coalesce(F.bool_and("rows_distinct"), F.lit(True)).alias("alike")).first()
    return Merged(version_id, path, layout, rows.schema, listing, touched, row.alike, row.latest)


def publish_merged(store: VersionStore, cfg: TableConfig, made: Merged, number: int | None = None, attrs: dict | None = None) -> Row:
    """Make a merged version the current one; ``Conflict`` if another writer took its number."""
    attrs = {"date_field": cfg.field, "latest_date": made.latest} | (attrs or {})
    store.publish(cfg.table_name, made.version_id, made.path, attrs.get("updated") or store.now(), attrs, made.rows_distinct, number, made.held)
    store.clear_scratch()
    return made.as_row(cfg.table_name)


def touched_buckets(listing: DataFrame, delta: DataFrame, live: DataFrame | None, keys: list[str], layout: Layout) -> set[int]:
    """Buckets that a merge has to rewrite. Their numbers alone reach the driver, as the names of files do."""
    found = delta.select(layout.bucket(delta, keys).alias("bucket")).unionByName(listing.filter("NOT rows_distinct").select("bucket"))
    if live is not None:
        named = live.select(*[as_text(k, live.schema[k].dataType).alias(k) for k in keys]).distinct()
        prints = named.select(layout.bucket(named, keys).alias("bucket"), _key_digest(named, keys).alias("id"))
        sums = [F.sum(F.col(f"id.h{i}").cast("decimal(20,0)")).cast(SUM).alias(f"live{i}") for i in (1, 2)]
        met = listing.select("bucket", "key1", "key2").join(prints.groupBy("bucket").agg(*sums), "bucket", "left")
        same = F.col("key1").eqNullSafe(F.col("live1")) & F.col("key2").eqNullSafe(F.col("live2"))
        found = found.unionByName(met.filter(~same).select("bucket"))
    return {r.bucket for r in found.distinct().collect()}


def unequal_buckets(store: VersionStore, new: Row, old: Row) -> set[int] | None:
    """Buckets in which two versions can differ; none at all (``None``) is known if they are laid out in different ways.

    Buckets in one folder are the same; others are if their counts and sums are, over the same columns. A bucket that holds
    a key twice is among them all the same, as a diff names such keys.
    """
    if new.layout is None or new.layout != old.layout:
        return None
    sides = []
    for row, mark in ((new, "n"), (old, "o")):
        names = ["folder", "n_rows", "row1", "row2", "keys_distinct"]
        sides.append(store.bucket_list(row).select("bucket", *[F.col(c).alias(f"{mark}_{c}") for c in names]))
    met = sides[0].join(sides[1], "bucket", "full_outer")
    same = F.col("n_folder").eqNullSafe(F.col("o_folder"))
    if set(schema_of(new).names) == set(schema_of(old).names):
        same = same | all_of([F.col(f"n_{c}").eqNullSafe(F.col(f"o_{c}")) for c in ("n_rows", "row1", "row2")])
    repeated = ~F.coalesce("n_keys_distinct", F.lit(True)) | ~F.coalesce("o_keys_distinct", F.lit(True))
    return {r.bucket for r in met.filter(~same | repeated).select("bucket").collect()}


def profile_of(listing: DataFrame, schema: T.StructType, infer: bool, limit: int = CATEGORY_LIMIT) -> DataFrame:
    """The profile of a version from its list, equal to ``describe_table`` over its rows; no row is read.

    It is as small as columns times ``limit`` values, and handed out as a local frame, since a diff looks at it many times.
    """
    spark = listing.sparkSession
    every = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "var_name string, kind string")
    each = listing.select(F.inline("columns"))
    # A column that a bucket was written without is null there.
    lacking = listing.select(F.explode(F.array_except(F.array(*[F.lit(n) for n in schema.names]), F.transform("columns", lambda c: c["var_name"]))).alias("var_name"))
    each = each.unionByName(lacking.withColumn("has_null", F.lit(True)).withColumn("values", F.array().cast("array<string>")), allowMissingColumns=True)
    summed = each.groupBy("var_name").agg(F.bit_and("mask").alias("mask"), F.max("has_null").alias("has_null"), F.max(F.col("values").isNull()).alias("many"))
    values = each.filter("values IS NOT NULL").select("var_name", F.explode("values").alias("value")).distinct()
    # At most limit + 1 values of a column go on.
    counted = values.groupBy("var_name").agg(F.count(F.lit(1)).alias("n"))
    small = values.join(counted.filter(F.col("n") <= limit), "var_name").groupBy("var_name").agg(F.array_sort(F.collect_list("value")).alias("found"))
    joined = every.join(summed, "var_name", "left").join(counted, "var_name", "left").join(small, "var_name", "left")
    fits = ~F.col("many") & (F.coalesce("n", F.lit(0)) <= limit)
    kind = class_name(F.col("mask")) if infer else F.col("kind")
    made = joined.select(
        "var_name", kind.alias("var_class"), F.when(fits, F.coalesce("n", F.lit(0)).cast("bigint")).alias("n_unique"),
        F.when(fits, F.coalesce("found", F.array().cast("array<string>"))).alias("values"), F.when(fits, F.col("has_null")).alias("has_null"),
    )
    return spark.createDataFrame(made.collect(), made.schema)
