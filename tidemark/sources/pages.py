"""Landed pages: JSON envelopes ``{"odata.count": n, "value": [record, ...]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import as_list, as_text, col, cols
from tidemark.operators.merge import keep_unknown
from tidemark.operators.shape import unroll_range

# Names in a page envelope, and rows per page.
COUNT_FIELD = "odata.count"
ROWS_FIELD = "value"
PAGE_SIZE = 1000

_CORRUPT = "__corrupt"
ENVELOPE = T.StructType(
    [
        T.StructField(COUNT_FIELD, T.StringType()),
        T.StructField(ROWS_FIELD, T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "primitivesAsString": "true"}


def parse_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Pages with ``reported``, ``records`` and ``readable`` next to their columns.

    A page is read once; nested values of a record are kept as JSON text.
    """
    page = F.from_json(col(body), ENVELOPE, _OPTIONS)
    opened = pages.withColumn("__page", page)
    rows = F.col("__page")[ROWS_FIELD]
    return opened.select(
        *cols(pages.columns),
        F.col("__page")[COUNT_FIELD].try_cast("bigint").alias("reported"),
        rows.alias("records"),
        F.coalesce(F.col("__page")[_CORRUPT].isNull() & rows.isNotNull(), F.lit(False)).alias("readable"),
    )


def record_fields(pages: DataFrame, body: str = "body") -> list[str]:
    """All field names in the pages, sorted; only the names reach the driver."""
    return fields_of(parse_pages(pages, body))


def fields_of(parsed: DataFrame) -> list[str]:
    names = _records(parsed, []).select(F.explode(F.map_keys("__record")).alias("name"))
    return sorted(r.name for r in names.distinct().collect())


def _records(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """One row per record of readable pages.

    Unreadable pages fall out behind the generator: a filter before it would be
    moved below the parser and make Spark parse every page twice.
    """
    rows = F.when(F.col("readable"), F.col("records"))
    return parsed.select(*cols(keep), F.explode_outer(rows).alias("__record")).filter("__record IS NOT NULL")


def rows_of(parsed: DataFrame, fields: list[str], keep: list[str] = ()) -> DataFrame:
    """The records of parsed pages, every field as text."""
    return _records(parsed, list(keep)).select(*cols(list(keep)), *_pick(F.col("__record"), fields))


def _pick(record: Column, fields: list[str]) -> list[Column]:
    return [record[f].alias(f) for f in fields]


def read_landed_pages(
    pages: DataFrame, fields: list[str] | None = None, body: str = "body", keep: str | list[str] | None = None
) -> DataFrame:
    """The records of all readable pages, every field as text.

    A field a record lacks is null and an empty page gives no rows. Naming the
    ``fields`` saves the pass that looks for them. ``keep`` carries columns of
    the page along.
    """
    fields = record_fields(pages, body) if fields is None else fields
    return rows_of(parse_pages(pages, body), fields, as_list(keep or []))


def read_page_files(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Page files as rows of ``body`` and ``page_file``.

    With ``multi_line`` a file is one page; otherwise every line is one.
    """
    text = spark.read.text(path, wholetext=multi_line)
    return text.select(F.col("value").alias("body"), F.input_file_name().alias("page_file"))


def read_json_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Records of page files through the JSON reader, which finds the fields.

    All records share one schema, and nested values become JSON text.
    """
    pages = (
        spark.read.option("multiLine", str(multi_line).lower()).option("primitivesAsString", "true").json(path)
    )
    kind = pages.schema[ROWS_FIELD].dataType if ROWS_FIELD in pages.columns else None
    # Without a single record the reader takes the empty lists for lists of text.
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
        return spark.createDataFrame([], "value string").select()
    rows = pages.select(F.inline(ROWS_FIELD))
    return rows.select(*[as_text(f.name, f.dataType).alias(f.name) for f in rows.schema.fields])


def expected_pages(counts: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Offsets ``0, size, 2 * size, ... <= total`` for each table.

    ``counts`` has ``table_name`` and ``total``. A total that is a multiple of
    the size gives one page more, which comes back empty.
    """
    known = counts.select("table_name", "total").filter("total IS NOT NULL")
    pages = unroll_range(known, F.lit(0), F.col("total"), page_size, "skip")
    return pages.select("table_name", "skip", F.lit(page_size).cast("bigint").alias("top"))


def quarantine_pages(
    pages: DataFrame, expected: DataFrame, keys: str | list[str] = ("table_name", "skip"), body: str = "body"
) -> DataFrame:
    """Pages to fetch again: unreadable ones, and expected ones that never came."""
    return failed_pages(parse_pages(pages, body), expected, keys)


def failed_pages(parsed: DataFrame, expected: DataFrame | None, keys: str | list[str] = ("table_name", "skip")) -> DataFrame:
    """The same over pages that are parsed already."""
    names = as_list(keys) if isinstance(keys, str) else list(keys)
    unreadable = parsed.filter("NOT readable").select(*cols(names), F.lit("unreadable").alias("reason"))
    if expected is None:
        return unreadable
    absent = keep_unknown(expected, parsed, names).select(*cols(names), F.lit("absent").alias("reason"))
    return unreadable.unionByName(absent)


def reconcile_counts(pages: DataFrame, table: str = "table_name", body: str = "body") -> DataFrame:
    """Rows each table reported against the rows that landed."""
    return count_records(parse_pages(pages, body), table)


def count_records(parsed: DataFrame, table: str = "table_name") -> DataFrame:
    """The same over pages that are parsed already."""
    landed = F.coalesce(F.sum(F.when(F.col("readable"), F.size("records")).otherwise(0)), F.lit(0))
    counted = parsed.groupBy(col(table)).agg(F.max("reported").alias("reported"), landed.alias("landed"))
    return counted.withColumn("complete", F.coalesce(F.col("reported") == F.col("landed"), F.lit(False)))
