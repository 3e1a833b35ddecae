"""Choice of versions from a list of them: newest, as of a day, newest few."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col, cols

# How many versions and change records are kept per table.
KEEP_VERSIONS = 3
KEEP_CHANGE_LOGS = 30


def _newest(versions: DataFrame, ts: str, tie: str | None) -> DataFrame:
    """Newest row per table as one aggregate, combined before the shuffle."""
    order = [col(ts)] + ([col(tie)] if tie else [])
    others = [n for n in versions.columns if n != "table_name"]
    best = F.max_by(F.struct(*cols(others)), F.struct(*order)).alias("__best")
    return versions.groupBy("table_name").agg(best).select("table_name", *[F.col("__best")[n].alias(n) for n in others])


def latest_version(versions: DataFrame, ts: str = "version_ts", tie: str | None = None) -> DataFrame:
    """The newest row of each table; ``tie`` decides between equal time stamps."""
    return _newest(versions, ts, tie)


def day_before(today: date | None = None) -> str:
    return str((today or date.today()) - timedelta(days=1))


def version_as_of(
    versions: DataFrame, day: str | None = None, ts: str = "version_ts", tie: str | None = None
) -> DataFrame:
    """The newest row of each table up to the end of ``day`` (default yesterday)."""
    limit = F.date_add(F.lit(day or day_before()).cast("date"), 1)
    return _newest(versions.filter(col(ts) < limit.cast(versions.schema[ts].dataType)), ts, tie)


def tables_without_version(versions: DataFrame, day: str | None = None, ts: str = "version_ts") -> DataFrame:
    """Tables that have no version up to the end of ``day``."""
    limit = F.date_add(F.lit(day or day_before()).cast("date"), 1).cast(versions.schema[ts].dataType)
    oldest = versions.groupBy("table_name").agg(F.min(col(ts)).alias("oldest"))
    return oldest.filter(F.col("oldest") >= limit).select("table_name")


def retain_latest_n(
    versions: DataFrame, n: int = KEEP_VERSIONS, ts: str = "version_ts", tie: str | None = None
) -> DataFrame:
    """The newest ``n`` rows of each table.

    Each task keeps its own newest ``n`` first, so a table with most of the rows
    is cut down before it is brought together.
    """
    order: list[Column] = [col(ts).desc()] + ([col(tie).desc()] if tie else [])
    window = Window.partitionBy("table_name").orderBy(*order)
    return versions.withColumn("__n", F.row_number().over(window)).filter(F.col("__n") <= n).drop("__n")
