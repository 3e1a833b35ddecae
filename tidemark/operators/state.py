"""Bookkeeping of what is known about each table, as an append-only log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import latest_version
from tidemark.session import one_row

# Fixed value: the date that stands for "nothing loaded yet".
FIRST_DATE = "1900-01-01"

STATE_SCHEMA = (
    "table_name string, created timestamp_ntz, updated timestamp_ntz, file_type string, "
    "file_name string, latest_date date, date_field string, logged_at timestamp_ntz, has_version boolean"
)


def _first_date() -> Column:
    return F.lit(FIRST_DATE).cast("date")


def current_state(log: DataFrame, ts: str = "logged_at", tie: str | None = None) -> DataFrame:
    """Newest entry per table; a missing date is the first date."""
    newest = latest_version(log, ts, tie)
    return newest.withColumn("latest_date", F.coalesce("latest_date", _first_date()))


def initial_entry(spark: SparkSession, table: str, field: str, now: datetime) -> DataFrame:
    """First entry of a table, dated so that everything is fetched."""
    start = datetime.fromisoformat(FIRST_DATE)
    row = (table, now, start, "parquet", table, start.date(), field, now, False)
    return one_row(spark, STATE_SCHEMA, row)


def advance_state(
    log: DataFrame, updates: DataFrame, ts: str = "logged_at", tie: str | None = None
) -> DataFrame:
    """Log entries that move tables on to ``updates``.

    ``updates`` has ``table_name, latest_date, updated, date_field``. Tables not
    yet in the log start with this entry.
    """
    known = current_state(log, ts, tie).select("table_name", "created", "file_type", "file_name")
    moved = updates.join(known, "table_name", "left")
    return moved.select(
        "table_name",
        F.coalesce("created", "updated").alias("created"),
        "updated",
        F.coalesce("file_type", F.lit("parquet")).alias("file_type"),
        F.coalesce("file_name", "table_name").alias("file_name"),
        "latest_date",
        "date_field",
        F.col("updated").alias("logged_at"),
        F.lit(True).alias("has_version"),
    )


def reset_state(log: DataFrame, tables: DataFrame, at: Column, ts: str = "logged_at", tie: str | None = None) -> DataFrame:
    """Log entries that send tables back to the first date without a version.

    ``tables`` has ``table_name`` and the ``date_field`` to go on with.
    """
    known = current_state(log, ts, tie).select("table_name", "file_type", "file_name")
    return known.join(tables.select("table_name", "date_field"), "table_name").select(
        "table_name",
        at.alias("created"),
        _first_date().cast("timestamp_ntz").alias("updated"),
        "file_type",
        "file_name",
        _first_date().alias("latest_date"),
        "date_field",
        at.alias("logged_at"),
        F.lit(False).alias("has_version"),
    )


def rebuild_state(state: DataFrame, versions: DataFrame) -> DataFrame:
    """State with the attributes of each table's current version, nulls included.

    A version without a date sends its table back to the first date. Tables without a version keep what they have.
    """
    names = ["created", "date_field", "file_type", "latest_date", "updated"]
    attributes = versions.select("table_name", F.lit(True).alias("__known"), *[F.col(n).alias(f"__{n}") for n in names])
    joined = state.join(attributes, "table_name", "left")
    return joined.select(
        *[F.when(F.col("__known"), F.col(f"__{n}")).otherwise(F.col(n)).alias(n) if n in names else F.col(n) for n in state.columns]
    )
