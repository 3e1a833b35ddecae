"""The same merge fed by a stream of landed page files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.catalog import TableConfig
from tidemark.operators import state
from tidemark.operators.shape import NO_FIELD
from tidemark.session import delete_folder, folder_names, materialize, one_row
from tidemark.sources.buckets import merge_buckets, publish_merged
from tidemark.sources.pages import parse_pages, rows_of
from tidemark.sources.store import Conflict, VersionStore, folder_name


def stream_page_files(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Page files as a stream of ``body``; a file or a line is one page."""
    text = spark.readStream.text(path, wholetext=multi_line)
    return text.select(F.col("value").alias("body"))


def merge_batch(store: VersionStore, cfg: TableConfig, rows: DataFrame, complete: bool = True) -> None:
    """Make a new version of the table out of the current one and ``rows``; only the buckets of the rows' keys are written again.

    Merging the same rows again changes nothing, so a batch that is replayed
    after a failure is harmless. A batch that is not complete leaves the date where it was.
    """
    table = cfg.table_name
    while True:
        current, number = store.head(table)
        made = merge_buckets(store, cfg, current, rows)
        latest = None if cfg.field == NO_FIELD else made.latest
        if not complete:
            known = store.state().filter(F.col("table_name") == table).first()
            latest = None if known is None else known.latest_date
        now = store.now()
        attrs = {"updated": now, "date_field": cfg.field, "latest_date": latest}
        try:
            publish_merged(store, cfg, made, number, attrs)
            break
        except Conflict:
            continue
    columns = "table_name string, latest_date date, updated timestamp_ntz, date_field string"
    entry = one_row(store.spark, columns, (table, latest, now, cfg.field))
    store.log_state(state.advance_state(store.state_log(), entry))
    store.expire(cfg.keep_versions, table=table)


def _quarantine(store: VersionStore, cfg: TableConfig) -> str:
    return f"{store.root}/quarantine/{folder_name(cfg.table_name)}"


def quarantined_pages(store: VersionStore, cfg: TableConfig) -> DataFrame:
    """``body`` and ``batch_id`` of the unreadable pages that hold the date back."""
    folder = _quarantine(store, cfg)
    if not folder_names(store.spark, folder):
        return store.spark.createDataFrame([], "body string, batch_id bigint")
    return store.spark.read.parquet(f"{folder}/*")


def release(store: VersionStore, cfg: TableConfig) -> None:
    """Forget the unreadable pages, once they landed again in a readable form."""
    delete_folder(store.spark, _quarantine(store, cfg))


def refresh_stream(
    store: VersionStore, cfg: TableConfig, pages: DataFrame, fields: list[str], checkpoint: str
) -> StreamingQuery:
    """Merge every page that landed since the last run, then stop.

    ``checkpoint`` remembers the files already merged. The fields are named, as
    a stream cannot look ahead for them. Unreadable pages of a batch are kept in ``quarantined_pages`` and hold the date
    back from then on, until ``release`` says that they came again.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        parsed = materialize(parse_pages(batch), "stream-pages")
        broken = parsed.filter("NOT readable").select("body").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if not broken.isEmpty():
            broken.write.mode("overwrite").parquet(f"{_quarantine(store, cfg)}/batch={batch_id}")
        rows = rows_of(parsed, fields)
        if not rows.isEmpty():
            merge_batch(store, cfg, rows, complete=not folder_names(store.spark, _quarantine(store, cfg)))

    writer = pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
