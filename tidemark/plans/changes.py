"""Change record between two versions, and the log of such records."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions.columns import as_list
from tidemark.operators import diff, drift
from tidemark.operators.merge import keep_known
from tidemark.operators.profile import CATEGORY_LIMIT, describe_table
from tidemark.operators.versions import KEEP_CHANGE_LOGS, latest_version
from tidemark.session import delete_folder, new_folder, one_row, side_by_side
from tidemark.sources.buckets import profile_of, schema_of, sums_of, unequal_buckets
from tidemark.sources.store import RECORD_COLUMNS, ROW_RECORDS, STEP, STEP_SCHEMA, VersionStore


@dataclass
class ChangeRecord:
    counts: DataFrame
    added: DataFrame
    edited: DataFrame
    deleted: DataFrame
    new_columns: DataFrame
    lost_columns: DataFrame
    class_changes: DataFrame
    new_categories: DataFrame
    lost_categories: DataFrame
    repeated: DataFrame
    # Where the changed keys were written; the frames above read them.
    folder: str


def diff_versions(
    new: DataFrame,
    old: DataFrame | None,
    keys: str | list[str],
    new_profile: DataFrame | None = None,
    old_profile: DataFrame | None = None,
    show_edits: bool = True,
    limit: int = CATEGORY_LIMIT,
) -> ChangeRecord | None:
    """Everything that differs between two versions; none for a first version.

    Keys that a version holds twice are listed in ``repeated`` and left out of the other parts about rows.

    The changed keys are worked out once, from row fingerprints, and written to
    the shared folder. All row outputs read only the rows those keys point at.
    """
    if old is None:
        return None
    keys = as_list(keys)
    folder = new_folder(new.sparkSession, "changed-keys")
    found = diff.changed_keys(new, old, keys)
    found.write.parquet(folder)
    changed = new.sparkSession.read.schema(found.schema).parquet(folder)
    if not show_edits:
        changed = changed.filter("status <> 'edited'")
    new_profile = describe_table(new, limit=limit) if new_profile is None else new_profile
    old_profile = describe_table(old, limit=limit) if old_profile is None else old_profile
    sides = drift.schema_diff(old_profile, new_profile)
    return ChangeRecord(
        counts=diff.count_changed(changed),
        added=keep_known(new, changed.filter("status = 'added'"), keys, keys_are_distinct=True),
        edited=diff.cells_edited(new, old, keys, changed),
        deleted=keep_known(old, changed.filter("status = 'deleted'"), keys, keys_are_distinct=True),
        new_columns=drift.new_columns(sides),
        lost_columns=drift.lost_columns(sides),
        class_changes=drift.class_changes(sides),
        new_categories=drift.new_categories(sides),
        lost_categories=drift.lost_categories(sides),
        repeated=changed.filter("status = 'repeated'").drop("status"),
        folder=folder,
    )


def diff_stored(store: VersionStore, new: Row, old: Row, keys: str | list[str], show_edits: bool = True, limit: int = CATEGORY_LIMIT) -> ChangeRecord:
    """Everything that differs between two stored versions. Buckets that are the same in both are not read, and profiles come from the lists."""
    uneven = unequal_buckets(store, new, old)
    profiles = [profile_of(store.bucket_list(v), schema_of(v), False, limit) if v.layout is not None else describe_table(store.open(v), limit=limit) for v in (new, old)]
    return diff_versions(store.open(new, uneven), store.open(old, uneven), keys, *profiles, show_edits, limit)


def append_change_log(
    store: VersionStore, record: ChangeRecord, table: str, run_ts: datetime, keep: int = KEEP_CHANGE_LOGS,
    made: Row | None = None, before: Row | None = None,
) -> None:
    """Save a change record; its rows go first, the small parts make it visible. The record is used up by it.

    With the version that was ``made`` and the one ``before``, the record also says how to tell the latter once its rows are gone.
    """
    # Four writes that read the same small table of keys; none fills a cluster by itself.
    side_by_side(store.spark, [lambda kind=kind: store.save_rows(kind, getattr(record, kind), table, run_ts) for kind in ROW_RECORDS], len(ROW_RECORDS))
    parts = {kind: getattr(record, kind) for kind in RECORD_COLUMNS}
    if made is not None and before is not None:
        sums = sums_of(store, before)
        schema = before.row_schema or store.open(before).schema.json()
        link = (made.version_id, before.version_id, before.version_ts, sums.n_rows, sums.row1, sums.row2, schema)
        parts[STEP] = one_row(store.spark, STEP_SCHEMA, link)
    store.append_records(parts, table, run_ts)
    delete_folder(store.spark, record.folder)
    store.purge_changes(keep, table)


def tables_with_changes(counts: DataFrame, ts: str = "run_ts", tie: str | None = None) -> DataFrame:
    """Counts of each table's latest run, for tables where anything changed."""
    names = ["n_added", "n_edited", "n_deleted"]
    latest = latest_version(counts, ts, tie)
    return latest.filter(sum((F.col(n) for n in names[1:]), F.col(names[0])) > 0).select("table_name", *names)


def latest_records(records: DataFrame, counts: DataFrame, ts: str = "run_ts") -> DataFrame:
    """Records that belong to the latest run of their table."""
    runs = counts.groupBy("table_name").agg(F.max(ts).alias(ts))
    return records.join(runs, ["table_name", ts], "left_semi").drop(ts)


def latest_change_summary(store: VersionStore) -> dict[str, DataFrame]:
    """The latest change record of all tables together."""
    counts = store.records("counts")
    summary = {"counts": tables_with_changes(counts)}
    for kind in RECORD_COLUMNS:
        if kind != "counts":
            summary[kind] = latest_records(store.records(kind), counts)
    return summary
