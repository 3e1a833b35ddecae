"""Versions that are no longer stored, rebuilt from the change log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.catalog import TableConfig
from tidemark.operators import state
from tidemark.operators.replay import RUN, undo_changes
from tidemark.operators.shape import union_by_name
from tidemark.plans.refresh import merge_and_publish
from tidemark.sources.buckets import row_sums, schema_from
from tidemark.sources.store import Conflict, VersionStore


class NotRestorable(RuntimeError):
    """The change log cannot give back the rows that were asked for."""


def way_back(store: VersionStore, cfg: TableConfig, ts: datetime) -> tuple[Row, list[Row]]:
    """The stored version to start from, and the runs to undo from there, latest first, for the rows as of ``ts``.

    The way leads from each version to the one it was made from, so runs that an earlier revert left behind are not on it.
    It starts at the stored version that is nearest.
    """
    table = cfg.table_name
    held, _ = store.head(table)
    if held is None:
        raise NotRestorable(f"{table} has no current version")
    # One row a run, and no more runs than are kept.
    steps = {r.version_id: r for r in store.steps(cfg.keep_change_logs).filter(F.col("table_name") == table).collect()}
    stored = {r.version_id: r for r in store.versions().filter(F.col("table_name") == table).collect()}
    start, way, at, at_ts = held, [], held.version_id, held.version_ts
    while at_ts > ts:
        step = steps.get(at)
        if step is None:
            raise NotRestorable(f"the change log of {table} ends at {at_ts}, after {ts}")
        way.append(step)
        at, at_ts = step.before_id, step.before_ts
        if at in stored:
            start, way = stored[at], []
    return start, way


def _records(store: VersionStore, kind: str, table: str, way: list[Row]) -> DataFrame:
    """The row records of some runs, each with its place in time."""
    parts = []
    for place, step in enumerate(reversed(way)):
        rows = store.read_rows(kind, table, step.run_ts)
        if rows is None:
            raise NotRestorable(f"the rows {kind} in the run of {table} at {step.run_ts} are gone")
        parts.append(rows.withColumn(RUN, F.lit(place)))
    return union_by_name(*parts)


def rows_as_of(store: VersionStore, cfg: TableConfig, ts: datetime) -> DataFrame:
    """Rows of a table as they were at ``ts``, also where that version has expired.

    What is rebuilt is held against the number of rows and the 128-bit sum that were recorded when the version was current, so it is
    exact or refused (``NotRestorable``): that is the case for runs recorded without edits, lost columns that held values, and cells
    whose text does not give them back. Runs that met a key twice are refused as well, as their edits are not defined.
    """
    table = cfg.table_name
    start, way = way_back(store, cfg, ts)
    if not way:
        return store.open(start)
    if not _records(store, "repeated", table, way).isEmpty():
        raise NotRestorable(f"{table} held keys twice since {ts}")
    aim = way[-1]
    added, deleted, edited = (_records(store, kind, table, way) for kind in ("added", "deleted", "edited"))
    made = undo_changes(store.open(start), added, deleted, edited, cfg.keys, schema_from(aim.row_schema))
    made = store.scratch(made, "replayed")
    found = row_sums(made)
    if (found.n_rows, found.row1, found.row2) != (aim.n_rows, aim.row1, aim.row2):
        raise NotRestorable(f"the change log does not give back the {aim.n_rows} rows of {table} at {aim.before_ts} exactly")
    return made


def revert_by_log(store: VersionStore, cfg: TableConfig, ts: datetime) -> str:
    """Make the rows of a table as of ``ts`` its current version again, from the change log where that version has expired.

    The revert is a run like any other: it is recorded, and can be taken back in the same way. The state follows it, so the
    next refresh goes on from the latest date of the restored rows.
    """
    table = cfg.table_name
    try:
        rows = rows_as_of(store, cfg, ts)
        latest = None
        version_id = None
        while version_id is None:
            try:
                held, _ = store.head(table)
                version_id, latest = merge_and_publish(store, cfg, None, held, rows, None, True, store.now(), latest, True)
            except Conflict:
                # Another refresh came first; what the table held at the time stays the same.
                continue
        known = store.state().filter(F.col("table_name") == table)
        store.log_state(state.rebuild_state(known, store.current_versions()).withColumn("has_version", F.lit(True)))
        store.expire(cfg.keep_versions, table=table)
        store.tidy(cfg.keep_change_logs)
    finally:
        store.clear_scratch()
    return version_id
