"""Versions of tables on plain Parquet, listed in a manifest of numbered entries.

Data is written first and its manifest entry last. Readers find versions through
the manifest only, so a job that dies half way leaves the old version current.

The entries of a table are numbered, and an entry is a file that is created only if no other has its number. Of two writers that
start from the same version one comes first; the other gets ``Conflict`` and has to merge again. (The file system has to refuse to
create a file that exists, as HDFS does. An entry without content belongs to a writer that died; its number is not used again.)
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import cols
from tidemark.functions.text import snapshot_label, version_label
from tidemark.operators import state as states
from tidemark.operators.shape import union_by_name
from tidemark.operators.versions import (
    KEEP_CHANGE_LOGS,
    KEEP_VERSIONS,
    latest_version,
    retain_latest_n,
    tables_without_version,
    version_as_of,
)
from tidemark.session import create_file, delete_folder, folder_exists, folder_names, make_folder, move_file, new_folder
from tidemark.sources.buckets import BUCKET, LIST_SCHEMA, WRITE, read_buckets

MANIFEST_SCHEMA = (
    "table_name string, version_id string, version_ts timestamp_ntz, path string, rows_distinct boolean, "
    "created timestamp_ntz, updated timestamp_ntz, date_field string, file_type string, file_name string, "
    "latest_date date, event string, logged_at timestamp_ntz, number bigint, layout string, row_schema string"
)
MANIFEST_NAMES = [part.split()[0] for part in MANIFEST_SCHEMA.split(", ")]
PROFILE_SCHEMA = (
    "table_name string, version_id string, var_name string, var_class string, n_unique bigint, "
    "values array<string>, has_null boolean"
)
SNAPSHOT_SCHEMA = "label string, table_name string, version_id string, path string, layout string, row_schema string"

# Change records with the same columns for every table, and those columns.
RECORD_COLUMNS = {
    "counts": ["n_added", "n_edited", "n_deleted"],
    "new_columns": ["var_name"],
    "lost_columns": ["var_name"],
    "class_changes": ["var_name", "old_var_class", "new_var_class"],
    "new_categories": ["var_name", "old_set", "new_set", "same", "in_old_not_new", "in_new_not_old"],
    "lost_categories": ["var_name", "old_set"],
}
# How a run's version follows from the one before, and what tells that one: its rows, the sums over them, and its columns.
STEP = "step"
STEP_SCHEMA = "version_id string, before_id string, before_ts timestamp_ntz, n_rows bigint, row1 string, row2 string, row_schema string"
STEP_COLUMNS = [part.split()[0] for part in STEP_SCHEMA.split(", ")]
RECORD_SCHEMA = (
    "table_name string, run_ts timestamp_ntz, element string, n_added bigint, n_edited bigint, n_deleted bigint, "
    "var_name string, old_var_class string, new_var_class string, old_set string, new_set string, same string, "
    "in_old_not_new string, in_new_not_old string, " + STEP_SCHEMA
)
# Logs of more files than this are rewritten as one.
COMPACT_AFTER = 32

# Change records that carry rows of the table itself.
ROW_RECORDS = ["added", "deleted", "edited", "repeated"]


def moment(ts: datetime) -> Column:
    """A zone-free time stamp literal."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def folder_name(table: str) -> str:
    """Table name with everything unusual in a path spelled out."""
    return re.sub(r"[^A-Za-z0-9-]", lambda m: f"_{ord(m.group()):x}_", table)


class Conflict(RuntimeError):
    """Another writer published the entry with this number."""


class VersionStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._last = datetime.min
        self._lock = threading.Lock()
        self._tidying = threading.Lock()
        self._scratch = threading.local()

    # -- small helpers ------------------------------------------------------

    def now(self) -> datetime:
        """Current time, later than any time this store gave out before."""
        with self._lock:
            self._last = max(datetime.now(), self._last + timedelta(microseconds=1))
            return self._last

    def table_folder(self, table: str) -> str:
        return f"{self.root}/versions/{folder_name(table)}"

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder until ``clear_scratch``; each thread has its own."""
        folder = new_folder(self.spark, name)
        df.write.parquet(folder)
        self._scratch.folders = [*getattr(self._scratch, "folders", []), folder]
        return self.spark.read.schema(df.schema).parquet(folder)

    def clear_scratch(self) -> None:
        for folder in getattr(self._scratch, "folders", []):
            delete_folder(self.spark, folder)
        self._scratch.folders = []

    def _read(self, folder: str, schema: str) -> DataFrame:
        path = f"{self.root}/{folder}"
        if folder_exists(self.spark, path):
            # A compaction that died half way leaves rows in two files.
            return self.spark.read.schema(schema).parquet(path).distinct()
        return self.spark.createDataFrame([], schema)

    def _append(self, df: DataFrame, folder: str, schema: str) -> None:
        names = T.StructType.fromDDL(schema).names
        # Written aside and moved in, so that writers of one log do not share a folder of unfinished files.
        fresh = f"{self.root}/staging/log-{uuid.uuid4().hex}"
        df.select(*cols(names)).coalesce(1).write.parquet(fresh)
        make_folder(self.spark, f"{self.root}/{folder}")
        for name in folder_names(self.spark, fresh):
            if name.startswith("part-"):
                move_file(self.spark, f"{fresh}/{name}", f"{self.root}/{folder}/entry-{uuid.uuid4().hex}.parquet")
        delete_folder(self.spark, fresh)

    # -- versions -----------------------------------------------------------

    def manifest(self) -> DataFrame:
        path = f"{self.root}/manifest"
        if not folder_names(self.spark, path):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        # A compaction that died half way leaves rows in two files.
        return self.spark.read.schema(MANIFEST_SCHEMA).json(path).distinct()

    def _enter(self, rows: list[dict], name: str) -> None:
        """Create a manifest entry; ``Conflict`` if there is one of this name."""
        lines = []
        for row in rows:
            shown = {k: v for k, v in row.items() if k in MANIFEST_NAMES and v is not None}
            lines.append(json.dumps({k: v.isoformat() if hasattr(v, "isoformat") else v for k, v in shown.items()}))
        if not create_file(self.spark, f"{self.root}/manifest/{name}.json", "\n".join(lines)):
            raise Conflict(name)

    def head(self, table: str) -> tuple[Row | None, int]:
        """The current version of a table, and the number of the entry that would follow, from one read of the manifest."""
        log = self.manifest().filter(F.col("table_name") == table)
        whole = F.struct(*cols(log.columns))
        row = log.agg(F.max("number").alias("number"), F.max_by(F.when(F.col("event") != "expired", whole), F.when(F.col("event") != "expired", F.col("logged_at"))).alias("now")).first()
        start = f"entry-{folder_name(table)}."
        taken = [int(n.split(".")[1]) for n in folder_names(self.spark, f"{self.root}/manifest") if n.startswith(start)]
        now = None if row.now is None or row.now.event == "reset" else row.now
        return now, 1 + max([row.number or 0, *taken])

    def _numbered(self, table: str, row: dict, number: int | None) -> None:
        """Enter a row under ``number``, or under the next one that is free."""
        wanted = number
        while True:
            number = wanted or self.head(table)[1]
            try:
                return self._enter([row | {"number": number}], f"entry-{folder_name(table)}.{number:012d}")
            except Conflict:
                if wanted is not None:
                    raise

    def versions(self) -> DataFrame:
        """One row per version that has not expired."""
        log = self.manifest()
        expired = log.filter("event = 'expired'").select("version_id")
        written = log.filter("event = 'written'")
        return written.join(expired, "version_id", "left_anti").select(*log.columns)

    def current_versions(self) -> DataFrame:
        """The version each table stands at; tables that were reset have none."""
        log = self.manifest().filter("event IN ('written', 'current', 'reset')")
        return latest_version(log, "logged_at").filter("event <> 'reset'")

    def current(self, table: str) -> Row | None:
        return self.current_versions().filter(F.col("table_name") == table).first()

    def save_data(self, df: DataFrame, table: str) -> tuple[str, str]:
        """Write the rows of a version that nobody can see yet."""
        version_id = uuid.uuid4().hex
        path = f"{self.root}/versions/{folder_name(table)}/{version_id}"
        df.write.parquet(path)
        return version_id, path

    def publish(
        self,
        table: str,
        version_id: str,
        path: str,
        ts: datetime,
        attrs: dict | None = None,
        rows_distinct: bool = False,
        number: int | None = None,
        held: dict | None = None,
    ) -> None:
        """Make saved rows the current version of ``table``.

        ``number`` is that of the entry after the version they were made from: ``Conflict`` if another writer has taken it.
        ``held`` is the layout of a version in buckets.
        """
        row = {"created": ts, "updated": ts, "date_field": None, "file_type": "parquet", "file_name": table, "latest_date": None}
        row |= (attrs or {}) | (held or {})
        row |= {"table_name": table, "version_id": version_id, "version_ts": ts, "path": path, "rows_distinct": rows_distinct}
        self._numbered(table, row | {"event": "written", "logged_at": self.now()}, number)

    def write_version(
        self,
        df: DataFrame,
        table: str,
        ts: datetime | None = None,
        attrs: dict | None = None,
        rows_distinct: bool = False,
    ) -> str:
        version_id, path = self.save_data(df, table)
        self.publish(table, version_id, path, ts or self.now(), attrs, rows_distinct)
        return version_id

    def read_version(self, table: str, ts: datetime | None = None) -> DataFrame | None:
        """Rows of the current version, or of the one written at ``ts``."""
        if ts is None:
            row = self.current(table)
        else:
            asked = (F.col("table_name") == table) & (F.col("version_ts") == moment(ts))
            row = self.versions().filter(asked).first()
        return None if row is None else self.open(row)

    def open(self, row: Row, only: set[int] | None = None) -> DataFrame:
        """Rows of a version, or of some of its buckets."""
        if row.layout is None:
            return self.spark.read.parquet(row.path)
        return read_buckets(self, row, only)

    def bucket_list(self, row: Row) -> DataFrame:
        """What is known of each bucket of a version."""
        return self.spark.read.schema(LIST_SCHEMA).parquet(row.path)

    def reset(self, table: str) -> None:
        """Leave ``table`` without a current version; its versions stay."""
        now = self.now()
        self._numbered(table, {"table_name": table, "version_ts": now, "event": "reset", "logged_at": now}, None)

    def expire(self, n: int = KEEP_VERSIONS, purge: bool = True, table: str | None = None) -> DataFrame:
        """Keep the newest ``n`` versions per table, or of one table, besides the current one and those in a snapshot."""
        live = self.versions()
        if table is not None:
            live = live.filter(F.col("table_name") == table)
        live = live.join(self.snapshots().select("version_id"), "version_id", "left_anti").select(*live.columns)
        archived = live.join(self.current_versions().select("version_id"), "version_id", "left_anti")
        kept = retain_latest_n(archived, n, tie="logged_at").select("version_id")
        gone = archived.join(kept, "version_id", "left_anti").select(*live.columns)
        rows = gone.collect()
        if rows:
            now = self.now()
            self._enter([r.asDict() | {"event": "expired", "logged_at": now} for r in rows], f"expired-{uuid.uuid4().hex}")
            if purge:
                self._purge(rows)
        return self.versions()

    def _purge(self, rows: list[Row]) -> None:
        """Remove the folders of expired versions, but for buckets that a version which stays has in its list.

        Only folders in the lists of expired versions go, never those of a writer that has not published yet.
        """
        for row in rows:
            if row.layout is None:
                delete_folder(self.spark, row.path)
        for table in {r.table_name for r in rows if r.layout is not None}:
            gone = [r for r in rows if r.layout is not None and r.table_name == table]
            held = self.versions().filter((F.col("table_name") == table) & F.col("layout").isNotNull()).select("path").collect()
            places = self.spark.read.schema(LIST_SCHEMA).parquet(*[r.path for r in gone]).select("folder", "bucket").distinct()
            if held:
                stay = self.spark.read.schema(LIST_SCHEMA).parquet(*[r.path for r in held]).select("folder", "bucket")
                places = places.join(stay, ["folder", "bucket"], "left_anti")
            base = self.table_folder(table)
            writes = set()
            for place in places.collect():
                delete_folder(self.spark, f"{base}/{WRITE}={place.folder}/{BUCKET}={place.bucket}")
                writes.add(f"{base}/{WRITE}={place.folder}")
            for write in writes:
                if not [n for n in folder_names(self.spark, write) if n.startswith(BUCKET)]:
                    delete_folder(self.spark, write)
            for row in gone:
                delete_folder(self.spark, row.path)

    # -- state --------------------------------------------------------------

    def state_log(self) -> DataFrame:
        return self._read("state", states.STATE_SCHEMA)

    def log_state(self, entries: DataFrame) -> None:
        stamped = entries.withColumn("logged_at", moment(self.now()))
        self._append(stamped, "state", states.STATE_SCHEMA)

    def state(self) -> DataFrame:
        return states.current_state(self.state_log())

    # -- profiles -----------------------------------------------------------

    def save_profile(self, profile: DataFrame, table: str, version_id: str) -> None:
        named = profile.withColumn("table_name", F.lit(table)).withColumn("version_id", F.lit(version_id))
        self._append(named, "profiles", PROFILE_SCHEMA)

    def profile(self, version_id: str) -> DataFrame:
        names = ["var_name", "var_class", "n_unique", "values", "has_null"]
        return self._read("profiles", PROFILE_SCHEMA).filter(F.col("version_id") == version_id).select(*names)

    # -- snapshots and revert -----------------------------------------------

    def snapshot_all(self, ts: datetime | None = None, tables: list[str] | None = None) -> str:
        """Hold the current version of every table under one label.

        The files of a version never change, so a snapshot is a list of versions that do not expire.
        """
        at = moment(ts or self.now())
        label = self.spark.range(1).select(snapshot_label(at)).first()[0]
        held = self.current_versions()
        if tables is not None:
            held = held.filter(F.col("table_name").isin(tables))
        self._append(held.withColumn("label", F.lit(label)), "snapshot_list", SNAPSHOT_SCHEMA)
        return label

    def snapshots(self) -> DataFrame:
        return self._read("snapshot_list", SNAPSHOT_SCHEMA).distinct()

    def read_snapshot(self, label: str, table: str) -> DataFrame | None:
        row = self.snapshots().filter((F.col("label") == label) & (F.col("table_name") == table)).first()
        return None if row is None else self.open(row)

    def revert(self, day: str | None = None) -> DataFrame:
        """Go back to each table's newest version up to the end of ``day``.

        Tables without one keep what they have and are returned. The table
        states follow the versions.
        """
        versions = self.versions()
        chosen = version_as_of(versions, day, ts="updated", tie="logged_at").select(*versions.columns)
        left_out = tables_without_version(versions, day, ts="updated")
        for row in chosen.collect():
            self._numbered(row.table_name, row.asDict() | {"event": "current", "logged_at": self.now()}, None)
        rebuilt = states.rebuild_state(self.state(), self.current_versions()).withColumn("has_version", F.lit(True))
        self.log_state(rebuilt)
        return left_out

    # -- change log ---------------------------------------------------------

    def append_records(self, records: dict[str, DataFrame], table: str, run_ts: datetime) -> None:
        """Save the small parts of a change record as one file of the log."""
        run = [F.lit(table).alias("table_name"), moment(run_ts).alias("run_ts")]
        parts = [
            record.select(*run, F.lit(kind).alias("element"), *cols(record.columns if kind == STEP else RECORD_COLUMNS[kind]))
            for kind, record in records.items()
        ]
        whole = union_by_name(self.spark.createDataFrame([], RECORD_SCHEMA), *parts)
        # Worked out by many tasks; only its few rows are written by one, which would else run every step of all parts.
        aside = new_folder(self.spark, "records")
        whole.write.parquet(aside)
        self._append(self.spark.read.schema(whole.schema).parquet(aside), "changes/records", RECORD_SCHEMA)
        delete_folder(self.spark, aside)

    def _records(self) -> DataFrame:
        return self._read("changes/records", RECORD_SCHEMA)

    def records(self, kind: str, n: int = KEEP_CHANGE_LOGS) -> DataFrame:
        """Change records of the newest ``n`` runs per table."""
        return self._kept_records(kind, RECORD_COLUMNS[kind], n)

    def steps(self, n: int = KEEP_CHANGE_LOGS) -> DataFrame:
        """For the newest ``n`` runs per table, which version they made of which."""
        return self._kept_records(STEP, STEP_COLUMNS, n)

    def _kept_records(self, kind: str, names: list[str], n: int) -> DataFrame:
        runs = retain_latest_n(self._runs(), n, "run_ts").select("table_name", "run_ts")
        log = self._records().filter(F.col("element") == kind)
        kept = log.join(runs, ["table_name", "run_ts"], "left_semi")
        return kept.select("table_name", "run_ts", *cols(names))

    def _runs(self) -> DataFrame:
        return self._records().filter("element = 'counts'").select("table_name", "run_ts").distinct()

    def _row_folder(self, kind: str, table: str, run_ts: datetime) -> str:
        return f"{self.root}/changes/{kind}/{folder_name(table)}/{run_ts:%Y%m%d_%H%M%S_%f}"

    def save_rows(self, kind: str, rows: DataFrame, table: str, run_ts: datetime) -> None:
        rows.write.mode("overwrite").parquet(self._row_folder(kind, table, run_ts))

    def read_rows(self, kind: str, table: str, run_ts: datetime) -> DataFrame | None:
        path = self._row_folder(kind, table, run_ts)
        return self.spark.read.parquet(path) if folder_exists(self.spark, path) else None

    def purge_changes(self, n: int = KEEP_CHANGE_LOGS, table: str | None = None) -> None:
        """Delete the row records of runs beyond the newest ``n`` of a table, or of every table.

        Folders that are still there are listed, not the runs ever logged, so a purge costs as much after years.
        """
        for kind in ROW_RECORDS:
            folder = f"{self.root}/changes/{kind}"
            for name in [folder_name(table)] if table is not None else folder_names(self.spark, folder):
                # Names are time stamps, so their order is that of the runs.
                for run in sorted(folder_names(self.spark, f"{folder}/{name}"))[:-n]:
                    delete_folder(self.spark, f"{folder}/{name}/{run}")

    # -- upkeep ---------------------------------------------------------------

    def tidy(self, keep_change_logs: int = KEEP_CHANGE_LOGS, after: int = COMPACT_AFTER) -> None:
        """Rewrite logs of more than ``after`` files as one (one thread at a time), without what no reader looks at any more.

        Gone are expired versions and their profiles, states but the newest, and records of runs beyond those kept.
        """

        def live(log: DataFrame) -> DataFrame:
            expired = log.filter("event = 'expired'").select("version_id")
            return log.join(expired, "version_id", "left_anti").select(*log.columns)

        def kept_runs(log: DataFrame) -> DataFrame:
            runs = log.filter("element = 'counts'").select("table_name", "run_ts").distinct()
            return log.join(retain_latest_n(runs, keep_change_logs, "run_ts"), ["table_name", "run_ts"], "left_semi").select(*log.columns)

        with self._tidying:
            self._compact_all(live, kept_runs, after)

    def _compact_all(self, live, kept_runs, after: int) -> None:
        versions = self.versions().select("version_id")
        self._compact("profiles", PROFILE_SCHEMA, after, lambda log: log.join(versions, "version_id", "left_semi").select(*log.columns))
        self._compact("state", states.STATE_SCHEMA, after, lambda log: latest_version(log, "logged_at").select(*log.columns))
        self._compact("changes/records", RECORD_SCHEMA, after, kept_runs)
        self._compact("snapshot_list", SNAPSHOT_SCHEMA, after, lambda log: log)
        self._compact("manifest", MANIFEST_SCHEMA, after, live)

    def _compact(self, folder: str, schema: str, after: int, keep) -> None:
        """Rewrite the files of a log as one. The old ones go with the next rewrite, so that readers who listed them can still read them."""
        path = f"{self.root}/{folder}"
        names = folder_names(self.spark, path)
        gone = f"{self.root}/retired/{folder}"
        lists = folder_names(self.spark, gone)
        retired = {r.value for r in self.spark.read.text(gone).collect()} if lists else set()
        live = [n for n in names if n[0] not in "_." and n not in retired]
        if len(live) <= after:
            return
        is_json = folder == "manifest"
        reader = self.spark.read.schema(schema)
        files = [f"{path}/{n}" for n in live]
        rows = keep((reader.json(files) if is_json else reader.parquet(*files)).distinct())
        fresh = f"{self.root}/staging/compact-{uuid.uuid4().hex}"
        one = rows.coalesce(1).write
        one.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(fresh) if is_json else one.parquet(fresh)
        for name in folder_names(self.spark, fresh):
            if name.startswith("part-"):
                move_file(self.spark, f"{fresh}/{name}", f"{path}/{name}")
        create_file(self.spark, f"{gone}/{uuid.uuid4().hex}.txt", "\n".join(live))
        # Marks of expired versions outlive what they mark.
        for name in sorted((n for n in retired if n in names), key=lambda n: n.startswith("expired-")):
            delete_folder(self.spark, f"{path}/{name}")
        for name in lists:
            delete_folder(self.spark, f"{gone}/{name}")
        delete_folder(self.spark, fresh)

    # -- pages to fetch again -------------------------------------------------

    def save_failed(self, failed: DataFrame, table: str, run_ts: datetime, merged: bool = False, reported: int | None = None, landed: int | None = None) -> None:
        """Keep the list of pages that a pull lacked, empty or not.

        ``merged`` says that the other pages are in the current version, and ``reported`` and ``landed`` how many rows there were to be, and were.
        """
        numbers = [F.lit(merged).alias("merged"), F.lit(reported).cast("bigint").alias("reported"), F.lit(landed).cast("bigint").alias("landed")]
        # Where it is worked out it is written: one file for all would make one task look for them in all pages.
        failed.select("skip", "reason", *numbers).write.mode("overwrite").parquet(f"{self.root}/failed/{folder_name(table)}/{run_ts:%Y%m%d_%H%M%S_%f}")
        for run in sorted(folder_names(self.spark, f"{self.root}/failed/{folder_name(table)}"))[:-1]:
            delete_folder(self.spark, f"{self.root}/failed/{folder_name(table)}/{run}")

    def failed_list(self, table: str) -> DataFrame:
        """The list of the latest pull of a table as it was saved."""
        folder = f"{self.root}/failed/{folder_name(table)}"
        runs = sorted(folder_names(self.spark, folder))
        if not runs:
            return self.spark.createDataFrame([], "skip bigint, reason string, merged boolean, reported bigint, landed bigint")
        return self.spark.read.parquet(f"{folder}/{runs[-1]}")

    def failed_pages(self, table: str) -> DataFrame:
        """``skip`` and ``reason`` of the pages that the latest pull of a table lacked."""
        return self.failed_list(table).select("skip", "reason")


def labelled(versions: DataFrame, ts: str = "version_ts") -> DataFrame:
    """Versions with the text label of their time stamp."""
    return versions.withColumn("label", version_label(F.col(ts)))
