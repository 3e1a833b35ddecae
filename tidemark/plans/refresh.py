"""Refresh of one table or of a whole catalog."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.catalog import TableConfig
from tidemark.operators import drift, state
from tidemark.operators.merge import keep_known, keep_unknown
from tidemark.operators.profile import spark_classes
from tidemark.operators.shape import NO_FIELD, cast_all_to_string, incremental_filter, select_fields, union_by_name
from tidemark.operators.typing import inferred_classes, unfit_columns
from tidemark.plans.changes import append_change_log, diff_versions
from tidemark.session import delete_folder, one_row, side_by_side
from tidemark.sources import pages as landed
from tidemark.sources.buckets import merge_buckets, profile_of, publish_merged, unequal_buckets
from tidemark.sources.store import Conflict, VersionStore, moment


@dataclass
class Pull:
    """What a source gave: rows (none without a single field), whether all of them, and pages to ask for again."""

    rows: DataFrame | None
    complete: bool = True
    failed: DataFrame | None = None
    reported: int | None = None
    landed: int | None = None


class FrameSource:
    """A DataFrame (file, table or JDBC read) as the place rows come from.

    The date filter and the column choice reach the reader behind it.
    """

    can_reload = True

    def __init__(self, df: DataFrame):
        self.df = df

    def pull(self, cfg: TableConfig, min_date: str, folder: str) -> Pull:
        return Pull(select_fields(incremental_filter(self.df, cfg.field, min_date), extra=cfg.columns))

    def live_keys(self, cfg: TableConfig, folder: str) -> DataFrame | None:
        return select_fields(self.df, cfg.keys)

    def check(self, check_deletes: bool) -> None:
        """Any frame can serve deletes."""


class PageSource:
    """Landed pages as the place rows come from.

    ``pages`` has ``table_name``, ``skip`` and ``body``, or is a function that lands the pages from a first date on and returns them.
    Only a function can serve a reload: fixed pages hold what was asked for once. ``expected`` lists the pages that were asked for, or
    is a function of the first date too. ``key_pages`` are pages that hold the keys of all live rows, with ``expected_keys`` next to them;
    without them deletes cannot be told from rows that were not asked for. Only pages of the table at hand are looked at.
    ``retry`` lands the pages of a list of ``skip`` and ``reason`` again: it is asked once within a pull, and once more by ``retry_failed``.
    """

    def __init__(
        self,
        pages: DataFrame | Callable[[str], DataFrame],
        expected: DataFrame | Callable[[str], DataFrame] | None = None,
        fields: list[str] | None = None,
        key_pages: DataFrame | None = None,
        expected_keys: DataFrame | None = None,
        retry: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.pages = pages
        self.expected = expected
        self.fields = fields
        self.key_pages = key_pages
        self.expected_keys = expected_keys
        self.retry = retry

    @property
    def can_reload(self) -> bool:
        return callable(self.pages)

    def check(self, check_deletes: bool) -> None:
        if check_deletes and self.key_pages is None:
            raise ValueError("check_deletes needs key_pages: the keys of all live rows")

    def pull(self, cfg: TableConfig, min_date: str, folder: str) -> Pull:
        pages = self.pages(min_date) if callable(self.pages) else self.pages
        expected = self.expected(min_date) if callable(self.expected) else self.expected
        parsed = _parsed(pages, cfg.table_name, f"{folder}-pages")
        expected = None if expected is None else expected.filter(F.col("table_name") == cfg.table_name)
        failed = landed.failed_pages(parsed, expected)
        if self.retry is not None and not failed.isEmpty():
            again = _parsed(self.retry(failed.select("skip", "reason")), cfg.table_name, f"{folder}-again")
            # A page that came again in a readable form takes the place of the one that failed.
            parsed = keep_unknown(parsed, again.filter("readable"), "skip").unionByName(again.filter("readable"))
            failed = landed.failed_pages(parsed, expected)
        return self._pull(cfg, parsed, failed, min_date)

    def pull_failed(self, cfg: TableConfig, failed: DataFrame, min_date: str, folder: str) -> Pull:
        """The rows of pages that an earlier pull lacked, and those of the list that still do not come."""
        if self.retry is None:
            raise ValueError("the source has no way to land failed pages again")
        parsed = _parsed(self.retry(failed.select("skip", "reason")), cfg.table_name, f"{folder}-pages")
        came = parsed.filter("readable")
        return self._pull(cfg, came, keep_unknown(failed, came, "skip"), min_date)

    def _pull(self, cfg: TableConfig, parsed: DataFrame, failed: DataFrame, min_date: str) -> Pull:
        counts = landed.count_records(parsed).first()
        reported, number = (None, 0) if counts is None else (counts.reported, counts.landed)
        complete = failed.isEmpty() and (counts is None or counts.complete)
        fields = landed.fields_of(parsed) if self.fields is None else self.fields
        if not fields:
            return Pull(None, complete, failed, reported, number)
        rows = incremental_filter(landed.rows_of(parsed, fields), cfg.field if cfg.field in fields else None, min_date)
        return Pull(select_fields(rows, extra=[c for c in cfg.columns or [] if c in fields]), complete, failed, reported, number)

    def live_keys(self, cfg: TableConfig, folder: str) -> DataFrame | None:
        """Keys of all live rows; none if a page of them is missing."""
        parsed = _parsed(self.key_pages, cfg.table_name, f"{folder}/keys")
        expected = None if self.expected_keys is None else self.expected_keys.filter(F.col("table_name") == cfg.table_name)
        whole = landed.failed_pages(parsed, expected).isEmpty() and landed.count_records(parsed).filter("NOT complete").isEmpty()
        return landed.rows_of(parsed, cfg.keys) if whole else None


def _parsed(pages: DataFrame, table: str, folder: str) -> DataFrame:
    """The pages of one table, parsed once into ``folder``."""
    own = landed.parse_pages(pages.filter(F.col("table_name") == table)).drop("body")
    own.write.mode("overwrite").parquet(folder)
    return pages.sparkSession.read.schema(own.schema).parquet(folder)


@dataclass
class RefreshResult:
    table_name: str
    version_id: str | None
    reloaded: bool
    complete: bool
    latest_date: date | None
    reload_wanted: bool = False
    error: str | None = None


def _classes(df: DataFrame, cfg: TableConfig) -> dict[str, str]:
    return inferred_classes(df) if cfg.infer_classes else spark_classes(df)


def _drifted(delta: DataFrame, stored_classes: dict[str, str], cfg: TableConfig) -> bool:
    """Whether the delta has a new column or values that the stored classes cannot hold."""
    if not cfg.infer_classes:
        spark = delta.sparkSession
        schema = "var_name string, var_class string"
        sides = [spark.createDataFrame(list(c.items()), schema) for c in (stored_classes, spark_classes(delta))]
        return drift.needs_full_reload(*sides).first()[0]
    if set(delta.columns) - set(stored_classes):
        return True
    return bool(unfit_columns(delta, stored_classes))


def refresh_table(
    store: VersionStore,
    source: FrameSource | PageSource,
    cfg: TableConfig,
    replace: bool = False,
    check_deletes: bool = False,
    show_edits: bool = True,
) -> RefreshResult:
    """Bring the stored copy of a table up to date.

    Fetches what is new since the last date, reloads everything when columns or
    classes drifted, merges, and records what changed. The order of writes is
    rows, change record, manifest, state; a run that dies leaves the old version
    current and can simply be repeated.

    Rows are never lost to a pull that holds less than was asked for: where the source cannot serve a
    reload nothing is merged and the result says so, and a reload that is not complete leaves the version current that was there.
    """
    source.check(check_deletes)
    spark, table, now = store.spark, cfg.table_name, store.now()
    log = store.state_log()
    known = state.current_state(log).filter(F.col("table_name") == table).first()
    if known is None:
        store.log_state(state.initial_entry(spark, table, cfg.field, now))
    before, _ = store.head(table)
    base = before
    staged = f"{store.root}/staging/{now:%Y%m%d_%H%M%S_%f}"

    def start_over() -> None:
        target = one_row(spark, "table_name string, date_field string", (table, cfg.field))
        store.log_state(state.reset_state(store.state_log(), target, moment(store.now())))

    def stage(min_date: str, folder: str) -> tuple[DataFrame | None, Pull]:
        """Land the fetched rows once; every later step reads this copy."""
        pull = source.pull(cfg, min_date, folder)
        if pull.failed is not None:
            store.save_failed(pull.failed, table, now, False, pull.reported, pull.landed)
        if pull.rows is None:
            return None, pull
        rows = cast_all_to_string(pull.rows)
        rows.write.mode("overwrite").parquet(folder)
        return spark.read.schema(rows.schema).parquet(folder), pull

    def leave(result: RefreshResult) -> RefreshResult:
        delete_folder(spark, staged)
        return result

    changed_field = known is not None and known.date_field != cfg.field
    if changed_field and not replace and not source.can_reload and before is not None:
        return leave(RefreshResult(table, None, False, False, known.latest_date, reload_wanted=True))
    reloaded = replace or changed_field
    if reloaded:
        start_over()
        base = None
    since = state.FIRST_DATE if base is None or known is None else str(known.latest_date)
    delta, pull = stage(since, f"{staged}/delta")
    fetched = delta is not None and not delta.isEmpty()
    old_profile = None if before is None else store.profile(before.version_id)
    if base is not None and fetched:
        stored_classes = {r.var_name: r.var_class for r in old_profile.select("var_name", "var_class").collect()}
        stored_classes = stored_classes or _classes(store.open(base), cfg)
        if _drifted(delta, stored_classes, cfg):
            if not source.can_reload:
                return leave(RefreshResult(table, None, False, pull.complete, known.latest_date, reload_wanted=True))
            start_over()
            base, reloaded = None, True
            delta, pull = stage(state.FIRST_DATE, f"{staged}/reload")
            fetched = delta is not None and not delta.isEmpty()
    complete = pull.complete
    if base is None and before is not None and not complete:
        # Part of a table is no replacement for all of it.
        return leave(RefreshResult(table, None, False, False, None if reloaded else known.latest_date))

    live = None
    if check_deletes and complete:
        live = source.live_keys(cfg, staged)
        live = None if live is None else cast_all_to_string(live)
        live = None if live is None or live.isEmpty() else live

    version_id, latest = None, None if known is None or reloaded else known.latest_date
    if fetched or (base is not None and live is not None):
        while version_id is None:
            try:
                version_id, latest = merge_and_publish(store, cfg, base, before, delta, live, complete, now, latest, show_edits)
            except Conflict:
                # Another refresh came first: merge into what it left. A reload still replaces everything.
                before, _ = store.head(table)
                base = None if base is None else before

    if version_id is not None and pull.failed is not None and not complete:
        store.save_failed(pull.failed, table, now, True, pull.reported, pull.landed)
    _settle(store, cfg, latest, now)
    return leave(RefreshResult(table, version_id, reloaded, complete, latest))


def _settle(store: VersionStore, cfg: TableConfig, latest: date | None, now: datetime) -> None:
    """Move the state of a table on, and do the upkeep."""
    columns = "table_name string, latest_date date, updated timestamp_ntz, date_field string"
    entry = one_row(store.spark, columns, (cfg.table_name, latest, now, cfg.field))
    store.log_state(state.advance_state(store.state_log(), entry))
    store.expire(cfg.keep_versions, table=cfg.table_name)
    store.tidy(cfg.keep_change_logs)


def retry_failed(store: VersionStore, source: PageSource, cfg: TableConfig, show_edits: bool = True) -> RefreshResult | None:
    """Ask once more for the pages that the last pull of a table lacked, and merge what comes; none if it lacked none.

    The date moves only once no page of the list is missing and all rows that were reported have landed. A pull whose
    other pages were not merged (part of a table replaces nothing) is refused: it has to be pulled as a whole.
    """
    spark, table, now = store.spark, cfg.table_name, store.now()
    failed = store.scratch(store.failed_list(table), "failed")
    first = failed.first()
    if first is None:
        return None
    before, _ = store.head(table)
    if not first.merged or before is None:
        raise ValueError(f"the last pull of {table} was not merged, so its other pages are missing as well")
    known = store.state().filter(F.col("table_name") == table).first()
    staged = f"{store.root}/staging/{now:%Y%m%d_%H%M%S_%f}"
    pull = source.pull_failed(cfg, failed.select("skip", "reason"), str(known.latest_date), f"{staged}/delta")
    reported = max((n for n in (first.reported, pull.reported) if n is not None), default=None)
    number = (first.landed or 0) + (pull.landed or 0)
    complete = pull.failed.isEmpty() and reported == number
    store.save_failed(pull.failed, table, now, True, reported, number)
    version_id, latest = None, known.latest_date
    if pull.rows is not None:
        rows = cast_all_to_string(pull.rows)
        rows.write.mode("overwrite").parquet(f"{staged}/delta")
        delta = spark.read.schema(rows.schema).parquet(f"{staged}/delta")
        if _drifted(delta, {r.var_name: r.var_class for r in store.profile(before.version_id).collect()}, cfg):
            delete_folder(spark, staged)
            return RefreshResult(table, None, False, False, latest, reload_wanted=True)
        while version_id is None:
            try:
                version_id, latest = merge_and_publish(store, cfg, before, before, delta, None, complete, now, latest, show_edits)
            except Conflict:
                before, _ = store.head(table)
    elif complete and cfg.field != NO_FIELD:
        latest = before.latest_date if before.layout is None else store.bucket_list(before).agg(F.max("latest_date")).first()[0]
    _settle(store, cfg, latest, now)
    store.clear_scratch()
    delete_folder(spark, staged)
    return RefreshResult(table, version_id, False, complete, latest)


def merge_and_publish(
    store: VersionStore, cfg: TableConfig, base: Row | None, before: Row | None, delta: DataFrame | None, live: DataFrame | None,
    complete: bool, now: datetime, latest: date | None, show_edits: bool,
) -> tuple[str, date | None]:
    """Merge into ``base``, record what changed against ``before`` and publish, or raise ``Conflict``."""
    table = cfg.table_name
    held, number = store.head(table)
    if (before and before.version_id) != (held and held.version_id):
        raise Conflict(table)
    if delta is None:
        delta = store.open(base).limit(0)
    made = merge_buckets(store, cfg, base, delta, live)
    if complete:
        # The lists of buckets hold the latest date of every row that is there, replaced or not.
        latest = made.latest if cfg.field != NO_FIELD else None
    profile = profile_of(made.listing, made.schema, cfg.infer_classes, cfg.category_limit)
    store.save_profile(profile, table, made.version_id)
    now = now if before is None else max(now, before.version_ts + timedelta(microseconds=1))
    row = made.as_row(table)
    if before is not None:
        # Buckets that are the same in both versions are not read.
        uneven = unequal_buckets(store, row, before)
        new_part, old_part = store.open(row, uneven), store.open(before, uneven)
        if base is not None:
            new_part, old_part = _touched(new_part, delta, old_part, cfg.keys, live)
        record = diff_versions(new_part, old_part, cfg.keys, profile, store.profile(before.version_id), show_edits)
        append_change_log(store, record, table, now, cfg.keep_change_logs, row, before)
    attrs = {"created": now if before is None else before.created, "updated": now, "date_field": cfg.field, "latest_date": latest}
    publish_merged(store, cfg, made, number, attrs)
    return made.version_id, latest


def _touched(
    current: DataFrame, delta: DataFrame, old: DataFrame, keys: list[str], live: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """The rows of both versions that a merge can have changed: those with keys of the delta, and those deleted.

    All others are the same in both, so they are neither fingerprinted nor shuffled.
    """
    fresh = delta if live is None else keep_known(delta, live, keys)
    fresh = union_by_name(current.limit(0), fresh.distinct())
    replaced = keep_known(old, delta, keys)
    if live is not None:
        replaced = replaced.unionByName(keep_unknown(keep_unknown(old, delta, keys), live, keys))
    return fresh, replaced.distinct()


def refresh_all(
    store: VersionStore,
    tables: list[TableConfig],
    source_of: Callable[[TableConfig], FrameSource | PageSource],
    check_deletes: bool = False,
    width: int = 4,
) -> list[RefreshResult]:
    """Refresh every table of a catalog, up to ``width`` of them at a time, each in a scheduler pool of its own.

    Much of a refresh is small jobs over metadata, which leave a cluster idle; tables side by side fill it, and with
    ``spark.scheduler.mode=FAIR`` a large table does not hold the small ones up. A table that fails leaves the others alone: its
    result has the ``error``, its old version stays current, and the next run repeats it.
    """

    def one(cfg: TableConfig) -> RefreshResult:
        store.spark.sparkContext.setLocalProperty("spark.scheduler.pool", cfg.table_name)
        try:
            return refresh_table(store, source_of(cfg), cfg, check_deletes=check_deletes)
        except Exception as failed:  # noqa: BLE001
            store.clear_scratch()
            return RefreshResult(cfg.table_name, None, False, False, None, error=f"{type(failed).__name__}: {failed}".split("\n")[0])

    return side_by_side(store.spark, [lambda cfg=cfg: one(cfg) for cfg in tables], width)
