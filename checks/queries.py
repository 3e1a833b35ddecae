"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.fixtures import Tables
from tidemark.catalog import config
from tidemark.functions import text
from tidemark.operators import diff, drift, merge, profile, ranges, shape, state, typing, versions
from tidemark.plans import changes, clean, extract, refresh, replay
from tidemark.session import apply_settings, new_folder
from tidemark.sources import buckets, declared, pages, planned
from tidemark.sources.store import VersionStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = "o_orderkey"
MIN_DATE = "2000-01-01"


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(apply_settings(spark), folder))
    return build


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Dates shown as text, so that both engines print them alike."""
    return df.select(
        *[F.col(f"`{n}`").cast("string").alias(n) if kind == "date" else F.col(f"`{n}`") for n, kind in df.dtypes]
    )


def _new_store(t: Tables, name: str) -> VersionStore:
    return VersionStore(t.spark, new_folder(t.spark, name))


# -- sources ----------------------------------------------------------------


def _order_pages(t: Tables) -> DataFrame:
    """A page per order: two records of unlike shape, none for one status."""
    first = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.struct(F.col("o_custkey").alias("id")).alias("who"),
    )
    second = F.struct(
        (-F.col("o_orderkey") - 1).alias("id"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("struct<id: bigint>").alias("who"),
    )
    records = F.array(first, second)
    empty = F.filter(records, lambda r: F.lit(False))
    body = F.to_json(
        F.struct(
            F.lit(2).alias(pages.COUNT_FIELD),
            F.when(F.col("o_orderstatus") == "P", empty).otherwise(records).alias(pages.ROWS_FIELD),
        )
    )
    return t.orders.select(
        F.col("o_orderpriority").alias("table_name"), F.col(KEY).alias("skip"), "o_orderstatus", "o_custkey", body.alias("body")
    )


@query
def read_pages(t: Tables) -> DataFrame:
    return pages.read_landed_pages(_order_pages(t))


@query
def read_page_files(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "pages")
    _order_pages(t).select("body").write.text(folder)
    # Primitives are read as text, so the nested id is quoted here.
    return pages.read_json_pages(t.spark, folder, multi_line=False)


@query
def quarantine_pages(t: Tables) -> DataFrame:
    landed = _order_pages(t).filter("o_orderstatus <> 'F'")
    broken = F.when(F.col("o_orderstatus") == "P", F.lit("<html>503</html>")).otherwise(F.col("body"))
    return pages.quarantine_pages(landed.withColumn("body", broken), _order_pages(t).select("table_name", "skip"))


@query
def expected_pages(t: Tables) -> DataFrame:
    counts = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("table_name")).agg(F.count("*").alias("total"))
    return pages.expected_pages(counts, 100)


@query
def reconcile_counts(t: Tables) -> DataFrame:
    totals = t.orders.groupBy("o_custkey").agg(F.count("*").alias("total"))
    record = F.to_json(F.struct(F.col("total").alias(pages.COUNT_FIELD), F.array(F.struct(F.col(KEY).alias("id"))).alias("value")))
    broken = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    landed = t.orders.join(totals, "o_custkey").select(
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("table_name"),
        F.when(broken, F.lit("<html>503</html>")).otherwise(record).alias("body"),
    )
    return pages.reconcile_counts(landed)


@query
def version_roundtrip(t: Tables) -> DataFrame:
    store = _new_store(t, "store")
    store.write_version(t.orders, "orders", datetime(2002, 1, 1))
    store.write_version(t.derive(fx.NEW_ORDERS), "orders", datetime(2002, 1, 2))
    current = store.read_version("orders").withColumn("seen_as", F.lit("current"))
    first = store.read_version("orders", datetime(2002, 1, 1)).withColumn("seen_as", F.lit("first"))
    return shape.union_by_name(current, first)


def _schema_lines(t: Tables) -> DataFrame:
    """An XML type per customer, whose columns depend on the customer."""
    kinds = {"BUILDING": "Boolean", "FURNITURE": "DateTime", "MACHINERY": "Decimal", "HOUSEHOLD": "Guid"}
    kind = F.lit("Stream")
    for segment, name in kinds.items():
        kind = F.when(F.col("c_mktsegment") == segment, F.lit(name)).otherwise(kind)
    line = F.concat(
        F.lit('<EntityType Name="ApiV2'), F.col("c_name"), F.lit('"><Property Name="Id" Type="Edm.Int64"/><Property Name="c'),
        F.col("c_nationkey").cast("string"), F.lit('" Type="Edm.'), kind, F.lit('"/></EntityType>'),
    )
    return t.customer.select(line.alias("value"))


@query
def declared_types(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "schema")
    _schema_lines(t).write.text(folder)
    return declared.read_declared_types(t.spark, folder, multi_line=False)


@query
def map_declared_types(t: Tables) -> DataFrame:
    documents = _schema_lines(t).select(F.concat(F.lit("<Schema>"), "value", F.lit("</Schema>")).alias("body"))
    return declared.map_declared_types(declared.parse_declared_types(documents))


@query
def apply_declared_types(t: Tables) -> DataFrame:
    names = {"c_custkey": "Int64", "c_name": "String", "c_acctbal": "Double", "c_mktsegment": "Boolean"}
    types = t.customer.select(
        F.lit("customer").alias("table"),
        F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.lit(k).alias("edm_type")) for n, k in names.items()])),
    ).distinct()
    raw = shape.cast_all_to_string(t.customer)
    flag = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" TRUE")).otherwise(F.lit("F"))
    return declared.apply_declared_types(raw.withColumn("c_mktsegment", flag), types, "customer")


@query
def snapshot_all(t: Tables) -> DataFrame:
    store = _new_store(t, "store")
    store.write_version(t.customer.toDF("key", "name", "nation", "balance", "segment"), "customer", datetime(2002, 1, 1))
    store.write_version(t.supplier.toDF("key", "name", "nation", "balance"), "supplier", datetime(2002, 1, 1))
    label = store.snapshot_all(datetime(2002, 1, 2, 3, 4, 5))
    copies = [store.read_snapshot(label, n).withColumn("table_name", F.lit(n)) for n in ("customer", "supplier")]
    return shape.union_by_name(*copies).withColumn("label", F.lit(label))


# -- projections and filters --------------------------------------------------


@query
def incremental_filter(t: Tables) -> DataFrame:
    return shape.incremental_filter(t.derive(fx.NEW_ORDERS), "o_orderdate", MIN_DATE)


@query
def select_keys(t: Tables) -> DataFrame:
    return shape.select_fields(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def common_columns(t: Tables) -> DataFrame:
    new, old = shape.common_columns(t.derive(fx.NEW_ORDERS), t.orders)
    return new.unionByName(old)


@query
def cast_all_to_string(t: Tables) -> DataFrame:
    return shape.cast_all_to_string(t.lineitem)


@query
def normalize_column_names(t: Tables) -> DataFrame:
    return shape.normalize_column_names(
        t.customer.toDF("CustKey", "Straßen Name", "# Nation", " % Balance", "WHORegion"), "snake"
    )


@query
def rename_by_synonyms(t: Tables) -> DataFrame:
    kinds = t.customer.groupBy("c_mktsegment").count().select(F.lit("customer").alias("table_name"))
    words = kinds.select("*", F.inline(F.array(
        F.struct(F.lit("c_custkey").alias("original_var_name"), F.lit("customer_key").alias("long")),
        F.struct(F.lit("c_acctbal").alias("original_var_name"), F.lit("account_balance").alias("long")),
        F.struct(F.lit("s_acctbal").alias("original_var_name"), F.lit("supplier_balance").alias("long")),
    )))
    return shape.rename_by_synonyms(t.customer, words, "customer", "long")


def _with_empty_rows(t: Tables) -> DataFrame:
    empty = F.col("c_mktsegment") == "BUILDING"
    return t.customer.select(*[F.when(~empty, F.col(n)).alias(n) for n in t.customer.columns])


@query
def drop_empty_rows(t: Tables) -> DataFrame:
    return shape.drop_empty_rows(_with_empty_rows(t))


@query
def drop_empty_columns(t: Tables) -> DataFrame:
    kept = shape.drop_empty_columns(_with_empty_rows(t).withColumn("c_empty", F.lit(None).cast("string")))
    return shape.cast_all_to_string(kept)


# -- joins --------------------------------------------------------------------


def delta_orders(t: Tables) -> DataFrame:
    """Rows of the new orders that an incremental fetch returns."""
    return shape.incremental_filter(t.derive(fx.NEW_ORDERS), "o_orderdate", MIN_DATE)


@query
def upsert(t: Tables) -> DataFrame:
    return merge.upsert(t.orders, delta_orders(t), KEY)


def _live_keys(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias(KEY))


@query
def upsert_with_deletes(t: Tables) -> DataFrame:
    return merge.upsert(t.orders, delta_orders(t), KEY, live_keys=_live_keys(t), old_is_distinct=True)


@query
def reconcile_deletes(t: Tables) -> DataFrame:
    return merge.reconcile_deletes(t.orders, _live_keys(t), KEY)


@query
def count_deleted(t: Tables) -> DataFrame:
    return merge.count_deleted(t.orders, _live_keys(t), KEY)


@query
def rows_added(t: Tables) -> DataFrame:
    return diff.rows_added(t.derive(fx.NEW_ORDERS), t.orders, KEY)


@query
def rows_deleted(t: Tables) -> DataFrame:
    return diff.rows_deleted(t.derive(fx.NEW_ORDERS), t.orders, KEY)


@query
def changed_keys(t: Tables) -> DataFrame:
    return diff.changed_keys(t.derive(fx.NEW_ORDERS), t.orders, KEY)


@query
def cells_edited(t: Tables) -> DataFrame:
    return diff.cells_edited(t.derive(fx.NEW_ORDERS), t.orders, KEY)


def _nested(t: Tables, sql: str) -> DataFrame:
    """Orders with a list and a struct that hold nulls."""
    late, status = F.when(F.col("o_orderdate").isNotNull(), F.col("o_custkey")), F.col("o_orderstatus")
    urgent = F.when(F.col("o_orderpriority").isNotNull(), F.col("o_custkey"))
    pair = F.struct(late.alias("a"), urgent.alias("b"))
    return t.derive(sql).select(KEY, F.array(late, urgent).alias("list"), pair.alias("pair"), F.array(F.struct(status.alias("s"), late.alias("d"))).alias("deep"))


@query
def cells_edited_nested(t: Tables) -> DataFrame:
    return diff.cells_edited(_nested(t, fx.NEW_ORDERS), _nested(t, fx.SAME_ORDERS), KEY)


def _customer_profiles(t: Tables) -> tuple[DataFrame, DataFrame]:
    return profile.describe_table(t.derive(fx.OLD_CUSTOMER)), profile.describe_table(t.derive(fx.NEW_CUSTOMER))


def _customer_drift(t: Tables) -> DataFrame:
    return drift.schema_diff(*_customer_profiles(t))


@query
def schema_diff(t: Tables) -> DataFrame:
    return _customer_drift(t).select("var_name", "old_var_class", "new_var_class")


@query
def profile_with_sets(t: Tables) -> DataFrame:
    joined = profile.profile_with_sets(profile.profile_columns(t.lineitem), profile.category_sets(t.lineitem))
    return joined.withColumn("values", text.render_set(F.col("values")))


# -- aggregations -------------------------------------------------------------


@query
def max_date_watermark(t: Tables) -> DataFrame:
    raw = shape.cast_all_to_string(t.derive(fx.NEW_ORDERS))
    return _dates_as_text(profile.max_date_watermark(raw, "o_orderdate"))


@query
def profile_columns(t: Tables) -> DataFrame:
    return profile.profile_columns(t.derive(fx.NEW_ORDERS))


@query
def profile_texts(t: Tables) -> DataFrame:
    return profile.profile_columns(t.documents)


@query
def category_sets(t: Tables) -> DataFrame:
    sets = profile.category_sets(t.derive(fx.NEW_ORDERS))
    return sets.select("var_name", "n_unique", text.render_set(F.col("values")).alias("values"), "has_null")


@query
def change_counts(t: Tables) -> DataFrame:
    new, old = t.derive(fx.NEW_ORDERS), t.orders
    return diff.change_counts(
        diff.rows_added(new, old, KEY), diff.cells_edited(new, old, KEY), diff.rows_deleted(new, old, KEY), KEY
    )


@query
def infer_types(t: Tables) -> DataFrame:
    return typing.infer_types(shape.cast_all_to_string(t.derive(fx.LADDER)))


@query
def infer_types_sampled(t: Tables) -> DataFrame:
    drifting = F.when(F.col(KEY) < 1000, F.col("whole")).otherwise(F.col("price"))
    return typing.infer_types_sampled(t.derive(fx.LADDER).withColumn("drifting", drifting), KEY)


@query
def demote_midnight_timestamps(t: Tables) -> DataFrame:
    days = typing.demote_midnight_timestamps(t.orders.select(KEY, "o_custkey", "o_orderdate").withColumn(
        "stamp", F.timestamp_add("HOUR", F.col("o_custkey").cast("int"), F.col("o_orderdate"))))
    return days.select(KEY, F.col("o_orderdate").cast("string").alias("day"), F.col("stamp").cast("string").alias("stamp"))


@query
def dedup_all(t: Tables) -> DataFrame:
    return merge.dedup_all(t.documents.unionByName(t.documents))


@query
def dedup_keys(t: Tables) -> DataFrame:
    return merge.dedup_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# -- windows ------------------------------------------------------------------


@query
def id_islands(t: Tables) -> DataFrame:
    return ranges.id_islands(t.lineitem, "l_orderkey")


@query
def id_islands_sparse(t: Tables) -> DataFrame:
    spread = t.labels.select((F.col("doc_id") * 65535).alias("id")).unionByName(
        t.labels.select((F.col("doc_id") * 65535 + 1).alias("id"))
    )
    return ranges.id_islands(spread, "id")


@query
def id_range_chunks(t: Tables) -> DataFrame:
    return ranges.id_range_chunks(ranges.id_islands(t.lineitem, "l_orderkey"), 7, "l_orderkey")


@query
def latest_version(t: Tables) -> DataFrame:
    return versions.latest_version(t.derive(fx.VERSIONS), tie="version_id")


@query
def version_as_of(t: Tables) -> DataFrame:
    return versions.version_as_of(t.derive(fx.VERSIONS), "1997-12-31", tie="version_id")


@query
def tables_without_version(t: Tables) -> DataFrame:
    return versions.tables_without_version(t.derive(fx.VERSIONS), "1995-12-31")


@query
def retain_latest_n(t: Tables) -> DataFrame:
    return versions.retain_latest_n(t.derive(fx.VERSIONS), 3, tie="version_id")


# -- ordered samples ----------------------------------------------------------


@query
def sample_first(t: Tables) -> DataFrame:
    return shape.sample_rows(t.events, 1000, "first", "event_id")


@query
def sample_last(t: Tables) -> DataFrame:
    return shape.sample_rows(t.events, 1000, "last", "event_id")


@query
def sample_random(t: Tables) -> DataFrame:
    return shape.sample_rows(t.events, 1000, "random", "event_id", seed=7)


@query
def sample_first_many(t: Tables) -> DataFrame:
    return shape.sample_rows(t.lineitem, 5000, "first", ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query
def sample_random_many(t: Tables) -> DataFrame:
    return shape.sample_rows(t.events, 5000, "random", "event_id", seed=11)


@query
def first_by(t: Tables) -> DataFrame:
    return shape.first_by(t.orders, F.col("o_totalprice").desc(), F.col(KEY), n=25)


# -- sets ---------------------------------------------------------------------


@query
def union_by_name(t: Tables) -> DataFrame:
    return shape.union_by_name(t.derive(fx.NEW_ORDERS), t.orders)


@query
def rows_except(t: Tables) -> DataFrame:
    changed = t.lineitem.withColumn("l_linestatus", F.when(F.col("l_returnflag") == "R", "X").otherwise(F.col("l_linestatus")))
    return shape.rows_except(t.lineitem, changed)


@query
def value_set_compare(t: Tables) -> DataFrame:
    sets = drift.value_set_compare(
        F.col("old_values"), F.col("new_values"), F.col("old_has_null"), F.col("new_has_null")
    )
    known = _customer_drift(t).filter("old_values IS NOT NULL AND new_values IS NOT NULL")
    return known.select("var_name", *[c.alias(n) for n, c in sets.items()])


# -- scalar functions ---------------------------------------------------------


@query
def trim_all(t: Tables) -> DataFrame:
    return clean.trim_all(t.derive(fx.DIRTY_CUSTOMER)).toDF("key", "name", "balance", "nation")


@query
def blank_to_null(t: Tables) -> DataFrame:
    return clean.blank_to_null(t.derive(fx.DIRTY_CUSTOMER)).toDF("key", "name", "balance", "nation")


@query
def latin_ascii(t: Tables) -> DataFrame:
    return clean.latin_ascii(t.documents)


@query
def apply_types(t: Tables) -> DataFrame:
    raw = t.derive(fx.LADDER)
    typed = typing.apply_types(raw, typing.inferred_classes(raw))
    return _dates_as_text(typed.withColumn("nothing", F.col("nothing").cast("string")))


@query
def date_prefix(t: Tables) -> DataFrame:
    raw = t.derive(fx.LADDER)
    return raw.select(
        KEY,
        text.date_prefix(F.col("moment")).cast("string").alias("from_moment"),
        text.date_prefix(F.col("words")).cast("string").alias("from_words"),
    )


@query
def version_label(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", text.version_label(F.col("ts")).alias("label"), text.snapshot_label(F.col("ts")).alias("snapshot")
    )


@query
def render_set(t: Tables) -> DataFrame:
    members = F.array(F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_clerk"))
    return t.derive(fx.NEW_ORDERS).select(KEY, text.render_set(members).alias("shown"))


@query
def strip_affix(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        text.strip_affix(F.col("p_brand"), "Brand#", "prefix").alias("brand"),
        text.strip_affix(F.col("p_name"), " ring", "suffix").alias("name"),
        text.strip_affix(F.col("p_type"), "A").alias("type"),
    )


@query
def match_pattern(t: Tables) -> DataFrame:
    return shape.filter_matching(t.part, "p_name", "^(small|red) .*t$")


# -- reshape ------------------------------------------------------------------


@query
def to_long(t: Tables) -> DataFrame:
    return shape.to_long(t.derive(fx.NEW_ORDERS), KEY)


@query
def to_wide(t: Tables) -> DataFrame:
    long = shape.to_long(t.derive(fx.NEW_ORDERS), KEY)
    return shape.to_wide(long, KEY, "name", "value", ["o_orderstatus", "o_orderpriority", "o_clerk"])


@query
def to_wide_lists(t: Tables) -> DataFrame:
    wide = shape.to_wide(t.lineitem, "l_orderkey", "l_returnflag", "l_linenumber", ["A", "N", "R"], multi=True)
    return wide.select("l_orderkey", *[text.render_set(F.col(n)).alias(n) for n in ("A", "N", "R")])


# -- drift --------------------------------------------------------------------


@query
def new_columns(t: Tables) -> DataFrame:
    return drift.new_columns(_customer_drift(t))


@query
def lost_columns(t: Tables) -> DataFrame:
    return drift.lost_columns(_customer_drift(t))


@query
def class_changes(t: Tables) -> DataFrame:
    return drift.class_changes(_customer_drift(t))


@query
def new_categories(t: Tables) -> DataFrame:
    return drift.new_categories(_customer_drift(t))


@query
def needs_full_reload(t: Tables) -> DataFrame:
    return drift.needs_full_reload(*_customer_profiles(t))


# -- state --------------------------------------------------------------------


def _show_state(df: DataFrame) -> DataFrame:
    names = ["table_name", "updated", "file_name", "latest_date", "date_field", "has_version"]
    return _dates_as_text(df.select(*[n for n in names if n in df.columns]))


@query
def current_state(t: Tables) -> DataFrame:
    return _show_state(state.current_state(t.derive(fx.STATE_LOG), tie="entry"))


@query
def advance_state(t: Tables) -> DataFrame:
    updates = t.customer.select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("table_name"),
        F.date_add(F.lit("2002-01-01").cast("date"), F.col("c_nationkey")).alias("latest_date"),
        F.lit("2002-03-01 00:00:00").cast("timestamp_ntz").alias("updated"),
        F.col("c_mktsegment").alias("date_field"),
    )
    return _show_state(state.advance_state(t.derive(fx.STATE_LOG), updates, tie="entry"))


@query
def reset_state(t: Tables) -> DataFrame:
    log = t.derive(fx.STATE_LOG)
    tables = t.customer.filter("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("table_name"), F.lit("Changed").alias("date_field")
    )
    at = F.lit("2002-03-01 00:00:00").cast("timestamp_ntz")
    entries = state.reset_state(log, tables, at, tie="entry").withColumn("entry", F.lit(-1).cast("bigint"))
    return _show_state(state.current_state(log.unionByName(entries), tie="entry"))


@query
def rebuild_state(t: Tables) -> DataFrame:
    log = t.derive(fx.STATE_LOG)
    now = state.current_state(log, tie="entry")
    earlier = versions.version_as_of(log, "1996-06-30", ts="logged_at", tie="entry")
    return _show_state(state.rebuild_state(now, earlier))


# -- whole plans --------------------------------------------------------------


@query
def clean_table(t: Tables) -> DataFrame:
    return clean.clean_table(t.derive(fx.DIRTY_CUSTOMER))


@query
def clean_documents(t: Tables) -> DataFrame:
    return clean.clean_table(t.documents)


@query
def refresh_table(t: Tables) -> DataFrame:
    store = _new_store(t, "store")
    cfg = config("orders", KEY, "o_orderdate")
    refresh.refresh_table(store, refresh.FrameSource(t.orders), cfg)
    later = t.derive(fx.NEW_ORDERS).drop("o_clerk")
    refresh.refresh_table(store, refresh.FrameSource(later), cfg, check_deletes=True)
    return store.read_version("orders")


@query
def refresh_with_drift(t: Tables) -> DataFrame:
    store = _new_store(t, "store")
    cfg = config("orders", KEY, "o_orderdate")
    refresh.refresh_table(store, refresh.FrameSource(t.orders), cfg)
    refresh.refresh_table(store, refresh.FrameSource(t.derive(fx.NEW_ORDERS)), cfg)
    return store.read_version("orders")


def _pages_of(df: DataFrame, by: str, table: str = "orders") -> DataFrame:
    """Landed pages that hold the rows of ``df``, one per value of ``by``, next to a page of another table."""
    texts = shape.cast_all_to_string(df)
    records = texts.groupBy(F.col(by).cast("bigint").alias("skip")).agg(F.collect_list(F.struct(*texts.columns)).alias(pages.ROWS_FIELD))
    body = F.to_json(F.struct(F.lit(df.count()).alias(pages.COUNT_FIELD), pages.ROWS_FIELD))
    own = records.select(F.lit(table).alias("table_name"), "skip", body.alias("body"))
    other = F.to_json(F.struct(F.lit(9).alias(pages.COUNT_FIELD), F.array(F.struct(F.lit("x").alias("other"))).alias(pages.ROWS_FIELD)))
    return own.unionByName(own.limit(1).select(F.lit("other").alias("table_name"), "skip", other.alias("body")))


def _first_pull(t: Tables):
    store, cfg = _new_store(t, "store"), config("orders", KEY, "o_orderdate")
    refresh.refresh_table(store, refresh.PageSource(_pages_of(t.orders, "o_custkey")), cfg)
    return store, cfg


@query
def refresh_pages_incremental(t: Tables) -> DataFrame:
    store, cfg = _first_pull(t)
    later = t.derive(fx.NEW_ORDERS).drop("o_clerk")
    refresh.refresh_table(store, refresh.PageSource(_pages_of(later, "o_custkey")), cfg)
    return store.read_version("orders")


@query
def refresh_pages_drift(t: Tables) -> DataFrame:
    store, cfg = _first_pull(t)
    wider = _pages_of(t.derive(fx.NEW_ORDERS), "o_custkey")
    done = refresh.refresh_table(store, refresh.PageSource(wider), cfg)
    kept = store.read_version("orders").withColumn("step", F.lit(f"reload wanted {done.reload_wanted}"))
    done = refresh.refresh_table(store, refresh.PageSource(lambda min_date: wider), cfg)
    return shape.union_by_name(kept, store.read_version("orders").withColumn("step", F.lit(f"reloaded {done.reloaded}")))


@query
def refresh_pages_deletes(t: Tables) -> DataFrame:
    store, cfg = _first_pull(t)
    later = t.derive(fx.NEW_ORDERS).drop("o_clerk")
    delta = shape.incremental_filter(later, "o_orderdate", str(store.state().first().latest_date))
    keys = _pages_of(later.select(KEY, "o_custkey"), "o_custkey")
    refresh.refresh_table(store, refresh.PageSource(_pages_of(delta, "o_custkey"), key_pages=keys), cfg, check_deletes=True)
    return store.read_version("orders")


@query
def refresh_pages_incomplete(t: Tables) -> DataFrame:
    store, cfg = _first_pull(t)
    whole = _pages_of(t.derive(fx.NEW_ORDERS), "o_custkey")
    broken = whole.withColumn("body", F.when(F.col("skip") % 7 == 3, F.lit("<html>503</html>")).otherwise(F.col("body")))
    landed = broken.filter("skip % 11 <> 5")
    done = refresh.refresh_table(store, refresh.PageSource(landed, expected=whole.select("table_name", "skip")), cfg, replace=True)
    rows = store.read_version("orders").withColumn("complete", F.lit(done.complete))
    return shape.union_by_name(rows, store.failed_pages("orders").select(F.col("skip").cast("string").alias("skip"), "reason"))


@query
def refresh_all(t: Tables) -> DataFrame:
    store = _new_store(t, "store")
    tables = [
        config("customer", "c_custkey"),
        config("orders", "o_orderkey", "o_orderdate"),
        config("events", "event_id", "ts"),
    ]
    refresh.refresh_all(store, tables, lambda cfg: refresh.FrameSource(getattr(t, cfg.table_name)))
    counts = [
        store.read_version(cfg.table_name).agg(F.count("*").alias("n")).select(F.lit(cfg.table_name).alias("table_name"), "n")
        for cfg in tables
    ]
    known = store.state().select("table_name", F.col("latest_date").cast("string").alias("latest_date"), "date_field")
    return shape.union_by_name(*counts).join(known, "table_name")


@query
def append_change_log(t: Tables) -> DataFrame:
    store = _new_store(t, "store")
    run = datetime(2002, 1, 2)
    record = changes.diff_versions(t.derive(fx.NEW_ORDERS), t.orders, KEY)
    changes.append_change_log(store, record, "orders", run)
    edited = store.read_rows("edited", "orders", run)
    moved = [store.read_rows(k, "orders", run).select(KEY, F.lit(k).alias("name"), F.col("o_orderstatus").alias("new")) for k in ("added", "deleted")]
    edited = shape.union_by_name(edited, *moved)
    counts = store.records("counts").select("table_name", "n_added", "n_edited", "n_deleted")
    return shape.cast_all_to_string(shape.union_by_name(edited, counts))


@query
def tables_with_changes(t: Tables) -> DataFrame:
    return changes.tables_with_changes(t.derive(fx.CHANGE_COUNTS), tie="entry")


@query
def latest_change_summary(t: Tables) -> DataFrame:
    """Two runs of one table and one of another; what the earlier run held is not in the summary."""
    store = _new_store(t, "store")
    old, new = t.derive(fx.OLD_CUSTOMER), t.derive(fx.NEW_CUSTOMER)
    changes.append_change_log(store, changes.diff_versions(old, new, "c_custkey"), "customer", datetime(2002, 1, 2))
    changes.append_change_log(store, changes.diff_versions(new, old, "c_custkey"), "customer", datetime(2002, 1, 3))
    changes.append_change_log(store, changes.diff_versions(t.derive(fx.NEW_ORDERS), t.orders, KEY), "orders", datetime(2002, 1, 2))
    parts = changes.latest_change_summary(store)
    shown = {
        "counts": ("n_edited", "concat_ws(' ', n_added, n_deleted)"), "new_columns": ("var_name", "NULL"), "lost_columns": ("var_name", "NULL"),
        "class_changes": ("var_name", "concat(old_var_class, ' ', new_var_class)"), "new_categories": ("var_name", "in_new_not_old"),
    }
    out = [parts[k].select("table_name", F.lit(k).alias("element"), F.expr(f"CAST({a} AS string) AS item"), F.expr(f"CAST({b} AS string) AS detail")) for k, (a, b) in shown.items()]
    return shape.union_by_name(*out)


@query
def diff_versions_repeated_keys(t: Tables) -> DataFrame:
    """Line items, of which many share their key; the rest is compared all the same."""
    later = t.lineitem.withColumn("l_returnflag", F.when(F.col("l_returnflag") == "R", "X").otherwise(F.col("l_returnflag")))
    record = changes.diff_versions(later, t.lineitem, ["l_orderkey", "l_linenumber"])
    found = shape.union_by_name(record.repeated.withColumn("part", F.lit("repeated")), record.edited.withColumn("part", F.lit("edited")))
    return shape.union_by_name(found, record.counts.withColumn("part", F.lit("counts")))


@query
def plan_extraction(t: Tables) -> DataFrame:
    by_ids = extract.plan_extraction(config("orders", "l_orderkey", "l_shipdate"), t.lineitem.select("l_orderkey"), width=7)
    by_pages = extract.plan_extraction(config("lineitem", "l_orderkey", page_size=500), t.lineitem.select("l_orderkey"))
    return by_ids.unionByName(by_pages)


@query
def read_page_files_empty(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "pages")
    empty = F.to_json(F.struct(F.lit(0).alias(pages.COUNT_FIELD), F.filter(F.array(F.struct("o_custkey")), lambda r: F.lit(False)).alias(pages.ROWS_FIELD)))
    landed = t.orders.select(empty.alias("body"))
    landed.write.text(folder)
    by_reader = pages.read_json_pages(t.spark, folder, multi_line=False).agg(F.count("*").alias("n")).withColumn("reader", F.lit("files"))
    by_body = pages.read_landed_pages(landed).agg(F.count("*").alias("n")).withColumn("reader", F.lit("column"))
    return by_reader.unionByName(by_body)


@query
def unfit_columns(t: Tables) -> DataFrame:
    """Columns of a delta that the classes of the stored rows cannot hold; stricter values fit."""
    stored = shape.cast_all_to_string(t.derive(fx.LADDER))
    delta = stored.withColumn("whole", F.when(F.col("flag") == "T", "1.5").otherwise(F.col("whole"))).withColumn("price", F.col("whole")).withColumn("code", F.lit(None).cast("string"))
    delta = delta.withColumn("price", F.when(F.col("flag") == "T", "7").otherwise(F.col("price"))).withColumn("day", F.col("clock"))
    found = typing.unfit_columns(delta, typing.inferred_classes(stored))
    return t.spark.createDataFrame([(n,) for n in found], "unfit string")


@query
def refresh_pages_retry(t: Tables) -> DataFrame:
    """Pages that failed are asked for once more; only then does the date move."""
    store, cfg = _new_store(t, "store"), config("orders", KEY, "o_orderdate")
    whole = _pages_of(t.orders, "o_custkey")
    broken = whole.withColumn("body", F.when(F.col("skip") % 7 == 3, F.lit("<html>503</html>")).otherwise(F.col("body")))
    source = refresh.PageSource(broken.filter("skip % 11 <> 5"), expected=whole.select("table_name", "skip"))
    first = refresh.refresh_table(store, source, cfg)
    source.retry = lambda failed: whole.join(failed, "skip", "left_semi").select("table_name", "skip", "body")
    last = refresh.retry_failed(store, source, cfg)
    told = f"complete {first.complete} {last.complete}, failed {store.failed_pages('orders').count()}, dated {first.latest_date}"
    dated = F.lit(str(store.state().first().latest_date)).alias("latest_date")
    return store.read_version("orders").select("*", F.lit(told).alias("told"), dated)


@query
def profile_after_refresh(t: Tables) -> DataFrame:
    """The profile that a refresh keeps up from its buckets; no row of the version is read for it."""
    store, cfg = _new_store(t, "store"), config("orders", KEY, "o_orderdate")
    refresh.refresh_table(store, refresh.FrameSource(t.orders), cfg)
    refresh.refresh_table(store, refresh.FrameSource(t.derive(fx.NEW_ORDERS).drop("o_clerk")), cfg, check_deletes=True)
    held = store.current("orders")
    kept = buckets.profile_of(store.bucket_list(held), buckets.schema_of(held), infer=False)
    return kept.select("var_name", "var_class", "n_unique", "has_null", text.render_set(F.col("values")).alias("values"))


@query
def diff_versions_buckets(t: Tables) -> DataFrame:
    """Two stored versions of all line items, of which only unlike buckets are compared."""
    store, cfg = _new_store(t, "store"), config("lineitem", ["l_orderkey", "l_linenumber"], "l_shipdate")
    first = buckets.publish_merged(store, cfg, buckets.merge_buckets(store, cfg, None, t.lineitem))
    base, number = store.head("lineitem")
    later = t.lineitem.filter("l_returnflag = 'R'").withColumn("l_returnflag", F.lit("X"))
    second = buckets.publish_merged(store, cfg, buckets.merge_buckets(store, cfg, base, later), number)
    record = changes.diff_stored(store, second, first, cfg.keys)
    found = shape.union_by_name(record.repeated.withColumn("part", F.lit("repeated")), record.edited.withColumn("part", F.lit("edited")))
    return shape.union_by_name(found, record.counts.withColumn("part", F.lit("counts")))


@query
def refresh_all_tables(t: Tables) -> DataFrame:
    """Whole tables refreshed side by side; one that cannot be read leaves the others alone."""
    store = _new_store(t, "store")
    tables = [config("customer", "c_custkey"), config("missing", "id"), config("supplier", "s_suppkey"), config("orders", KEY, "o_orderdate")]
    done = refresh.refresh_all(store, tables, lambda cfg: refresh.FrameSource(t.spark.read.parquet(f"{t.folder}/{cfg.table_name}.parquet")))
    failed = ", ".join(r.table_name for r in done if r.error)
    rows = [store.read_version(n) for n in ("customer", "supplier", "orders")]
    return shape.union_by_name(*rows).withColumn("failed", F.lit(failed))


def _read_planned(t: Tables, method: str) -> DataFrame:
    path = f"{t.folder}/lineitem.parquet".removeprefix("file:")
    cfg = config("lineitem", "l_orderkey", page_size=5000)
    requests = planned.plan_requests(cfg, t.lineitem.select("l_orderkey"), method, width=20_000)
    fetch = planned.pages_of_parquet(path) if method == extract.BY_PAGES else planned.ranges_of_parquet(path, "l_orderkey")
    return planned.read_planned(t.spark, requests, fetch, t.lineitem.schema, "l_orderkey")


@query
def read_planned_ranges(t: Tables) -> DataFrame:
    return _dates_as_text(_read_planned(t, extract.BY_IDS))


@query
def read_planned_pages(t: Tables) -> DataFrame:
    return _dates_as_text(_read_planned(t, extract.BY_PAGES))


def _orders_drift(t: Tables) -> tuple[DataFrame, DataFrame]:
    """New orders that lost one column and hold another as text."""
    new = t.derive(fx.NEW_ORDERS).drop("o_totalprice").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return new, t.orders


@query
def diff_versions_drift(t: Tables) -> DataFrame:
    new, old = _orders_drift(t)
    record = changes.diff_versions(new, old, KEY, show_edits=False)
    return _show_record(record)


@query
def diff_versions(t: Tables) -> DataFrame:
    return _show_record(changes.diff_versions(t.derive(fx.NEW_ORDERS), t.orders, KEY))


def _show_record(record: changes.ChangeRecord) -> DataFrame:
    def rows(df: DataFrame, element: str, item: str, detail: str) -> DataFrame:
        return df.select(F.lit(element).alias("element"), F.expr(item).alias("item"), F.expr(detail).alias("detail"))

    counts = shape.to_long(record.counts, [])
    return shape.union_by_name(
        rows(counts, "counts", "name", "value"),
        rows(record.added, "added", "CAST(o_orderkey AS string)", "o_clerk"),
        rows(record.deleted, "deleted", "CAST(o_orderkey AS string)", "o_orderstatus"),
        rows(record.edited, "edited", "concat(o_orderkey, ' ', name)", "concat(coalesce(old, 'NA'), ' to ', coalesce(new, 'NA'))"),
        rows(record.new_columns, "new_columns", "var_name", "CAST(NULL AS string)"),
        rows(record.lost_columns, "lost_columns", "var_name", "CAST(NULL AS string)"),
        rows(record.class_changes, "class_changes", "var_name", "new_var_class"),
        rows(record.new_categories, "new_categories", "var_name", "in_new_not_old"),
    )


@query
def revert(t: Tables) -> DataFrame:
    store = _new_store(t, "store")
    store.write_version(t.orders, "orders", datetime(2002, 1, 1, 23, 59, 59))
    store.write_version(t.derive(fx.NEW_ORDERS), "orders", datetime(2002, 1, 2))
    store.write_version(t.supplier, "supplier", datetime(2002, 2, 2))
    kept = store.revert("2002-01-01")
    left_out = kept.select(F.col("table_name").alias("left_out"))
    return shape.cast_all_to_string(shape.union_by_name(store.read_version("orders"), left_out))


@query
def revert_by_log(t: Tables) -> DataFrame:
    """Orders as they were two runs ago, though that version is gone: a reload and a refresh with deletes are taken back."""
    store, cfg = _new_store(t, "store"), config("orders", KEY, "o_orderdate", keep_versions=0)
    refresh.refresh_table(store, refresh.FrameSource(t.orders), cfg)
    changed = refresh.FrameSource(t.derive(fx.NEW_ORDERS).drop("o_clerk"))
    refresh.refresh_table(store, changed, cfg, check_deletes=True)
    then = store.head("orders")[0].version_ts
    refresh.refresh_table(store, refresh.FrameSource(t.derive(fx.SAME_ORDERS)), cfg, replace=True)
    refresh.refresh_table(store, changed, cfg, check_deletes=True)
    replay.revert_by_log(store, cfg, then)
    return store.read_version("orders")
