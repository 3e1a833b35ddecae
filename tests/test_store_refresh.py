import datetime as dt
import json

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.operators import versions
from tidemark.plans import changes, refresh
from tidemark.session import folder_names, new_folder, shared_dir
from tidemark.sources.store import VersionStore, folder_name


@pytest.fixture
def store(spark):
    return VersionStore(spark, new_folder(spark, "store"))


def at(day, hour=12):
    return dt.datetime(2020, 1, day, hour)


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_version_choice(spark, rows):
    log = spark.createDataFrame(
        [("a", at(1), 1), ("a", at(3), 2), ("a", at(3), 3), ("a", at(2, 23), 4), ("b", at(5), 5)],
        "table_name string, version_ts timestamp_ntz, v int",
    )
    assert [(r.table_name, r.v) for r in versions.latest_version(log, tie="v").orderBy("table_name").collect()] == [("a", 3), ("b", 5)]
    assert [(r.table_name, r.v) for r in versions.version_as_of(log, "2020-01-02").collect()] == [("a", 4)]
    assert [r.table_name for r in versions.tables_without_version(log, "2020-01-02").collect()] == ["b"]
    assert sorted(r.v for r in versions.retain_latest_n(log, 2, tie="v").collect()) == [2, 3, 5]
    assert versions.day_before(dt.date(2020, 3, 1)) == "2020-02-29"


def test_versions_are_read_back(spark, store):
    assert store.read_version("t") is None
    store.write_version(spark.range(3), "t", at(1))
    store.write_version(spark.range(5), "t", at(2))
    store.write_version(spark.range(1), "odd ('x')", at(2))
    assert store.read_version("t").count() == 5
    assert store.read_version("t", at(1)).count() == 3
    assert store.read_version("odd ('x')").count() == 1
    assert folder_name("a/b'c") == "a_2f_b_27_c"


def test_unpublished_rows_are_not_seen(spark, store):
    store.write_version(spark.range(3), "t", at(1))
    store.save_data(spark.range(9), "t")
    assert store.read_version("t").count() == 3


def test_retention_keeps_current_and_newest(spark, store):
    for day in range(1, 7):
        store.write_version(spark.range(day), "t", at(day))
    left = store.expire(3)
    assert sorted(r.version_ts.day for r in left.collect()) == [3, 4, 5, 6]
    assert store.read_version("t", at(4)).count() == 4 and store.read_version("t", at(2)) is None
    assert store.expire(3).count() == 4


def test_snapshot(spark, store):
    store.write_version(spark.range(3), "t", at(1))
    label = store.snapshot_all(at(2))
    store.write_version(spark.range(5), "t", at(3))
    assert label == "20200102_120000"
    assert store.read_snapshot(label, "t").count() == 3 and store.read_snapshot(label, "u") is None


def test_revert_leaves_out_tables_that_are_younger(spark, store):
    source = spark.createDataFrame([(1, "2020-01-01")], "Id int, d string")
    cfg = catalog.config("t", "Id", "d")
    refresh.refresh_table(store, refresh.FrameSource(source), cfg)
    more = source.union(spark.createDataFrame([(2, "2020-02-01")], source.schema))
    refresh.refresh_table(store, refresh.FrameSource(more), cfg)
    assert store.state().first().latest_date == dt.date(2020, 2, 1)
    store.write_version(spark.range(1), "young", dt.datetime(2999, 1, 1), {"updated": dt.datetime(2999, 1, 1)})
    day_after = dt.datetime.now().date() + dt.timedelta(days=1)
    left_out = store.revert(str(day_after))
    assert ids(left_out) == ["young"]
    assert store.read_version("t").count() == 2 and store.read_version("young").count() == 1


def test_revert_to_an_earlier_day(spark, store):
    for day in (1, 2, 3):
        store.write_version(spark.range(day), "t", at(day), {"latest_date": dt.date(2019, 1, day), "date_field": "d"})
    cfg_state = "table_name string, latest_date date, updated timestamp_ntz, date_field string"
    from tidemark.operators import state

    entry = spark.createDataFrame([("t", dt.date(2019, 1, 3), at(3), "d")], cfg_state)
    store.log_state(state.advance_state(store.state_log(), entry))
    assert store.revert("2020-01-02").count() == 0
    assert store.read_version("t").count() == 2
    assert store.state().first().latest_date == dt.date(2019, 1, 2)
    assert store.versions().count() == 3


SCHEMA = "Id string, d string, v string"


def frame(spark, data, schema=SCHEMA):
    return refresh.FrameSource(spark.createDataFrame(data, schema))


CFG = catalog.config("t", "Id", "d")


def test_incremental_cycle(spark, store, rows):
    first = refresh.refresh_table(store, frame(spark, [("1", "2020-01-01", "a"), ("2", "2020-01-05", "b"), ("3", None, "c")]), CFG)
    assert first.latest_date == dt.date(2020, 1, 5) and not first.reloaded
    # Row 1 changed before the last date and is not seen; 2 (same day), 3 (no date) and 4 are.
    later = [("1", "2020-01-02", "A"), ("2", "2020-01-05", "B"), ("3", None, "C"), ("4", "2020-01-09", "d")]
    second = refresh.refresh_table(store, frame(spark, later), CFG)
    assert second.latest_date == dt.date(2020, 1, 9)
    assert [(r.Id, r.v) for r in store.read_version("t").orderBy("Id").collect()] == [("1", "a"), ("2", "B"), ("3", "C"), ("4", "d")]
    counts = store.records("counts").first()
    assert (counts.n_added, counts.n_edited, counts.n_deleted) == (1, 2, 0)
    edited = store.read_rows("edited", "t", counts.run_ts)
    assert rows(edited) == [("2", "v", "B", "b"), ("3", "v", "C", "c")]
    gained = {r.var_name: r.in_new_not_old for r in store.records("new_categories").collect()}
    assert gained == {"Id": "4", "d": "2020-01-09", "v": "B, C, d"}
    summary = changes.latest_change_summary(store)
    assert rows(summary["counts"]) == [("t", 1, 2, 0)]
    assert store.current("t").rows_distinct


def test_nothing_new(spark, store, rows):
    refresh.refresh_table(store, frame(spark, [("1", "2020-01-01", "a")]), CFG)
    before = store.current("t").version_id
    again = refresh.refresh_table(store, frame(spark, [("1", "2019-01-01", "a")]), CFG)
    assert again.version_id is None and again.latest_date == dt.date(2020, 1, 1)
    assert store.current("t").version_id == before


def test_deletes_apply_without_new_rows(spark, store):
    refresh.refresh_table(store, frame(spark, [("1", "2020-01-01", "a"), ("2", "2020-01-05", "b")]), CFG)
    done = refresh.refresh_table(store, frame(spark, [("1", "2020-01-01", "a")]), CFG, check_deletes=True)
    assert done.version_id and ids(store.read_version("t")) == ["1"]
    assert ids(store.read_rows("deleted", "t", store.records("counts").first().run_ts)) == ["2"]


def test_new_column_reloads_everything(spark, store):
    refresh.refresh_table(store, frame(spark, [("1", "2020-01-01", "a"), ("2", "2020-01-05", "b")]), CFG)
    wider = frame(spark, [("1", "2020-01-01", "A", "n"), ("2", "2020-01-06", "b", "n")], SCHEMA + ", fresh string")
    done = refresh.refresh_table(store, wider, CFG)
    assert done.reloaded
    assert [r.v for r in store.read_version("t").orderBy("Id").collect()] == ["A", "b"]
    assert ids(store.records("new_columns").select("var_name")) == ["fresh"]
    assert ids(changes.latest_change_summary(store)["new_columns"].select("var_name")) == ["fresh"]


def test_lost_column_does_not_reload(spark, store):
    refresh.refresh_table(store, frame(spark, [("1", "2020-01-01", "a")]), CFG)
    done = refresh.refresh_table(store, frame(spark, [("2", "2020-01-06")], "Id string, d string"), CFG)
    assert not done.reloaded and store.read_version("t").count() == 2


def test_changed_date_field_and_replace_reload(spark, store):
    rows = [("1", "2020-01-01", "2020-03-01"), ("2", "2020-01-05", "2020-02-01")]
    refresh.refresh_table(store, frame(spark, rows), CFG)
    moved = refresh.refresh_table(store, frame(spark, rows), catalog.config("t", "Id", "v"))
    assert moved.reloaded and moved.latest_date == dt.date(2020, 3, 1)
    forced = refresh.refresh_table(store, frame(spark, rows[:1]), catalog.config("t", "Id", "v"), replace=True)
    assert forced.reloaded and store.read_version("t").count() == 1


def test_mock_drift(spark, store, small):
    """A stored copy with a lost column, a misspelled name and a missing row heals itself."""
    customer = spark.read.parquet(f"{small}/customer.parquet")
    cfg = catalog.config("customer", "c_custkey")
    damaged = customer.drop("c_acctbal").filter("c_custkey <> 7")
    damaged = damaged.withColumn("c_name", F.when(F.col("c_custkey") == 9, "Mispelled").otherwise(F.col("c_name")))
    refresh.refresh_table(store, refresh.FrameSource(damaged), cfg)
    done = refresh.refresh_table(store, refresh.FrameSource(customer), cfg)
    assert done.reloaded
    counts = store.records("counts").first()
    assert (counts.n_added, counts.n_edited, counts.n_deleted) == (1, 1, 0)
    assert ids(store.records("new_columns").select("var_name")) == ["c_acctbal"]
    assert store.read_version("customer").count() == customer.count()


def body(*records, count):
    return json.dumps({"odata.count": str(count), "value": list(records)})


def test_failed_pages_hold_the_watermark_back(spark, store):
    schema = "table_name string, skip bigint, body string"
    good = ("t", 0, body({"Id": 1, "d": "2020-01-01"}, {"Id": 2, "d": "2020-01-09"}, count=3))
    broken = spark.createDataFrame([good, ("t", 2, "<html>")], schema)
    done = refresh.refresh_table(store, refresh.PageSource(broken), CFG)
    assert not done.complete and done.latest_date is None
    assert store.read_version("t").count() == 2
    assert store.state().first().latest_date == dt.date(1900, 1, 1)
    whole = spark.createDataFrame([good, ("t", 2, body({"Id": 3, "d": "2020-01-04"}, count=3))], schema)
    done = refresh.refresh_table(store, refresh.PageSource(whole), CFG)
    assert done.complete and done.latest_date == dt.date(2020, 1, 9)
    assert ids(store.read_version("t")) == ["1", "2", "3"]


def test_refresh_all_and_catalog(spark, store):
    known = catalog.configs(catalog.default_catalog(spark))
    assert len(known) == 10 and known[0].keys == ["Id"] and known[0].page_size == 1000
    assert catalog.tables_matching(catalog.default_catalog(spark), "^L").count() == 2
    tables = [catalog.config("a", "Id", "d"), catalog.config("b", "Id")]
    done = refresh.refresh_all(store, tables, lambda cfg: frame(spark, [("1", "2020-01-01", cfg.table_name)]))
    assert [r.table_name for r in done] == ["a", "b"]
    assert store.read_version("b").first().v == "b"


def test_change_log_keeps_the_newest_runs(spark, store):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    for day in range(1, 6):
        new = spark.createDataFrame([(1, f"v{day}")], "id int, v string")
        changes.append_change_log(store, changes.diff_versions(new, old, "id"), "t", at(day))
    assert sorted(r.run_ts.day for r in store.records("counts", 3).collect()) == [3, 4, 5]
    store.purge_changes(3)
    assert store.read_rows("edited", "t", at(1)) is None
    assert store.read_rows("edited", "t", at(5)).first().new == "v5"
    assert changes.diff_versions(old, None, "id") is None


def pages(spark, *bodies, table="t"):
    return spark.createDataFrame([(table, 10 * k, b) for k, b in enumerate(bodies)], "table_name string, skip bigint, body string")


def three_rows(spark, store):
    whole = pages(spark, body(*[{"Id": k, "d": f"2020-01-0{k}"} for k in (1, 2, 3)], count=3))
    refresh.refresh_table(store, refresh.PageSource(whole), CFG)


def test_new_column_in_pages_that_cannot_be_asked_for_again(spark, store):
    three_rows(spark, store)
    wider = pages(spark, body({"Id": 4, "d": "2020-01-09", "fresh": "x"}, count=1))
    done = refresh.refresh_table(store, refresh.PageSource(wider), CFG)
    assert done.reload_wanted and done.version_id is None and ids(store.read_version("t")) == ["1", "2", "3"]
    assert str(store.state().first().latest_date) == "2020-01-03"
    asked = []
    full = pages(spark, body(*[{"Id": k, "d": f"2020-01-0{k}", "fresh": "x"} for k in (1, 2, 3, 4)], count=4))
    source = refresh.PageSource(lambda min_date: asked.append(min_date) or (full if min_date < "2000" else wider))
    done = refresh.refresh_table(store, source, CFG)
    assert done.reloaded and asked == ["2020-01-03", "1900-01-01"] and ids(store.read_version("t")) == ["1", "2", "3", "4"]


def test_deletes_need_all_keys(spark, store):
    three_rows(spark, store)
    delta = pages(spark, body({"Id": 3, "d": "2020-01-04"}, count=1))
    with pytest.raises(ValueError, match="key_pages"):
        refresh.refresh_table(store, refresh.PageSource(delta), CFG, check_deletes=True)
    short = pages(spark, body({"Id": 1}, count=2))
    refresh.refresh_table(store, refresh.PageSource(delta, key_pages=short), CFG, check_deletes=True)
    assert ids(store.read_version("t")) == ["1", "2", "3"]
    keys = pages(spark, body({"Id": 1}, {"Id": 3}, count=2))
    refresh.refresh_table(store, refresh.PageSource(delta, key_pages=keys), CFG, check_deletes=True)
    assert ids(store.read_version("t")) == ["1", "3"]


def test_part_of_a_table_replaces_nothing(spark, store):
    three_rows(spark, store)
    broken = pages(spark, body({"Id": 9, "d": "2020-01-09"}, count=2), "<html>")
    done = refresh.refresh_table(store, refresh.PageSource(broken), CFG, replace=True)
    assert not done.complete and ids(store.read_version("t")) == ["1", "2", "3"]
    assert [(r.skip, r.reason) for r in store.failed_pages("t").collect()] == [(10, "unreadable")]


def test_other_tables_and_empty_pulls(spark, store):
    three_rows(spark, store)
    mixed = pages(spark, body({"Id": 7, "d": "2020-01-07"}, count=1), table="u").unionByName(pages(spark, body(count=0)))
    done = refresh.refresh_table(store, refresh.PageSource(mixed), CFG)
    assert done.complete and done.version_id is None and ids(store.read_version("t")) == ["1", "2", "3"]


def test_repeated_keys_do_not_stop_a_table(spark, store):
    rows = [("1", "2020-01-01", "a"), ("1", "2020-01-01", "b"), ("2", "2020-01-05", "c")]
    refresh.refresh_table(store, frame(spark, rows), CFG)
    for value in ("d", "e"):
        done = refresh.refresh_table(store, frame(spark, [*rows[:2], ("2", "2020-01-06", value)]), CFG, replace=True)
        assert done.version_id
        run = max(r.run_ts for r in store.records("counts").collect())
        assert [r.Id for r in store.read_rows("repeated", "t", run).collect()] == ["1"]
        assert [r.new for r in store.read_rows("edited", "t", run).collect()].count(value) == 1


def test_stricter_values_do_not_reload(spark, store):
    cfg = catalog.config("t", "Id", "d", infer_classes=True)
    refresh.refresh_table(store, frame(spark, [("1", "2020-01-01", "a"), ("2", "2020-01-05", "b")]), cfg)
    assert not refresh.refresh_table(store, frame(spark, [("3", "2020-01-06", "7")]), cfg).reloaded
    assert refresh.refresh_table(store, frame(spark, [("x", "2020-01-06", "7")]), cfg).reloaded


def test_logs_are_compacted(spark, store):
    from tidemark.operators import state
    from tidemark.session import folder_names

    df = spark.createDataFrame([("1",)], "Id string")
    for k in range(5):
        store.write_version(df, "t", at(k + 1))
        store.log_state(state.initial_entry(spark, "t", "d", at(k + 1)))
        store.expire(1, table="t")
    held = sorted(r.version_id for r in store.versions().collect())
    store.tidy(after=3)
    for folder in ("manifest", "state"):
        assert len([n for n in folder_names(spark, f"{store.root}/{folder}") if n.startswith("part-")]) == 1
    assert sorted(r.version_id for r in store.versions().collect()) == held and len(held) == 2
    assert store.read_version("t").count() == 1 and store.state().count() == 1


def test_snapshots_are_not_expired(spark, store):
    store.write_version(spark.createDataFrame([("1",)], "Id string"), "t", at(1))
    label = store.snapshot_all(at(2))
    for k in range(3, 6):
        store.write_version(spark.createDataFrame([(str(k),)], "Id string"), "t", at(k))
    store.expire(0)
    assert ids(store.read_snapshot(label, "t")) == ["1"] and store.versions().count() == 2


def test_the_parts_of_a_change_record_are_worked_out_by_many_tasks(spark, store):
    task = F.udf(lambda _: str(TaskContext.get().taskAttemptId()), "string")
    parts = {
        "counts": spark.createDataFrame([(1, 2, 3)], "n_added bigint, n_edited bigint, n_deleted bigint"),
        "new_columns": spark.range(40).repartition(4).select(task("id").alias("var_name")),
    }
    store.append_records(parts, "t", at(1))
    # One task that wrote the log would also have worked out all rows of it.
    assert store.records("new_columns").select("var_name").distinct().count() == 4
    assert [tuple(r) for r in store.records("counts").collect()] == [("t", at(1), 1, 2, 3)]
    assert len(folder_names(spark, f"{store.root}/changes/records")) == 1
    assert not [n for n in folder_names(spark, shared_dir(spark)) if n.startswith("records-")]
