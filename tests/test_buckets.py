import datetime as dt
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.operators.profile import describe_table
from tidemark.operators.typing import inferred_classes
from tidemark.plans import changes, refresh
from tidemark.session import folder_exists, folder_names, new_folder
from tidemark.sources import buckets, planned
from tidemark.sources.store import Conflict, VersionStore

SCHEMA = "Id string, d string, v string"


@pytest.fixture
def store(spark):
    return VersionStore(spark, new_folder(spark, "store"))


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def merge(store, cfg, delta, live=None):
    base, number = store.head(cfg.table_name)
    made = buckets.merge_buckets(store, cfg, base, delta, live)
    return made, buckets.publish_merged(store, cfg, made, number)


def places(store, row):
    return {(r.bucket, r.folder) for r in store.bucket_list(row).collect()}


@pytest.mark.parametrize(("layout", "most"), [("hash:50", 10), ("range:100", 1)])
def test_a_small_delta_rewrites_few_buckets(spark, store, layout, most):
    cfg = catalog.config("t", "Id", "d", layout=layout)
    rows = [(str(i), f"2020-01-{1 + i % 28:02d}", "a") for i in range(1000)]
    _, first = merge(store, cfg, frame(spark, rows))
    delta = [(str(i), "2020-02-01", "b") for i in range(400, 410)]
    made, second = merge(store, cfg, frame(spark, delta))
    before, after = places(store, first), places(store, second)
    # One folder a touched bucket is new; all others are those of the version before.
    assert 1 <= len(after - before) == len(made.touched) <= most and len(after & before) == len(before) - len(made.touched)
    held = {r.Id: r.v for r in store.read_version("t").collect()}
    assert len(held) == 1000 and {k for k, v in held.items() if v == "b"} == {str(i) for i in range(400, 410)}
    assert str(made.latest) == "2020-02-01"


def test_a_diff_reads_unlike_buckets_only(spark, store):
    cfg = catalog.config("t", "Id", "d", layout="range:100")
    rows = [(str(i), "2020-01-01", "a") for i in range(1000)]
    _, first = merge(store, cfg, frame(spark, rows))
    # Rows of one bucket change; those of another are written again as they are.
    _, second = merge(store, cfg, frame(spark, [("250", "2020-01-01", "b"), ("777", "2020-01-01", "a")]))
    assert buckets.unequal_buckets(store, second, first) == {2}
    record = changes.diff_stored(store, second, first, "Id")
    assert [tuple(r) for r in record.edited.collect()] == [("250", "v", "b", "a")]
    assert tuple(record.counts.first()) == (0, 1, 0)
    files = store.open(second, {2}).inputFiles()
    assert files and all(f"{buckets.BUCKET}=2/" in f for f in files)


def test_deletes_read_the_buckets_they_are_in(spark, store):
    cfg = catalog.config("t", "Id", layout="range:100")
    rows = [(str(i), None, "a") for i in range(500)]
    merge(store, cfg, frame(spark, rows))
    live = frame(spark, [(str(i), None, None) for i in range(500) if i not in (120, 121)]).select("Id")
    made, _ = merge(store, cfg, frame(spark, [], SCHEMA), live)
    assert made.touched == {1} and store.read_version("t").count() == 498
    # A bucket whose rows are all gone is in no list.
    made, last = merge(store, cfg, frame(spark, [], SCHEMA), live.filter("Id >= 200 OR length(Id) < 3"))
    assert made.touched == {1} and 1 not in {b for b, _ in places(store, last)} and store.read_version("t").count() == 400


def test_the_date_follows_the_rows(spark, store):
    cfg = catalog.config("t", "Id", "d")
    source = [("1", "2020-01-09", "a"), ("2", "2020-01-05", "b")]
    refresh.refresh_table(store, refresh.FrameSource(frame(spark, source)), cfg)
    # The row that had the latest date comes again without one.
    done = refresh.refresh_table(store, refresh.FrameSource(frame(spark, [("1", None, "A"), source[1]])), cfg)
    assert str(done.latest_date) == "2020-01-05" == str(store.state().first().latest_date)


@pytest.mark.parametrize("infer", [False, True])
def test_the_kept_profile_is_that_of_the_rows(spark, store, infer):
    cfg = catalog.config("t", "Id", infer_classes=infer, category_limit=3, layout="hash:4")
    schema = "Id string, few string, many string, nothing string, kind string"
    rows = [(str(i), "abc"[i % 3], str(i), None, "7" if i else "x") for i in range(40)]

    def check():
        held, table = store.current("t"), store.read_version("t")
        classes = inferred_classes(table) if infer else None
        want = describe_table(table, classes, 3).collect()
        got = buckets.profile_of(store.bucket_list(held), buckets.schema_of(held), infer, 3).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
        return {r.var_name: r for r in got}

    merge(store, cfg, frame(spark, rows, schema))
    first = check()
    assert first["few"]["values"] == ["a", "b", "c"] and first["many"]["values"] is None
    # Without the one text the column is of whole numbers, and one value of the set goes with its rows.
    merge(store, cfg, frame(spark, [("0", "a", None, None, "8")], schema))
    live = [(r[0], None, None, None, None) for r in rows if r[1] != "c"]
    merge(store, cfg, frame(spark, [], schema), frame(spark, live, schema).select("Id"))
    last = check()
    assert last["few"]["values"] == ["a", "b"] and last["kind"]["values"] == ["7", "8"]
    assert last["kind"].var_class == ("integer" if infer else "string")
    merge(store, cfg, frame(spark, [], schema), frame(spark, live[:2], schema).select("Id"))
    assert check()["many"]["values"] is not None


def test_repeated_rows_of_a_first_load_go_with_the_next_merge(spark, store):
    cfg = catalog.config("t", "Id", layout="hash:8")
    merge(store, cfg, frame(spark, [("1", "d", "a"), ("1", "d", "a"), ("2", "d", "b"), ("3", "d", "x"), ("3", "d", "y")]))
    assert store.read_version("t").count() == 5 and not store.current("t").rows_distinct
    merge(store, cfg, frame(spark, [("9", "d", "z")]))
    assert sorted(r.v for r in store.read_version("t").collect()) == ["a", "b", "x", "y", "z"]
    assert store.current("t").rows_distinct


def test_null_and_odd_keys_have_a_bucket(spark, store):
    cfg = catalog.config("t", "Id", layout="range:10")
    merge(store, cfg, frame(spark, [(None, "d", "a"), ("x", "d", "b"), ("-5", "d", "c"), ("99999999999999999999", "d", "e"), ("7", "d", "f")]))
    merge(store, cfg, frame(spark, [(None, "d", "A"), ("-5", "d", "C")]))
    assert sorted((r.Id or "", r.v) for r in store.read_version("t").collect()) == [("", "A"), ("-5", "C"), ("7", "f"), ("99999999999999999999", "e"), ("x", "b")]
    pair = catalog.config("p", ["Id", "d"], layout="hash:4")
    merge(store, pair, frame(spark, [("a", None, "1"), (None, "a", "2")]))
    merge(store, pair, frame(spark, [(None, "a", "3")]))
    assert sorted(r.v for r in store.read_version("p").collect()) == ["1", "3"]
    with pytest.raises(ValueError, match="one key"):
        merge(store, catalog.config("q", ["Id", "d"], layout="range:4"), frame(spark, [("a", "b", "c")]))


def test_the_second_of_two_writers_merges_again(spark, store):
    cfg = catalog.config("t", "Id", "d")
    merge(store, cfg, frame(spark, [("1", "2020-01-01", "a")]))
    other = VersionStore(spark, store.root)
    base, number = store.head("t")
    late = buckets.merge_buckets(store, cfg, base, frame(spark, [("2", "2020-01-02", "b")]))
    merge(other, cfg, frame(spark, [("3", "2020-01-03", "c")]))
    with pytest.raises(Conflict):
        buckets.publish_merged(store, cfg, late, number)
    assert sorted(r.Id for r in store.read_version("t").collect()) == ["1", "3"]

    class Slow(refresh.FrameSource):
        def pull(self, cfg, min_date, folder):
            if not self.passed:
                self.passed = True
                refresh.refresh_table(other, refresh.FrameSource(frame(spark, [("5", "2020-01-05", "e")])), cfg)
            return super().pull(cfg, min_date, folder)

    source = Slow(frame(spark, [("4", "2020-01-04", "d")]))
    source.passed = False
    refresh.refresh_table(store, source, cfg)
    # No delta is lost, whoever came first.
    assert sorted(r.Id for r in store.read_version("t").collect()) == ["1", "3", "4", "5"]


def test_an_entry_without_content_takes_its_number_only(spark, store):
    cfg = catalog.config("t", "Id")
    merge(store, cfg, frame(spark, [("1", "d", "a")]))
    from tidemark.session import create_file

    assert create_file(spark, f"{store.root}/manifest/entry-t.{2:012d}.json", "")
    assert store.head("t")[1] == 3
    merge(store, cfg, frame(spark, [("2", "d", "b")]))
    assert store.read_version("t").count() == 2


def test_shared_buckets_outlive_expired_versions(spark, store):
    cfg = catalog.config("t", "Id", layout="range:10")
    merge(store, cfg, frame(spark, [(str(i), "d", "a") for i in range(30)]))
    label = store.snapshot_all()
    for k in range(3):
        merge(store, cfg, frame(spark, [("5", "d", str(k))]))
        store.expire(0)
    assert store.read_version("t").count() == 30
    assert {r.v for r in store.read_snapshot(label, "t").collect()} == {"a"}
    # What is left: the first write, which both hold, and the last one.
    assert len([n for n in folder_names(spark, store.table_folder("t")) if n.startswith(buckets.WRITE)]) == 2


def test_readers_of_a_rewritten_log_can_go_on(spark, store):
    for k in range(5):
        store.write_version(spark.range(k + 1), "t", dt.datetime(2020, 1, k + 1))
    log = store.manifest()
    listed = log.inputFiles()
    held = log.count()
    store.tidy(after=3)
    assert log.count() == held and store.versions().count() == 5
    for k in range(5):
        store.write_version(spark.range(k + 1), "t", dt.datetime(2020, 2, k + 1))
    store.tidy(after=3)
    assert store.versions().count() == 10 and not folder_exists(spark, listed[0])


def body(*records, count):
    return json.dumps({"odata.count": str(count), "value": list(records)})


def test_failed_pages_are_asked_for_again(spark, store):
    cfg = catalog.config("t", "Id", "d")
    schema = "table_name string, skip bigint, body string"
    good = {0: body({"Id": 1, "d": "2020-01-01"}, count=4), 1: body({"Id": 2, "d": "2020-01-09"}, count=4), 2: body({"Id": 3, "d": "2020-01-05"}, {"Id": 4}, count=4)}
    landed = spark.createDataFrame([("t", 0, good[0]), ("t", 1, "<html>")], schema)
    expected = spark.createDataFrame([("t", k) for k in good], "table_name string, skip bigint")
    asked = []

    def land(*skips):
        def again(failed):
            asked.append(sorted((r.skip, r.reason) for r in failed.collect()))
            return spark.createDataFrame([("t", k, good[k] if k in skips else "<html>") for k in asked[-1] and [s for s, _ in asked[-1]]], schema)

        return again

    assert refresh.retry_failed(store, refresh.PageSource(landed), cfg) is None
    # One page comes with the retry inside the pull, the other one later.
    source = refresh.PageSource(landed, expected=expected, retry=land(1))
    done = refresh.refresh_table(store, source, cfg)
    assert not done.complete and done.latest_date is None and store.read_version("t").count() == 2
    assert asked == [[(1, "unreadable"), (2, "absent")]]
    source.retry = land()
    done = refresh.retry_failed(store, source, cfg)
    assert not done.complete and [r.skip for r in store.failed_pages("t").collect()] == [2]
    source.retry = land(2)
    done = refresh.retry_failed(store, source, cfg)
    assert done.complete and str(done.latest_date) == "2020-01-09" == str(store.state().first().latest_date)
    assert store.read_version("t").count() == 4 and store.failed_pages("t").count() == 0
    assert refresh.retry_failed(store, source, cfg) is None


def test_a_pull_that_was_not_merged_is_not_mended(spark, store):
    cfg = catalog.config("t", "Id", "d")
    schema = "table_name string, skip bigint, body string"
    whole = spark.createDataFrame([("t", 0, body({"Id": 1, "d": "2020-01-01"}, count=1))], schema)
    refresh.refresh_table(store, refresh.PageSource(whole), cfg)
    broken = spark.createDataFrame([("t", 0, "<html>"), ("t", 1, body({"Id": 2, "d": "2020-01-02"}, count=2))], schema)
    refresh.refresh_table(store, refresh.PageSource(broken), cfg, replace=True)
    with pytest.raises(ValueError, match="not merged"):
        refresh.retry_failed(store, refresh.PageSource(broken, retry=lambda failed: whole), cfg)


def test_one_table_of_a_catalog_may_fail(spark, store):
    tables = [catalog.config(n, "Id", "d") for n in ("a", "b", "c")]

    def source(cfg):
        if cfg.table_name == "b":
            raise OSError("no answer")
        return refresh.FrameSource(frame(spark, [("1", "2020-01-01", cfg.table_name)]))

    done = refresh.refresh_all(store, tables, source, width=3)
    assert [(r.table_name, r.error) for r in done] == [("a", None), ("b", "OSError: no answer"), ("c", None)]
    assert [store.read_version(n).first().v for n in "ac"] == ["a", "c"] and store.read_version("b") is None
    assert {r.table_name for r in store.state().collect()} == {"a", "c"}


def test_a_plan_is_read_by_one_task_a_request(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v")).filter("id < 300 OR id >= 500")
    path = str(tmp_path / "rows")
    rows.repartition(3).write.parquet(path)
    cfg = catalog.config("t", "id", page_size=300)
    requests = planned.plan_requests(cfg, rows.select("id"), "id_filter", width=100)
    assert [(r.start, r.end) for r in requests] == [(0, 99), (100, 199), (200, 299), (500, 599), (600, 699), (700, 799), (800, 899), (900, 999)]
    read = planned.read_planned(spark, requests, planned.ranges_of_parquet(path, "id"), rows.schema, "id")
    assert read.rdd.getNumPartitions() == 8 and sorted(read.collect()) == sorted(rows.collect())
    some = read.filter("id >= 550 AND id < 700")
    assert some.rdd.getNumPartitions() == 2 and some.count() == 150
    assert read.filter("id = 400").count() == 0 and read.filter("id > 998").collect()[0].id == 999
    pages = planned.plan_requests(cfg, rows.select("id"), "skip_top")
    assert [(r.skip, r.top) for r in pages] == [(0, 300), (300, 300), (600, 300)]
    read = planned.read_planned(spark, pages, planned.pages_of_parquet(path), rows.schema)
    assert read.rdd.getNumPartitions() == 3 and sorted(read.collect()) == sorted(rows.collect())


def task_of(name):
    return F.udf(lambda _: str(TaskContext.get().taskAttemptId()), "string")(name)


def test_the_list_of_buckets_is_worked_out_by_many_tasks(spark, store, monkeypatch):
    measure = buckets._measure

    def spread(*given):
        return measure(*given).repartition(4).withColumn("folder", task_of("bucket"))

    monkeypatch.setattr(buckets, "_measure", spread)
    cfg = catalog.config("t", "Id", "d", layout="hash:16")
    made = buckets.merge_buckets(store, cfg, None, frame(spark, [(str(i), "2020-01-01", "a") for i in range(200)]))
    # One task that wrote the list would also have measured every bucket.
    assert made.listing.select("folder").distinct().count() == 4 and made.listing.count() == 16
    store.clear_scratch()


def test_fingerprints_of_a_bucket_meet_by_key(spark, store):
    cfg = catalog.config("t", "Id", "d", layout="hash:1")
    rows = [(str(i), "2020-01-01", "a") for i in range(100)]
    for more, marks in (([], (True, True)), ([("7", "2020-01-01", "b")], (True, False)), ([("7", "2020-01-01", "a")], (False, False)), ([(None, None, None)] * 2, (False, False))):
        delta = frame(spark, rows + more)
        folder = buckets._write_part(store, delta, "t", cfg.keys, buckets.Layout.parse(cfg.layout))
        found = buckets._measure(store, delta.schema, cfg, folder, False)
        shuffles = re.findall(r"RepartitionByExpression \[([^\]]*)\]", found._jdf.queryExecution().optimizedPlan().toString())
        assert shuffles and all("__id1" in s for s in shuffles)
        assert [(r.n_rows, r.rows_distinct, r.keys_distinct) for r in found.collect()] == [(100 + len(more), *marks)]
    store.clear_scratch()


def test_failed_pages_are_looked_for_by_many_tasks(spark, store):
    failed = spark.range(40).repartition(4).select(F.col("id").alias("skip"), task_of("id").alias("reason"))
    store.save_failed(failed, "t", dt.datetime(2020, 1, 1), reported=9)
    kept = store.failed_list("t")
    assert kept.select("reason").distinct().count() == 4 and {(r.merged, r.reported, r.landed) for r in kept.collect()} == {(False, 9, None)}
    assert sorted(r.skip for r in kept.collect()) == list(range(40))
    store.save_failed(failed.filter("skip < 0"), "t", dt.datetime(2020, 1, 2))
    assert store.failed_pages("t").isEmpty()


def test_neighbours_of_a_long_plan_share_tasks_and_scans(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id"), (F.col("id") % 7).alias("v")).filter("id % 4 <> 1")
    path = str(tmp_path / "rows")
    rows.repartition(3).write.parquet(path)
    cfg = catalog.config("t", "id", page_size=7)
    most = max(planned.LEAST_TASKS, planned.TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    wanted = rows.filter("id % 4 <> 3 AND id <> 2002")
    requests = planned.plan_requests(cfg, wanted.select("id"), "id_filter", width=100)
    assert len(requests) == 1999
    read = planned.read_planned(spark, requests, planned.ranges_of_parquet(path, "id"), rows.schema, "id")
    assert read.rdd.getNumPartitions() == most and sorted(read.collect()) == sorted(wanted.collect())
    # Rows that no range holds stay out, whatever is filtered, and ranges that no id of the filter lies in are not asked for.
    assert sorted(read.filter("id >= 2000 AND id < 2012").collect()) == sorted(wanted.filter("id >= 2000 AND id < 2012").collect())
    assert read.filter("id = 2000").rdd.getNumPartitions() == 1
    pages = planned.plan_requests(cfg, rows.select("id"), "skip_top")
    read = planned.read_planned(spark, pages, planned.pages_of_parquet(path), rows.schema)
    assert len(pages) == 429 and read.rdd.getNumPartitions() == most and sorted(read.collect()) == sorted(rows.collect())
    # Overlapping ranges and pages give their rows each, and a function of one request is asked for one after another.
    several = [planned.Request(start=0, end=50), planned.Request(start=10, end=20), planned.Request(start=60, end=60)] * 9
    ask = planned.ranges_of_parquet(path, "id")
    alone = [one for r in several for batch in ask(r) for one in batch.to_pylist()]
    by_id = [one for batch in ask.together(several) for one in batch.to_pylist()]
    assert sorted(map(str, alone)) == sorted(map(str, by_id))
    some = planned.read_planned(spark, several, lambda r: ask(r), rows.schema, "id")
    assert some.count() == len(alone) and some.rdd.getNumPartitions() <= most
    paged = [planned.Request(skip=5, top=2990), planned.Request(skip=0, top=10), planned.Request(skip=2999, top=7), planned.Request(skip=3, top=0)]
    ask = planned.pages_of_parquet(path)
    alone = [one for r in paged for batch in ask(r) for one in batch.to_pylist()]
    assert sorted(map(str, alone)) == sorted(map(str, [one for batch in ask.together(paged) for one in batch.to_pylist()])) and len(alone) == 3001


def test_ranges_are_read_a_few_rows_at_a_time(spark, tmp_path):
    ids = np.random.default_rng(1).permutation(1_500_000)
    table = pa.table({"id": ids} | {f"v{k}": ids * 3 + k for k in range(5)})
    path = str(tmp_path / "rows.parquet")
    pq.write_table(table, path, row_group_size=1_000_000)
    size = table.nbytes
    del table
    asked = [planned.Request(start=low, end=low + 4) for low in range(0, 1_500_000, 10)]
    before, most, found = pa.total_allocated_bytes(), 0, 0
    for batch in planned.ranges_of_parquet(path, "id").together(asked):
        most = max(most, pa.total_allocated_bytes() - before)
        found += batch.num_rows
    assert found == 750_000 and most < size / 2
    # Files that lack a column, or have it in another type, are read as the first one is.
    folder = tmp_path / "files"
    folder.mkdir()
    pq.write_table(pa.table({"id": [1, None, 3], "v": [1, 2, 3]}), folder / "a.parquet")
    pq.write_table(pa.table({"id": pa.array([2, 9], pa.int32())}), folder / "b.parquet")
    got = [one for batch in planned.ranges_of_parquet(str(folder), "id")(planned.Request(start=1, end=3)) for one in batch.to_pylist()]
    assert got == [{"id": 1, "v": 1}, {"id": 3, "v": 3}, {"id": 2, "v": None}]
