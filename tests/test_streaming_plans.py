import json

import pytest

from checks.queries import QUERIES
from tidemark import catalog
from tidemark.operators import diff, merge, shape, typing, versions
from tidemark.plans import clean
from tidemark.session import new_folder
from tidemark.sources.store import VersionStore
from tidemark.streaming import ingest


def test_pages_are_merged_as_they_land(spark, tmp_path):
    store = VersionStore(spark, new_folder(spark, "store"))
    cfg = catalog.config("t", "Id", "d")
    folder, checkpoint = tmp_path / "pages", str(tmp_path / "checkpoint")
    folder.mkdir()

    def land(name, *records):
        (folder / name).write_text(json.dumps({"odata.count": "9", "value": list(records)}))
        pages = ingest.stream_page_files(spark, str(folder))
        ingest.refresh_stream(store, cfg, pages, ["Id", "d", "v"], checkpoint).awaitTermination(120)
        return sorted((r.Id, r.v) for r in store.read_version("t").collect())

    assert land("1.json", {"Id": 1, "d": "2020-01-01", "v": "a"}, {"Id": 2, "d": "2020-01-02", "v": "b"}) == [("1", "a"), ("2", "b")]
    assert land("2.json", {"Id": 2, "d": "2020-01-05", "v": "B"}, {"Id": 3, "v": "c"}) == [("1", "a"), ("2", "B"), ("3", "c")]
    assert str(store.state().first().latest_date) == "2020-01-05"


def test_unreadable_pages_hold_the_date_back(spark, tmp_path):
    store = VersionStore(spark, new_folder(spark, "store"))
    cfg = catalog.config("t", "Id", "d")
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "1.json").write_text(json.dumps({"odata.count": "2", "value": [{"Id": 1, "d": "2020-01-01"}]}))
    (folder / "2.json").write_text("<html>503</html>")
    pages = ingest.stream_page_files(spark, str(folder))
    ingest.refresh_stream(store, cfg, pages, ["Id", "d"], str(tmp_path / "checkpoint")).awaitTermination(120)
    assert store.read_version("t").count() == 1 and str(store.state().first().latest_date) == "1900-01-01"
    assert [r.body for r in ingest.quarantined_pages(store, cfg).collect()] == ["<html>503</html>"]
    ingest.release(store, cfg)
    (folder / "3.json").write_text(json.dumps({"odata.count": "1", "value": [{"Id": 2, "d": "2020-01-02"}]}))
    pages = ingest.stream_page_files(spark, str(folder))
    ingest.refresh_stream(store, cfg, pages, ["Id", "d"], str(tmp_path / "checkpoint")).awaitTermination(120)
    assert store.read_version("t").count() == 2 and str(store.state().first().latest_date) == "2020-01-02"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, small):
    return spark.read.parquet(f"{small}/orders.parquet")


def test_filter_and_columns_reach_the_scan(orders):
    text = plan(shape.select_fields(shape.incremental_filter(orders, "o_orderdate", "2000-01-01"), "o_orderkey", "o_orderdate"))
    assert "Or(IsNull(o_orderdate),GreaterThanOrEqual(o_orderdate" in text or "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_trusted_old_rows_are_not_deduplicated_again(orders):
    loose = plan(merge.upsert(orders, orders, "o_orderkey"))
    trusted = plan(merge.upsert(orders, orders, "o_orderkey", old_is_distinct=True))
    assert trusted.count("Exchange hashpartitioning") < loose.count("Exchange hashpartitioning")


def test_change_detection_shuffles_fingerprints_only(orders):
    text = plan(diff.changed_keys(orders, orders, "o_orderkey"))
    assert text.count("Exchange") == 1 and "Join" not in text
    exchange = text[: text.index("Exchange")]
    assert "o_totalprice" not in exchange


def test_pages_are_parsed_once(spark, orders):
    from tidemark.sources import pages

    landed = orders.selectExpr("'t' AS table_name", "o_orderkey AS skip", "o_orderstatus AS body")
    assert plan(pages.read_landed_pages(landed, ["a", "b"])).count("from_json") == 1


def test_retention_limits_before_the_shuffle(orders):
    log = orders.selectExpr("CAST(o_custkey AS string) AS table_name", "o_orderdate AS version_ts")
    assert "WindowGroupLimit" in plan(versions.retain_latest_n(log, 3)).split("Exchange")[1]


def test_samples_limit_before_the_shuffle(orders):
    for n in (10, 5000):
        text = plan(shape.sample_rows(orders, n, "last", "o_orderkey"))
        assert "TakeOrderedAndProject" in text and "Exchange" not in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("refresh", "snapshot", "revert", "version_round", "append_change", "diff_versions"))))
def test_no_python_and_no_cross_join_in_any_plan(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for word in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, name


def test_clean_and_types_stay_native(orders):
    assert "EvalPython" not in plan(clean.clean_table(orders)) + plan(typing.infer_types(orders))
