import random

import pytest
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.operators import diff
from tidemark.operators.merge import keep_known
from tidemark.operators.replay import RUN, undo_changes
from tidemark.operators.shape import union_by_name
from tidemark.plans import refresh, replay
from tidemark.session import new_folder
from tidemark.sources.store import VersionStore

SCHEMA = "Id string, n int, v string"


def records(new, old, place):
    """The row records of one run, as the change log has them."""
    changed = diff.changed_keys(new, old, "Id")
    parts = (
        keep_known(new, changed.filter("status = 'added'"), "Id"),
        keep_known(old, changed.filter("status = 'deleted'"), "Id"),
        diff.cells_edited(new, old, "Id", changed),
    )
    return [p.withColumn(RUN, F.lit(place)) for p in parts]


def undone(versions):
    """The first of some versions, from the last one and the records between."""
    runs = [records(new, old, i) for i, (old, new) in enumerate(zip(versions, versions[1:], strict=False))]
    added, deleted, edited = (union_by_name(*parts) for parts in zip(*runs, strict=True))
    return undo_changes(versions[-1], added, deleted, edited, "Id", versions[0].schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_runs_are_undone_together(spark):
    rng = random.Random(7)
    names = [None, *"abcdefghijkl"]

    def version():
        held = rng.sample(names, rng.randint(3, len(names)))
        return spark.createDataFrame([(k, rng.choice([None, 1, 2]), rng.choice([None, "", "x"])) for k in held], SCHEMA).coalesce(1)

    versions = [version() for _ in range(5)]
    assert rows(undone(versions)) == rows(versions[0])


def test_empty_versions_and_nested_values(spark):
    nested = "Id string, n array<int>, v struct<a:string,b:int>"
    some = spark.createDataFrame([("a", [1, None], ("x", None)), ("b", None, None)], nested)
    other = spark.createDataFrame([("a", [], None), ("c", [3], ("", 1))], nested)
    assert rows(undone([some, other])) == rows(some)
    assert rows(undone([some.limit(0), some])) == []
    assert rows(undone([some, some.limit(0)])) == rows(some)


@pytest.fixture
def store(spark):
    return VersionStore(spark, new_folder(spark, "store"))


def test_revert_beyond_kept_versions(spark, store):
    cfg = catalog.config("t", "Id", "d", keep_versions=0)

    def load(*data):
        source = refresh.FrameSource(spark.createDataFrame(data, "Id string, d string, v string"))
        refresh.refresh_table(store, source, cfg, check_deletes=True)
        return store.head("t")[0].version_ts

    load(("1", "2020-01-01", "a"), ("2", "2020-01-02", "b"), (None, "2020-01-02", "c"))
    held = rows(store.read_version("t"))
    then = store.head("t")[0].version_ts
    load(("1", "2020-01-03", None), ("3", "2020-01-03", "x"))
    last = load(("1", "2020-01-04", "z"), ("2", "2020-01-04", "new"))
    assert store.versions().count() == 1
    later = rows(store.read_version("t"))
    replay.revert_by_log(store, cfg, then)
    assert rows(store.read_version("t")) == held
    assert str(store.state().first().latest_date) == "2020-01-02"
    # The revert is a run, so it can be taken back as well.
    replay.revert_by_log(store, cfg, last)
    assert rows(store.read_version("t")) == later
    with pytest.raises(replay.NotRestorable, match="ends at"):
        replay.rows_as_of(store, cfg, then.replace(year=2000))


def test_what_the_log_cannot_give_back_is_refused(spark, store):
    cfg = catalog.config("t", "Id", keep_versions=0)

    def load(data, show_edits=True):
        source = refresh.FrameSource(spark.createDataFrame(data, "Id string, v string"))
        refresh.refresh_table(store, source, cfg, replace=True, show_edits=show_edits)
        return store.head("t")[0].version_ts

    first = load([("1", "a"), ("2", "b")])
    second = load([("1", "c"), ("2", "b")], show_edits=False)
    with pytest.raises(replay.NotRestorable, match="exactly"):
        replay.rows_as_of(store, cfg, first)
    load([("1", "c"), ("1", "d")])
    with pytest.raises(replay.NotRestorable, match="twice"):
        replay.rows_as_of(store, cfg, second)
