import random

import pytest

from tidemark.operators import diff, merge


def frame(spark, data, schema="id int, a string, b string"):
    return spark.createDataFrame(data, schema)


def test_delta_wins_and_duplicates_go(spark, rows):
    old = frame(spark, [(1, "x", "y"), (2, "x", "y"), (2, "x", "y"), (None, "n", "n")])
    delta = frame(spark, [(1, "new", None), (1, "new", None), (None, "m", "m"), (3, "z", "z")])
    expected = sorted([(1, "new", None), (2, "x", "y"), (None, "m", "m"), (3, "z", "z")], key=repr)
    assert rows(merge.upsert(old, delta, "id")) == expected


def test_repeated_delta_keys_keep_their_distinct_rows(spark, rows):
    old = frame(spark, [(1, "x", "y")])
    delta = frame(spark, [(1, "p", "p"), (1, "q", "q"), (1, "q", "q")])
    assert rows(merge.upsert(old, delta, "id")) == [(1, "p", "p"), (1, "q", "q")]


def test_columns_of_one_side_are_filled(spark, rows):
    old = frame(spark, [(1, "x"), (2, "y")], "id int, a string")
    delta = frame(spark, [(2, "extra")], "id int, c string")
    merged = merge.upsert(old, delta, "id")
    assert merged.columns == ["id", "c", "a"]
    assert rows(merged) == [(1, None, "x"), (2, "extra", None)]


def test_first_load_is_stored_as_it_is(spark):
    delta = frame(spark, [(1, "x", "y"), (1, "x", "y")])
    assert merge.upsert(None, delta, "id").count() == 2


def test_empty_delta_changes_nothing_and_upsert_is_idempotent(spark, rows):
    old = frame(spark, [(1, "x", "y"), (2, None, "y")])
    empty = frame(spark, [])
    assert rows(merge.upsert(old, empty, "id")) == rows(old)
    delta = frame(spark, [(2, "z", "z"), (4, None, None)])
    once = merge.upsert(old, delta, "id")
    assert rows(merge.upsert(once, delta, "id")) == rows(once)


def test_key_types_may_differ(spark, rows):
    old = frame(spark, [("1", "x"), ("2", "y")], "id string, a string")
    delta = frame(spark, [(2, "new")], "id int, a string")
    assert rows(merge.upsert(old, delta, "id")) == [("1", "x"), ("2", "new")]


def test_deletes(spark, rows):
    old = frame(spark, [(1, "x", "y"), (2, "x", "y"), (None, "n", "n")])
    live = spark.createDataFrame([(2,), (2,), (None,), (9,)], "id int")
    assert [r[0] for r in rows(merge.reconcile_deletes(old, live, "id"))] == [2, None]
    assert merge.count_deleted(old, live, "id").first()[0] == 1
    merged = merge.upsert(old, frame(spark, [(5, "p", "p"), (9, "q", "q")]), "id", live_keys=live, old_is_distinct=True)
    assert [r[0] for r in rows(merged)] == [2, 9, None]


def test_dedup(spark, rows):
    df = frame(spark, [(1, "x", "y"), (1, "x", "z"), (1, "x", "y")])
    assert merge.dedup_all(df).count() == 2
    assert rows(merge.dedup_keys(df, ["id", "a"])) == [(1, "x")]


KEYS = ["k1", "k2"]
SCHEMA = "k1 int, k2 string, a string, b double"


def test_cells_edited(spark, rows):
    old = frame(spark, [(1, "p", "x", 1.0), (1, "q", None, 2.0), (2, None, "z", None), (3, "gone", "a", 1.0)], SCHEMA)
    new = frame(spark, [(1, "p", "x", 1.5), (1, "q", "x", 2.0), (2, None, None, 3.0), (4, "here", "a", 1.0)], SCHEMA)
    assert rows(diff.cells_edited(new, old, KEYS)) == sorted(
        [(1, "p", "b", "1.5", "1.0"), (1, "q", "a", "x", None), (2, None, "a", None, "z"), (2, None, "b", "3.0", None)],
        key=repr,
    )
    assert rows(diff.changed_keys(new, old, KEYS)) == sorted(
        [(1, "p", "edited"), (1, "q", "edited"), (2, None, "edited"), (3, "gone", "deleted"), (4, "here", "added")],
        key=repr,
    )


def test_value_moving_between_columns_is_an_edit(spark, rows):
    old = frame(spark, [(1, "v", None)])
    new = frame(spark, [(1, None, "v")])
    assert rows(diff.cells_edited(new, old, "id")) == [(1, "a", None, "v"), (1, "b", "v", None)]


def test_text_na_differs_from_null(spark, rows):
    assert rows(diff.cells_edited(frame(spark, [(1, "NA", "y")]), frame(spark, [(1, None, "y")]), "id")) == [
        (1, "a", "NA", None)
    ]


def test_repeated_keys_are_reported(spark):
    old = frame(spark, [(1, "x", "y"), (1, "z", "y")])
    assert [tuple(r) for r in diff.changed_keys(old, old, "id").collect()] == [(1, "repeated")]
    assert diff.cells_edited(old, old, "id").isEmpty()


def test_only_keys_in_common(spark):
    old = frame(spark, [(1, "x")], "id int, a string")
    new = frame(spark, [(1, "x")], "id int, c string")
    assert diff.cells_edited(new, old, "id").count() == 0


def test_old_plus_changes_is_new(spark):
    """Random versions: applying the reported changes to old gives new."""
    random.seed(3)
    names = ["a", "b"]

    def version(ids):
        return {i: {"a": random.choice(["p", "q", None]), "b": random.choice(["r", "s", None])} for i in ids}

    old, new = version(range(0, 300)), version(range(100, 420))
    frames = [frame(spark, [(i, v["a"], v["b"]) for i, v in side.items()]) for side in (new, old)]
    state = {i: dict(v) for i, v in old.items()}
    for r in diff.rows_deleted(*frames, "id").collect():
        del state[r.id]
    for r in diff.rows_added(*frames, "id").collect():
        state[r.id] = {n: r[n] for n in names}
    for r in diff.cells_edited(*frames, "id").collect():
        assert state[r.id][r.name] == r.old
        state[r.id][r.name] = r.new
    assert state == new


def test_change_counts(spark):
    old = frame(spark, [(1, "x", "y"), (2, "x", "y"), (None, "n", "n"), (7, "x", "y")])
    new = frame(spark, [(1, "z", "z"), (2, "x", "y"), (None, "m", "n"), (8, "x", "y"), (9, "x", "y")])
    counts = diff.change_counts(
        diff.rows_added(new, old, "id"), diff.cells_edited(new, old, "id"), diff.rows_deleted(new, old, "id"), "id"
    )
    assert tuple(counts.first()) == (2, 2, 1)
    assert tuple(diff.count_changed(diff.changed_keys(new, old, "id")).first()) == (2, 2, 1)
