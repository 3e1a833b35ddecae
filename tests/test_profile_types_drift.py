import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import drift, profile, typing


def test_profile_counts_values_and_nulls(spark, rows):
    df = spark.createDataFrame([(1, "x" * 100), (1, "x" * 99 + "y"), (2, None)], "a int, b string")
    assert rows(profile.profile_columns(df)) == [("a", "int", 2, False), ("b", "string", 2, True)]
    inferred = profile.profile_columns(df, {"a": "integer", "b": "character"})
    assert {r.var_name: r.var_class for r in inferred.collect()} == {"a": "integer", "b": "character"}


def test_category_sets_keep_the_limit_exactly(spark):
    df = spark.range(1000).select(
        (F.col("id") % 30).alias("thirty"),
        (F.col("id") % 31).alias("more"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("with_null"),
        F.col("id").alias("unique"),
        F.lit(None).cast("string").alias("nothing"),
    )
    found = {r.var_name: r for r in profile.category_sets(df).collect()}
    assert sorted(found) == ["nothing", "thirty", "with_null"]
    assert found["thirty"].n_unique == 30 and len(found["thirty"]["values"]) == 30
    assert found["with_null"]["values"] == ["1", "2"] and found["with_null"].has_null
    assert found["nothing"]["values"] == [] and found["nothing"].n_unique == 0


@pytest.mark.parametrize("limit", [1, 5, 100, 700])
def test_no_small_column_is_missed(spark, limit):
    df = spark.range(limit * 3).select(*[(F.hash("id", F.lit(i)) * 0 + F.col("id") % limit + i * 7919).alias(f"c{i}") for i in range(6)])
    assert {r.n_unique for r in profile.category_sets(df, limit).collect()} == {limit}
    assert profile.category_sets(df, limit).count() == 6


def test_category_sets_of_no_candidates(spark):
    assert profile.category_sets(spark.range(1000)).count() == 0


def test_watermark(spark):
    df = spark.createDataFrame([("2020-05-01T10:00:00",), (None,), ("2021-02-30",), ("text",)], "d string")
    assert profile.max_date_watermark(df, "d").first()[0] == dt.date(2020, 5, 1)
    assert profile.max_date_watermark(df, "missing").first()[0] is None


LADDER = {
    "logical": ["T", "F", "TRUE", "false", "NA", None],
    "integer": ["1", "-20", "0", " 7 "],
    "double": ["1", "2.5", "-1e-5", ".5"],
    "number": ["1,234.5", "12", "3.5"],
    "time": ["12:30", "1:05:59"],
    "date": ["2020-02-29", "1999-12-31"],
    "datetime": ["2020-02-29", "2020-01-01T10:00:00Z"],
    "character": ["2021-02-30", "007"],
}


@pytest.mark.parametrize("label", LADDER)
def test_ladder(spark, label):
    df = spark.createDataFrame([(v,) for v in LADDER[label]], "c string")
    assert typing.inferred_classes(df) == {"c": label}


@pytest.mark.parametrize(
    "values, label",
    [
        ([None, "", " ", "NA"], "logical"),
        (["007", "1"], "character"),
        (["9223372036854775808"], "double"),
        (["1d", "2"], "character"),
        (["NaN"], "character"),
        (["2020"], "integer"),
        (["yes"], "character"),
        (["25:00"], "character"),
        (["1,23"], "character"),
        (["2020-01-01", "12:30"], "character"),
        (["T", "1"], "character"),
    ],
)
def test_ladder_traps(spark, values, label):
    assert typing.inferred_classes(spark.createDataFrame([(v,) for v in values], "c string")) == {"c": label}


def test_without_integers(spark):
    df = spark.createDataFrame([("1",)], "c string")
    assert typing.inferred_classes(df, integers=False) == {"c": "double"}


def test_apply_types(spark):
    df = spark.createDataFrame(
        [("T", "1", "1,234.5", "2020-01-01T23:00:00-02:00", " x ", "2020-01-05"), ("NA", "zz", "2", "2020-01-02 03:04:05", "NA", "x")],
        "l string, i string, n string, m string, s string, d string",
    )
    typed = typing.apply_types(df, {"l": "logical", "i": "integer", "n": "number", "m": "datetime", "s": "character", "d": "date"})
    assert [t for _, t in typed.dtypes] == ["boolean", "bigint", "double", "timestamp_ntz", "string", "date"]
    first, second = typed.collect()
    assert tuple(first) == (True, 1, 1234.5, dt.datetime(2020, 1, 2, 1), "x", dt.date(2020, 1, 5))
    assert tuple(second) == (None, None, 2.0, dt.datetime(2020, 1, 2, 3, 4, 5), None, None)


def test_midnight_only_becomes_date(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '2020-01-01' AS a, TIMESTAMP_NTZ '2020-01-01 00:00:01' AS b, CAST(NULL AS timestamp_ntz) AS c, 1 AS d"
    )
    assert [t for _, t in typing.demote_midnight_timestamps(df).dtypes] == ["date", "timestamp_ntz", "timestamp_ntz", "int"]
    raw = spark.createDataFrame([("2020-01-01T00:00:00Z", "2020-01-01T00:00:00"), ("2020-01-02", "2020-01-01 00:01")], "a string, b string")
    assert typing.inferred_classes(raw, demote=True) == {"a": "date", "b": "datetime"}


def test_sampled_inference_disagrees(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") < 1500, F.col("id").cast("string")).otherwise("1.5").alias("mixed"), F.lit("2").alias("same")
    )
    found = {r["column"]: r["class"] for r in typing.infer_types_sampled(df, "id", n=1000).collect()}
    assert found == {"id": "integer", "mixed": "character", "same": "integer"}
    few = {r["column"]: r["class"] for r in typing.infer_types_sampled(df, "id", n=5000).collect()}
    assert few["mixed"] == "double"


PROFILE = "var_name string, var_class string, values array<string>, has_null boolean"


def profiles(spark):
    old = [("kept", "string", ["a", "b"], False), ("lost", "string", None, False), ("typed", "string", ["1"], False), ("nulls", "string", ["a"], False)]
    new = [("kept", "string", ["b", "c"], True), ("fresh", "int", None, False), ("typed", "int", ["2"], False), ("nulls", "string", ["a"], True)]
    return spark.createDataFrame(old, PROFILE), spark.createDataFrame(new, PROFILE)


def test_drift(spark, rows):
    diff = drift.schema_diff(*profiles(spark))
    assert rows(drift.new_columns(diff)) == [("fresh",)]
    assert rows(drift.lost_columns(diff)) == [("lost",)]
    assert rows(drift.class_changes(diff)) == [("typed", "string", "int")]
    assert rows(drift.new_categories(diff)) == [
        ("kept", "a, b", "b, c, NA", "b", "a", "c, NA"),
        ("nulls", "a", "a, NA", "a", "", "NA"),
    ]


def test_reload_decision(spark):
    old, new = profiles(spark)

    def decide(a, b):
        return drift.needs_full_reload(a, b).first()[0]

    assert decide(old, new) is True
    assert decide(old, old) is False
    assert decide(old, old.filter("var_name <> 'lost'")) is False
    assert decide(old.filter("var_name <> 'lost'"), old) is True
    assert decide(None, new) is False and decide(old, None) is False
    assert decide(old.limit(0), new) is False


def test_render_set(spark):
    df = spark.sql("SELECT array('a', NULL, 'b') AS x, CAST(array() AS array<string>) AS y")
    shown = df.select(text.render_set(F.col("x")), text.render_set(F.col("y")), text.render_set(F.col("y"), F.lit(True)))
    assert tuple(shown.first()) == ("a, NA, b", "", "NA")
