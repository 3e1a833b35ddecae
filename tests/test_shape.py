import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.names import normalize_names
from tidemark.operators import shape


def test_incremental_filter_is_inclusive_and_keeps_nulls(spark, rows):
    df = spark.createDataFrame([(1, "2020-01-01"), (2, "2019-12-31"), (3, None)], "id int, d string")
    assert [r[0] for r in rows(shape.incremental_filter(df, "d", "2020-01-01"))] == [1, 3]
    assert shape.incremental_filter(df, "None", "2020-01-01").count() == 3
    assert shape.incremental_filter(df, None, "2020-01-01").count() == 3


def test_select_fields(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert shape.select_fields(df).columns == ["a", "b", "c"]
    assert shape.select_fields(df, "a", "c").columns == ["a", "c"]
    assert shape.select_fields(df, ["a", "b"], "None").columns == ["a", "b"]
    assert shape.select_fields(df, "a", "a", ["c"]).columns == ["a", "c"]


def test_cast_all_to_string_renders_nested_values_as_json(spark, rows):
    df = spark.sql("SELECT 1 AS a, array(1, 2) AS b, named_struct('x', 'y') AS c, CAST(NULL AS int) AS d")
    assert rows(shape.cast_all_to_string(df)) == [("1", "[1,2]", '{"x":"y"}', None)]


def test_names():
    given = ["LastUpdateDate", "WHORegion", "Admin0Id", " % Balance", "# Nation", "Name", "name ", "1st", "Straße", "", "a'b"]
    expected = [
        "last_update_date", "who_region", "admin0_id", "percent_balance", "number_nation", "name", "name_2", "x1st",
        "strasse", "x", "ab",
    ]
    assert normalize_names(given) == expected
    assert normalize_names(["a", "a", "a_2", "a"]) == ["a", "a_2", "a_2_2", "a_3"]
    assert normalize_names(["big table"], "upper_camel") == ["BigTable"]
    with pytest.raises(ValueError):
        normalize_names(["a"], "odd")


def test_rename_by_synonyms(spark):
    words = spark.createDataFrame(
        [("t", "a", "first"), ("t", "z", "last"), ("other", "b", "second"), ("t", "b", None)],
        "table_name string, original_var_name string, long string",
    )
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert shape.rename_by_synonyms(df, words, "t", "long").columns == ["first", "b"]
    unclear = words.union(spark.createDataFrame([("t", "a", "one")], words.schema))
    with pytest.raises(ValueError, match="several names"):
        shape.rename_by_synonyms(df, unclear, "t", "long")


def test_empty_rows_and_columns(spark, rows):
    df = spark.createDataFrame([(1, None, None), (None, None, None), (None, "x", None)], "a int, b string, c string")
    assert shape.drop_empty_rows(df).count() == 2
    assert shape.drop_empty_columns(df).columns == ["a", "b"]


def test_long_and_wide_are_inverse(spark, rows):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "id int, s string, v double")
    long = shape.to_long(df, "id")
    assert rows(long) == [(1, "s", "a"), (1, "v", "2.5"), (2, "s", None), (2, "v", None)]
    assert rows(shape.to_wide(long, "id", "name", "value", ["s", "v"])) == [(1, "a", "2.5"), (2, None, None)]


def test_wide_with_several_values(spark, rows):
    df = spark.createDataFrame([(1, "x", 2), (1, "x", 1), (1, "y", 5), (2, "z", 1)], "id int, n string, v int")
    with pytest.raises(Exception, match="several values in one cell"):
        shape.to_wide(df, "id", "n", "v", ["x", "y"]).collect()
    wide = shape.to_wide(df, "id", "n", "v", ["x", "y"], multi=True)
    assert rows(wide) == [(1, [1, 2], [5]), (2, [], [])]
    assert rows(shape.to_cells(df, "id", "n", "v", ["x", "y"])) == [(1, "x", 1), (1, "x", 2), (1, "y", 5)]


def test_union_by_name_fills_and_aligns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("2", 3)], "id string, n int")
    united = shape.union_by_name(a, b)
    assert united.columns == ["id", "s", "n"]
    assert rows(united) == [("1", "x", None), ("2", None, 3)]


def test_rows_except_is_distinct_and_null_safe(spark, rows):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (None, None)], "k int, s string")
    b = spark.createDataFrame([(1, None)], "k int, s string")
    assert rows(shape.rows_except(a, b)) == [(2, "x"), (None, None)]
    assert rows(shape.rows_except(a, b)) == rows(a.subtract(b))


def test_samples(spark):
    df = spark.range(0, 5000, 1, 20).withColumn("v", F.col("id") * 2)
    assert [r.id for r in shape.sample_rows(df, 3, "first", "id").collect()] == [0, 1, 2]
    assert [r.id for r in shape.sample_rows(df, 3, "last", "id").collect()] == [4999, 4998, 4997]
    one = {r.id for r in shape.sample_rows(df, 100, "random", "id", seed=1).collect()}
    again = {r.id for r in shape.sample_rows(df.repartition(3), 100, "random", "id", seed=1).collect()}
    other = {r.id for r in shape.sample_rows(df, 100, "random", "id", seed=2).collect()}
    assert len(one) == 100 and one == again and one != other
    assert shape.sample_rows(df, 9999, "first", "id").count() == 5000


def test_first_by_against_brute_force(spark):
    values = [(random.Random(i).randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(values, "a int, b int").repartition(7)
    got = [tuple(r) for r in shape.first_by(df, F.col("a").desc(), F.col("b"), n=17).collect()]
    assert got == sorted(values, key=lambda v: (-v[0], v[1]))[:17]
