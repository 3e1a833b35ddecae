"""Column profiles, value sets and the date watermark."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_text, col
from tidemark.functions.text import date_prefix

# Fixed value: columns with more distinct values than this are not categorical.
CATEGORY_LIMIT = 30

# Values longer than this are counted by their SHA-256, which is shorter; a mark keeps both kinds apart.
LONG_VALUE = 64


def max_date_watermark(df: DataFrame, field: str) -> DataFrame:
    """Latest day in ``field``, nulls ignored; null when there is no such column."""
    day = date_prefix(col(field)) if field in df.columns else F.lit(None).cast("date")
    return df.agg(F.max(day).alias("latest_date"))


def _long_values(df: DataFrame, names: list[str], shorten: bool) -> DataFrame:
    texts = []
    for name in names:
        text = as_text(name, df.schema[name].dataType)
        if shorten:
            text = F.when(F.length(text) > LONG_VALUE, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(F.concat(F.lit("="), text))
        texts.append(text.alias(name))
    return df.select(*texts).unpivot([], [col(n) for n in names], "var_name", "value")


def _class_of(var_name: Column, classes: dict[str, str]) -> Column:
    pairs = [F.lit(x) for item in classes.items() for x in item]
    return F.element_at(F.create_map(*pairs), var_name)


def spark_classes(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def profile_columns(df: DataFrame, classes: dict[str, str] | None = None) -> DataFrame:
    """Class, exact distinct count and presence of nulls, per column.

    ``classes`` replaces the stored types, for instance with inferred ones. One
    scan feeds all columns, and equal values meet before the shuffle.
    """
    classes = classes or spark_classes(df)
    values = _long_values(df, df.columns, shorten=True).groupBy("var_name", "value").agg(F.lit(1).alias("one"))
    counted = values.groupBy("var_name").agg(
        F.count("value").alias("n_unique"),
        F.max(F.col("value").isNull()).alias("has_null"),
    )
    return counted.select("var_name", _class_of(F.col("var_name"), classes).alias("var_class"), "n_unique", "has_null")


def sketch_bound(limit: int) -> tuple[float, int]:
    """Accuracy of a sketch, and the highest estimate it gives for ``limit`` distinct values or fewer.

    A HyperLogLog sketch of few values counts its non-empty registers, of which
    there are never more than values: with ``m`` registers its estimate is at
    most ``m * ln(m / (m - limit))``, so no such column is missed.
    """
    bits = max(7, math.ceil(math.log2(4 * limit)))
    registers = 1 << bits
    return 1.106 / 2 ** (bits / 2), math.ceil(registers * math.log(registers / (registers - limit))) + 1


def _few_valued(df: DataFrame, limit: int) -> list[str]:
    """Columns that may have at most ``limit`` distinct values.

    One that only looks small is dropped by the exact count that follows.
    """
    accuracy, highest = sketch_bound(limit)
    sketches = [F.approx_count_distinct(as_text(f.name, f.dataType), accuracy).alias(str(i)) for i, f in enumerate(df.schema.fields)]
    row = df.agg(*sketches).first()
    return [n for i, n in enumerate(df.columns) if row[i] <= highest]


def category_sets(df: DataFrame, limit: int = CATEGORY_LIMIT) -> DataFrame:
    """Sorted value set of every column with at most ``limit`` distinct values.

    Sketches pick the candidates first, so wide and unique columns are neither
    read again nor shuffled, and only short lists are ever collected.
    """
    schema = "var_name string, n_unique bigint, values array<string>, has_null boolean"
    names = _few_valued(df, limit)
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    values = _long_values(df, names, shorten=False).groupBy("var_name", "value").agg(F.lit(1).alias("one"))
    counts = values.groupBy("var_name").agg(F.count("value").alias("n_unique"))
    small = values.join(counts.filter(F.col("n_unique") <= limit), "var_name")
    return small.groupBy("var_name").agg(
        F.max("n_unique").alias("n_unique"),
        F.array_sort(F.collect_set("value")).alias("values"),
        F.max(F.col("value").isNull()).alias("has_null"),
    )


def profile_with_sets(profile: DataFrame, sets: DataFrame) -> DataFrame:
    """Profile rows with the value set of their column, null where it has none."""
    return profile.join(sets.select("var_name", "values"), "var_name", "left")


def describe_table(
    df: DataFrame, classes: dict[str, str] | None = None, limit: int = CATEGORY_LIMIT
) -> DataFrame:
    """Class and value set of every column, as drift detection needs them.

    Unlike ``profile_columns`` this never counts the distinct values of wide
    columns, which would shuffle the whole table.
    """
    classes = classes or spark_classes(df)
    spark = df.sparkSession
    names = spark.createDataFrame(list(classes.items()), "var_name string, var_class string")
    return names.join(category_sets(df, limit), "var_name", "left").select(
        "var_name", "var_class", "n_unique", "values", "has_null"
    )
