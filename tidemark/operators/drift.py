"""Schema and category drift between two column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import render_set


def schema_diff(old_profile: DataFrame, new_profile: DataFrame) -> DataFrame:
    """Both profiles side by side, one row per column name."""
    def side(profile: DataFrame, prefix: str) -> DataFrame:
        picked = [F.col("var_name"), F.col("var_class").alias(f"{prefix}_var_class")]
        for name in ("values", "has_null"):
            if name in profile.columns:
                picked.append(F.col(name).alias(f"{prefix}_{name}"))
        return profile.select(*picked)

    return side(old_profile, "old").join(side(new_profile, "new"), "var_name", "full_outer")


def new_columns(diff: DataFrame) -> DataFrame:
    return diff.filter("old_var_class IS NULL").select("var_name")


def lost_columns(diff: DataFrame) -> DataFrame:
    return diff.filter("new_var_class IS NULL").select("var_name")


def class_changes(diff: DataFrame) -> DataFrame:
    return diff.filter("old_var_class <> new_var_class").select("var_name", "old_var_class", "new_var_class")


def value_set_compare(
    old: Column, new: Column, old_null: Column | None = None, new_null: Column | None = None
) -> dict[str, Column]:
    """Shared members and both differences of two value sets, as comma text."""
    old_null = F.lit(False) if old_null is None else F.coalesce(old_null, F.lit(False))
    new_null = F.lit(False) if new_null is None else F.coalesce(new_null, F.lit(False))
    return {
        "same": render_set(F.array_sort(F.array_intersect(old, new)), old_null & new_null),
        "in_old_not_new": render_set(F.array_sort(F.array_except(old, new)), old_null & ~new_null),
        "in_new_not_old": render_set(F.array_sort(F.array_except(new, old)), new_null & ~old_null),
    }


def new_categories(diff: DataFrame) -> DataFrame:
    """Columns of unchanged class whose value set gained members."""
    sets = value_set_compare(
        F.col("old_values"), F.col("new_values"), F.col("old_has_null"), F.col("new_has_null")
    )
    gained = F.size(F.array_except("new_values", "old_values")) > 0
    gained_null = F.coalesce(F.col("new_has_null") & ~F.col("old_has_null"), F.lit(False))
    return (
        diff.filter("old_var_class = new_var_class AND old_values IS NOT NULL AND new_values IS NOT NULL")
        .filter(gained | gained_null)
        .select(
            "var_name",
            render_set(F.col("old_values"), F.coalesce("old_has_null", F.lit(False))).alias("old_set"),
            render_set(F.col("new_values"), F.coalesce("new_has_null", F.lit(False))).alias("new_set"),
            *[c.alias(name) for name, c in sets.items()],
        )
    )


def lost_categories(diff: DataFrame) -> DataFrame:
    """Columns of unchanged class whose value set grew past the limit of categories, with the set they had."""
    gone = diff.filter("old_var_class = new_var_class AND old_values IS NOT NULL AND new_values IS NULL")
    return gone.select("var_name", render_set(F.col("old_values"), F.coalesce("old_has_null", F.lit(False))).alias("old_set"))


def needs_full_reload(old_profile: DataFrame | None, new_profile: DataFrame | None) -> DataFrame:
    """One row: true when a column is new or changed class.

    Lost columns and new categories do not count, and without one of the
    profiles there is nothing to compare, so the answer is false.
    """
    if old_profile is None or new_profile is None:
        spark = SparkSession.active()
        return spark.range(1).select(F.lit(False).alias("needs_full_reload"))
    diff = schema_diff(old_profile, new_profile)
    found = F.max(F.expr("old_var_class IS NULL OR old_var_class <> new_var_class"))
    both = (F.count("old_var_class") > 0) & (F.count("new_var_class") > 0)
    return diff.agg(F.coalesce(found & both, F.lit(False)).alias("needs_full_reload"))
