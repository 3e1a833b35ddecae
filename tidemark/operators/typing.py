"""Type inference over text columns, and casting to the inferred types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_text, col
from tidemark.functions.ladder import (
    CLASS_BITS,
    CLASSES,
    DATETIME,
    MIDNIGHT,
    class_mask,
    class_name,
    present_texts,
    read_as,
)
from tidemark.operators.shape import sample_rows

# Fixed value: rows in each of the three samples.
SAMPLE_ROWS = 1000


def class_masks(df: DataFrame, integers: bool, *by: str) -> DataFrame:
    """The class mask all values of a column share, one row per column.

    Values are laid out one under the other, so one expression serves any number
    of columns, and they are combined before the shuffle. The row added for each
    column makes it appear even when there is no value.
    """
    names = [n for n in df.columns if n not in by]
    texts = df.select(*[col(n) for n in by], *[as_text(n, df.schema[n].dataType).alias(n) for n in names])
    values = present_texts(texts.unpivot([col(n) for n in by], [col(n) for n in names], "column", "value"), ["value"])
    masks = values.select(*by, "column", class_mask("value", integers).alias("mask"))
    if not by:
        every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("column"))
        masks = masks.unionByName(every.withColumn("mask", F.lit(None).cast("int")))
    return masks.groupBy(*by, "column").agg(F.bit_and("mask").alias("mask"))


def infer_types(df: DataFrame, integers: bool = True) -> DataFrame:
    """Strictest class that all present values of a column share."""
    return class_masks(df, integers).select("column", class_name(F.col("mask")).alias("class"))


def infer_types_sampled(
    df: DataFrame, order_by: str | list[str], n: int = SAMPLE_ROWS, seed: int = 42, integers: bool = True
) -> DataFrame:
    """Classes from a random, the first and the last ``n`` rows.

    A column on which the three disagree is left as character.
    """
    samples = None
    for how in ("random", "first", "last"):
        part = sample_rows(df, n, how, order_by, seed).withColumn("__how", F.lit(how))
        samples = part if samples is None else samples.unionByName(part)
    guesses = class_masks(samples, integers, "__how").select("column", class_name(F.col("mask")).alias("class"))
    agreed = F.when(F.min("class") == F.max("class"), F.min("class")).otherwise(F.lit("character"))
    return guesses.groupBy("column").agg(agreed.alias("class"))


def inferred_classes(df: DataFrame, integers: bool = True, demote: bool = False) -> dict[str, str]:
    """Classes as a dictionary; with ``demote`` midnight-only time stamps are dates."""
    found = class_masks(df, integers)
    label = class_name(F.col("mask"))
    if demote:
        only_midnight = F.col("mask").bitwiseAND(F.lit(MIDNIGHT)) != 0
        is_moment = (label == "datetime") & (F.col("mask").bitwiseAND(F.lit(DATETIME)) != 0)
        label = F.when(is_moment & only_midnight, F.lit("date")).otherwise(label)
    rows = found.select("column", label.alias("class")).collect()
    return {r["column"]: r["class"] for r in rows}


def unfit_columns(df: DataFrame, classes: dict[str, str], integers: bool = True) -> list[str]:
    """Columns with a value that cannot be read as their class in ``classes``; a column without values fits any."""
    names = [n for n in df.columns if n in classes and classes[n] in CLASSES and classes[n] != "character"]
    if not names:
        return []
    bits = {n: CLASS_BITS[classes[n]] for n in names}
    found = class_masks(df.select(*[col(n) for n in names]), integers).filter("mask IS NOT NULL").collect()
    return sorted(r["column"] for r in found if not r["mask"] & bits[r["column"]])


def apply_types(df: DataFrame, classes: dict[str, str]) -> DataFrame:
    """Columns read as their class; text that does not fit becomes null."""
    unknown = set(classes.values()) - set(CLASSES)
    if unknown:
        raise ValueError(f"unknown classes {sorted(unknown)}")
    texts = present_texts(df, [n for n in df.columns if n in classes])
    return texts.select(*[read_as(n, classes[n]).alias(n) if n in classes else col(n) for n in df.columns])


def demote_midnight_timestamps(df: DataFrame) -> DataFrame:
    """Time stamp columns whose every value is at midnight become dates."""
    stamps = [f.name for f in df.schema.fields if f.dataType.simpleString().startswith("timestamp")]
    if not stamps:
        return df
    checks = [F.bool_and(F.date_trunc("DAY", col(n)) == col(n)).alias(str(i)) for i, n in enumerate(stamps)]
    row = df.agg(*checks).first()
    days = {n for i, n in enumerate(stamps) if row[i]}
    return df.select(*[col(n).cast("date").alias(n) if n in days else col(n) for n in df.columns])
