"""Cleaning of raw text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.functions import text
from tidemark.functions.columns import as_text, col
from tidemark.functions.ladder import present_texts
from tidemark.operators.merge import dedup_all
from tidemark.operators.shape import drop_empty_rows, normalize_column_names
from tidemark.operators.typing import apply_types, inferred_classes


def trim_all(df: DataFrame) -> DataFrame:
    """Every column as text without leading and trailing white space."""
    return df.select(*[text.trim_text(as_text(f.name, f.dataType)).alias(f.name) for f in df.schema.fields])


def blank_to_null(df: DataFrame) -> DataFrame:
    """Every column as trimmed text, null where nothing is left."""
    return df.select(
        *[text.blank_to_null(text.trim_text(as_text(f.name, f.dataType))).alias(f.name) for f in df.schema.fields]
    )


def latin_ascii(df: DataFrame) -> DataFrame:
    """Text columns in ASCII as far as they hold Latin letters."""
    return df.select(
        *[
            text.latin_ascii(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)
            for f in df.schema.fields
        ]
    )


def clean_text(df: DataFrame) -> DataFrame:
    """Standard names, trimmed ASCII text, missing values as null, no empty rows."""
    named = normalize_column_names(df)
    return latin_ascii(drop_empty_rows(present_texts(named, named.columns)))


def clean_table(df: DataFrame, integers: bool = True) -> DataFrame:
    """A table with standard names, ASCII text, proper types and no duplicates.

    Types are inferred once, over the cleaned text, in a single aggregate that
    also finds time stamps without a time of day; a second inference after the
    duplicates are gone would see the same set of values.
    """
    shown = clean_text(df)
    classes = inferred_classes(shown, integers, demote=True)
    return dedup_all(apply_types(shown, classes))
