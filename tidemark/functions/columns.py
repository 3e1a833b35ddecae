"""Small helpers for naming and rendering columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
KEEP_NULLS = {"ignoreNullFields": "false"}


def col(name: str) -> Column:
    """Column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: list[str]) -> list[Column]:
    return [col(n) for n in names]


def as_list(names: str | list[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def as_text(name: str, data_type: T.DataType) -> Column:
    """Text form of a column: nested values become JSON with their nulls, the rest a plain cast."""
    c = col(name)
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, NESTED):
        return F.to_json(c, KEEP_NULLS)
    return c.cast("string")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def same_key(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality over a composite key (a null key equals a null key)."""
    return all_of([a.eqNullSafe(b) for a, b in zip(left, right, strict=True)])


def row_digest(df: DataFrame, names: list[str]) -> Column:
    """128-bit fingerprint of a row over ``names``; nulls count by position."""
    parts: list[Column] = []
    for name in names:
        c = col(name)
        if isinstance(df.schema[name].dataType, NESTED):
            # Spark's hash skips nulls inside nested values; their text does not.
            c = F.to_json(c, KEEP_NULLS)
        parts += [c, c.isNull()]
    return F.struct(
        F.xxhash64(F.lit(1), *parts).alias("h1"),
        F.xxhash64(F.lit(2), *parts).alias("h2"),
    )
