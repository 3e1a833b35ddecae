"""Upsert, delete reconcile and exact de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_list, as_text, col, cols, same_key
from tidemark.operators.shape import union_by_name


def _against_keys(df: DataFrame, other: DataFrame, keys: list[str], how: str, keys_are_distinct: bool = False) -> DataFrame:
    """Semi or anti join of ``df`` with the distinct keys of ``other``.

    The key side is reduced to one row per key before it is shuffled, unless it is said to be so already. Whether it
    is small enough to broadcast is left to its size at run time; beyond that
    the join sorts both sides and hot partitions of ``df`` are split.
    """
    mine, theirs = [], []
    for k in keys:
        a, b = df.schema[k].dataType, other.schema[k].dataType
        same = a.simpleString() == b.simpleString()
        mine.append(col(k) if same else as_text(k, a))
        theirs.append(col(k) if same else as_text(k, b))
    named = [t.alias(f"__key_{i}") for i, t in enumerate(theirs)]
    known = other.select(*named)
    known = known if keys_are_distinct else known.distinct()
    return df.join(known, same_key(mine, [F.col(f"__key_{i}") for i in range(len(keys))]), how)


def keep_known(df: DataFrame, other: DataFrame, keys: str | list[str], keys_are_distinct: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``other``."""
    return _against_keys(df, other, as_list(keys), "left_semi", keys_are_distinct)


def keep_unknown(df: DataFrame, other: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``."""
    return _against_keys(df, other, as_list(keys), "left_anti")


def dedup_all(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_keys(df: DataFrame, names: str | list[str]) -> DataFrame:
    """Distinct values of ``names``; no other column is kept."""
    return df.select(*cols(as_list(names))).distinct()


def upsert(
    old: DataFrame | None,
    delta: DataFrame,
    keys: str | list[str],
    live_keys: DataFrame | None = None,
    old_is_distinct: bool = False,
) -> DataFrame:
    """``old`` with the rows of ``delta`` put in place of those with their keys.

    The two sides share no key once replaced rows are gone, so duplicates are
    removed on each side by itself. ``old_is_distinct`` says that the stored
    rows hold none: they are then not shuffled again, and with a delta of
    broadcast size not shuffled at all.
    """
    keys = as_list(keys)
    if old is None:
        return delta if live_keys is None else reconcile_deletes(delta, live_keys, keys)
    kept = keep_unknown(old, delta, keys)
    if live_keys is not None:
        kept = reconcile_deletes(kept, live_keys, keys)
        delta = reconcile_deletes(delta, live_keys, keys)
    return union_by_name(delta.distinct(), kept if old_is_distinct else kept.distinct())


def reconcile_deletes(df: DataFrame, live_keys: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows whose key is still in the complete list of live keys."""
    return keep_known(df, live_keys, keys)


def count_deleted(df: DataFrame, live_keys: DataFrame, keys: str | list[str]) -> DataFrame:
    """How many rows ``reconcile_deletes`` removes."""
    return keep_unknown(df, live_keys, keys).agg(F.count(F.lit(1)).alias("n_deleted"))
