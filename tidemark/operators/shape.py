"""Projections, filters, reshaping, set operations and ordered samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_list, as_text, col, cols
from tidemark.functions.names import normalize_names
from tidemark.functions.text import match_pattern

# Fixed value: the text that stands for "this table has no date column".
NO_FIELD = "None"

# Blocks of this many steps are spread over tasks before they are unrolled.
STEPS_PER_BLOCK = 10_000


def incremental_filter(df: DataFrame, field: str | None, min_date: str) -> DataFrame:
    """Rows dated ``min_date`` or later, and rows without a date."""
    if field is None or field == NO_FIELD:
        return df
    c = col(field)
    return df.filter((c >= F.lit(min_date).cast(df.schema[field].dataType)) | c.isNull())


def select_fields(
    df: DataFrame,
    keys: str | list[str] | None = None,
    field: str | None = None,
    extra: list[str] | None = None,
) -> DataFrame:
    """Keys, the date column and extra columns; everything when nothing is named."""
    wanted = as_list(keys or []) + ([field] if field and field != NO_FIELD else []) + list(extra or [])
    return df.select(*cols(list(dict.fromkeys(wanted)))) if wanted else df


def common_names(new: DataFrame, old: DataFrame) -> list[str]:
    held = set(old.columns)
    return [n for n in new.columns if n in held]


def common_columns(new: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = cols(common_names(new, old))
    return new.select(*names), old.select(*names)


def cast_all_to_string(df: DataFrame) -> DataFrame:
    return df.select(*[as_text(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def normalize_column_names(df: DataFrame, case: str = "snake") -> DataFrame:
    return df.toDF(*normalize_names(df.columns, case))


def rename_by_synonyms(
    df: DataFrame, synonyms: DataFrame, table: str, convention: str
) -> DataFrame:
    """Rename columns by the synonym list of one table.

    ``synonyms`` has ``table_name``, ``original_var_name`` and one column per
    naming convention. Only entries for columns of ``df`` reach the driver.
    """
    entries = (
        synonyms.filter((F.col("table_name") == table) & F.col("original_var_name").isin(df.columns))
        .filter(col(convention).isNotNull())
        .groupBy("original_var_name")
        .agg(F.min(col(convention)).alias("lowest"), F.max(col(convention)).alias("highest"))
        .collect()
    )
    unclear = sorted(e.original_var_name for e in entries if e.lowest != e.highest)
    if unclear:
        raise ValueError(f"several names in {convention!r} for {unclear}")
    return df.withColumnsRenamed({e.original_var_name: e.lowest for e in entries})


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value, found in one pass over the table."""
    counts = df.agg(*[F.count(col(n)).alias(str(i)) for i, n in enumerate(df.columns)]).first()
    return df.select(*[col(n) for i, n in enumerate(df.columns) if counts[i] > 0])


def filter_matching(df: DataFrame, name: str, pattern: str) -> DataFrame:
    return df.filter(match_pattern(col(name), pattern))


def to_long(df: DataFrame, ids: str | list[str]) -> DataFrame:
    """One row per id and column, as text, nulls kept."""
    keys = as_list(ids)
    values = [f for f in df.schema.fields if f.name not in keys]
    texts = df.select(*cols(keys), *[as_text(f.name, f.dataType).alias(f.name) for f in values])
    return texts.unpivot(cols(keys), cols([f.name for f in values]), "name", "value")


def to_wide(
    df: DataFrame,
    ids: str | list[str],
    name: str,
    value: str,
    names: list[str],
    multi: bool = False,
) -> DataFrame:
    """One column per entry of ``names``.

    With ``multi`` the values of a cell become a sorted list; ``to_cells`` has the
    same values one to a row, for cells too large for a list. Without it a second
    value in a cell is an error.
    """
    keys = as_list(ids)
    if multi:
        cell = F.array_sort(F.collect_list(col(value)))
    else:
        lowest, highest = F.min(col(value)), F.max(col(value))
        cell = F.when(
            ~lowest.eqNullSafe(highest), F.raise_error(F.lit("several values in one cell of to_wide"))
        ).otherwise(lowest)
    return df.groupBy(*cols(keys)).pivot(name, names).agg(cell)


def to_cells(df: DataFrame, ids: str | list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """The values of ``to_wide(multi=True)`` in long form: ids, name and value, a row per value, nulls left out."""
    return df.filter(col(name).isin(names) & col(value).isNotNull()).select(*cols(as_list(ids)), col(name), col(value))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union with missing columns as null; differing types meet as text."""
    types: dict[str, set] = {}
    for frame in frames:
        for f in frame.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = {n for n, kinds in types.items() if len(kinds) > 1}
    result = None
    for frame in frames:
        if mixed:
            frame = frame.select(
                *[
                    as_text(f.name, f.dataType).alias(f.name) if f.name in mixed else col(f.name)
                    for f in frame.schema.fields
                ]
            )
        result = frame if result is None else result.unionByName(frame, allowMissingColumns=True)
    return result


def rows_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``, columns matched by name.

    One aggregation over both sides: copies collapse before the shuffle, so a
    row repeated a billion times costs no more than any other.
    """
    names = a.columns
    both = a.select(*cols(names), F.lit(0).alias("__in_b")).unionByName(
        b.select(*cols(names), F.lit(1).alias("__in_b"))
    )
    return (
        both.groupBy(*cols(names))
        .agg(F.max("__in_b").alias("__in_b"))
        .filter(F.col("__in_b") == 0)
        .select(*cols(names))
    )


def first_by(df: DataFrame, *order: Column, n: int = 1) -> DataFrame:
    """The first ``n`` rows in ``order``.

    Every task keeps its own first ``n`` in a bounded heap, and only those meet
    in the last step; the table is never sorted or shuffled, whatever ``n`` is.
    """
    return df.orderBy(*order).limit(n)


def sample_rows(
    df: DataFrame, n: int, how: str, order_by: str | list[str], seed: int = 42
) -> DataFrame:
    """``n`` rows: ``first`` or ``last`` by key, or ``random`` but repeatable."""
    keys = as_list(order_by)
    if how == "first":
        return first_by(df, *[col(k).asc() for k in keys], n=n)
    if how == "last":
        return first_by(df, *[col(k).desc() for k in keys], n=n)
    if how == "random":
        # A digest that other engines have too, so that a sample can be drawn again elsewhere.
        texts = [F.coalesce(as_text(k, df.schema[k].dataType), F.lit("NA")) for k in keys]
        return first_by(df, F.md5(F.concat_ws(":", F.lit(str(seed)), *texts)), *cols(keys), n=n)
    raise ValueError(f"how must be first, last or random, not {how!r}")


def unroll_range(df: DataFrame, start: Column, stop: Column, step: int, name: str) -> DataFrame:
    """One row per ``start, start + step, ... <= stop``.

    Long ranges are cut into blocks that are spread over tasks first, so one
    huge range neither fills an array nor keeps a single task busy.
    """
    block = step * STEPS_PER_BLOCK
    blocks = (
        df.withColumn("__stop", stop.cast("bigint"))
        .withColumn("__block", F.explode(F.sequence(start.cast("bigint"), F.col("__stop"), F.lit(block))))
    )
    blocks = blocks.repartition(F.col("__block"), *cols(df.columns))
    last = F.least(F.col("__stop"), F.try_add(F.col("__block"), F.lit(block - step)))
    return blocks.withColumn(name, F.explode(F.sequence(F.col("__block"), last, F.lit(step)))).drop(
        "__stop", "__block"
    )
