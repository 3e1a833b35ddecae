"""Runs of consecutive ids and fixed-width read ranges over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.operators.shape import unroll_range

# Fixed value: width of one read range.
RANGE_WIDTH = 1000

# Each level joins runs within id blocks 2**16 times as wide as the level before.
LEVEL_BITS = (16, 32, 48, 64)


def _block(c: Column, bits: int) -> Column:
    """Number of the id block of width ``2**bits`` that holds ``c``."""
    return F.shiftright(c, bits) if bits < 64 else F.lit(0).cast("bigint")


def _join_touching(runs: DataFrame) -> DataFrame:
    """Merge runs that continue each other within ``__block`` and ``__alone``."""
    in_order = Window.partitionBy("__block", "__alone").orderBy("start")
    begins = F.coalesce(F.lag("end").over(in_order) + 1 != F.col("start"), F.lit(True))
    numbered = runs.withColumn("__begins", begins.cast("int")).withColumn(
        "__run", F.sum("__begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy("__block", "__alone", "__run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("start", "end")
    )


def _is_open(bits: int) -> Column:
    """Does the run touch an edge of its block, so that it may go on outside?"""
    mask = F.lit((1 << bits) - 1)
    return (F.col("start").bitwiseAND(mask) == 0) | (F.col("end").bitwiseAND(mask) == mask)


def id_islands(df: DataFrame, id_column: str) -> DataFrame:
    """Maximal runs of consecutive ids, as ``start`` and ``end``.

    Blocks of 65,536 ids are scanned on their own. Runs at the edge of a block,
    two per block at the most, are then joined over ever wider blocks, so no
    group at any level exceeds 131,072 rows whatever the size of the table.
    """
    bits = LEVEL_BITS[0]
    ids = df.select(col(id_column).cast("bigint").alias("start")).filter("start IS NOT NULL").distinct()
    blocks = ids.withColumn("__block", _block(F.col("start"), bits))
    place = F.col("start").bitwiseAND(F.lit((1 << bits) - 1))
    rank = F.row_number().over(Window.partitionBy("__block").orderBy("start"))
    runs = (
        blocks.withColumn("__run", place - rank)
        .groupBy("__block", "__run")
        .agg(F.min("start").alias("start"), F.max("start").alias("end"))
        .select("start", "end")
    )
    closed = runs.filter(~_is_open(bits))
    edge = runs.filter(_is_open(bits))
    for lower, upper in zip(LEVEL_BITS, LEVEL_BITS[1:]):
        # A run that ended inside its block is done and stays in a group of its own.
        edge = _join_touching(
            edge.withColumn("__block", _block(F.col("start"), upper)).withColumn(
                "__alone", F.when(~_is_open(lower), F.col("start"))
            )
        )
    return closed.unionByName(edge)


def id_range_chunks(
    islands: DataFrame, width: int = RANGE_WIDTH, id_column: str | None = None
) -> DataFrame:
    """Cut runs into ranges of at most ``width`` ids.

    With ``id_column`` each range also comes as a predicate text, ready for a
    partitioned read.
    """
    cut = unroll_range(islands.select("start", "end"), F.col("start"), F.col("end"), width, "__from")
    chunks = cut.select(
        F.col("__from").alias("start"),
        F.least(F.col("end"), F.try_add(F.col("__from"), F.lit(width - 1))).alias("end"),
    )
    if id_column is None:
        return chunks
    text = F.format_string(f"{id_column} >= %d AND {id_column} <= %d", F.col("start"), F.col("end"))
    return chunks.withColumn("predicate", text)
