"""Which pages or ranges of ids a table is read by."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import TableConfig
from tidemark.operators.ranges import id_islands, id_range_chunks
from tidemark.operators.shape import NO_FIELD
from tidemark.sources.pages import expected_pages

# How a table is read, the tables always read by pages, and ids per range.
BY_PAGES, BY_IDS = "skip_top", "id_filter"
PAGED_TABLES = "IndicatorValue"
IDS_PER_RANGE = 1000


def extraction_method(cfg: TableConfig) -> str:
    """Tables without a date field are read page by page, others by ranges of the ids that changed."""
    return BY_PAGES if cfg.field == NO_FIELD or re.search(PAGED_TABLES, cfg.table_name) else BY_IDS


def plan_extraction(cfg: TableConfig, ids: DataFrame, method: str | None = None, width: int = IDS_PER_RANGE) -> DataFrame:
    """``table_name, method, skip, top, predicate``: a row per read.

    ``ids`` holds the key of every row to be read. Pages need only their number; ranges cover its runs of
    consecutive ids, so no read asks for ids that are not there. The predicates can be handed to a partitioned read.
    """
    method = method or extraction_method(cfg)
    name, text, number = F.lit(cfg.table_name).alias("table_name"), F.lit(None).cast("string"), F.lit(None).cast("bigint")
    if method == BY_PAGES:
        counts = ids.agg(F.count("*").alias("total")).select(name, "total")
        pages = expected_pages(counts, cfg.page_size)
        return pages.select("table_name", F.lit(method).alias("method"), "skip", "top", text.alias("predicate"))
    if len(cfg.keys) != 1:
        raise ValueError("ranges of ids need a table with one key")
    chunks = id_range_chunks(id_islands(ids, cfg.keys[0]), width, cfg.keys[0])
    return chunks.select(name, F.lit(method).alias("method"), number.alias("skip"), number.alias("top"), "predicate")
