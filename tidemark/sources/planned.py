"""Planned reads as a Spark data source: input partitions that each ask for a page or range of ids of a plan, or for several in a row.

A request of a plan (``skip`` and ``top``, or the ids ``start`` to ``end``) is what a task asks a service for. How it asks is a
function of the request that gives Arrow batches; it runs in the task, so rows go from the service to executors and never through
the driver, a task that is lost asks again, and Spark decides how many run at a time. Comparisons of the id column with numbers are pushed down: ranges that
cannot hold such an id are not asked for at all.

A plan can have more requests than a cluster can usefully have tasks, a million where ids have many gaps. From ``TASKS_PER_CORE`` a core on,
neighbours share a task. A service that can answer several requests at once says how in ``together``, a method of the function.
"""

from __future__ import annotations

import pickle
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from tidemark.catalog import TableConfig
from tidemark.operators.ranges import id_islands, id_range_chunks
from tidemark.plans.extract import BY_PAGES, IDS_PER_RANGE, extraction_method
from tidemark.sources.pages import expected_pages

Fetch = Callable[["Request"], Iterable[pa.RecordBatch]]

# Plans of more requests than this a core, and than this at all, have neighbours in one task.
TASKS_PER_CORE, LEAST_TASKS = 2, 16
# Rows of a batch that a range reads, and bytes of each column that it holds in advance.
BATCH_ROWS, READ_AHEAD = 16_384, 1 << 20


@dataclass(frozen=True, slots=True)
class Request:
    """A page (``skip``, ``top``) or a range of ids (``start`` to ``end``, both included)."""

    skip: int | None = None
    top: int | None = None
    start: int | None = None
    end: int | None = None


def plan_requests(cfg: TableConfig, ids: DataFrame, method: str | None = None, width: int = IDS_PER_RANGE) -> list[Request]:
    """The requests that read a table, as many as Spark will make input partitions of; ``ids`` holds the key of every row to be read."""
    if (method or extraction_method(cfg)) == BY_PAGES:
        counts = ids.agg(F.count(F.lit(1)).alias("total")).select(F.lit(cfg.table_name).alias("table_name"), "total")
        return [Request(skip=r.skip, top=r.top) for r in expected_pages(counts, cfg.page_size).orderBy("skip").toLocalIterator()]
    if len(cfg.keys) != 1:
        raise ValueError("ranges of ids need a table with one key")
    chunks = id_range_chunks(id_islands(ids, cfg.keys[0]), width)
    return [Request(start=r.start, end=r.end) for r in chunks.orderBy("start").toLocalIterator()]


@dataclass
class _Part(InputPartition):
    requests: list[tuple]


def _size(request: Request) -> float:
    """How many rows or ids a request can give, at least one."""
    size = request.top if request.start is None else request.end - request.start + 1
    return max(1.0, float(size or 0))


class _Reader(DataSourceReader):
    """``packed`` holds the requests: it goes to every task with the reader, where nobody opens it."""

    def __init__(self, packed: bytes, fetch: Fetch, key: str | None, names: list[str], most: int):
        self.packed, self.fetch, self.key, self.names, self.most = packed, fetch, key, names, most
        self.bounds = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of the id choose ranges. Every filter is handed back: a range holds other ids as well."""
        for one in filters:
            value = getattr(one, "value", None)
            if getattr(one, "attribute", None) == (self.key,) and isinstance(value, int) and not isinstance(value, bool):
                least = {EqualTo: value, GreaterThanOrEqual: value, GreaterThan: value + 1}.get(type(one))
                most = {EqualTo: value, LessThanOrEqual: value, LessThan: value - 1}.get(type(one))
                self.bounds.append((least, most))
            yield one

    def partitions(self) -> list[InputPartition]:
        requests = [
            r for r in (Request(*fields) for fields in pickle.loads(zlib.decompress(self.packed)))
            if r.start is None or all((least is None or r.end >= least) and (most is None or r.start <= most) for least, most in self.bounds)
        ]
        if not requests:
            return [_Part([])]
        fields = [(r.skip, r.top, r.start, r.end) for r in requests]
        if len(requests) <= self.most:
            return [_Part([one]) for one in fields]
        # Neighbours go together, about as many rows or ids to each task.
        sizes = np.array([_size(r) for r in requests])
        places = np.minimum(((np.cumsum(sizes) - sizes / 2) / sizes.sum() * self.most).astype(int), self.most - 1)
        cuts = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(fields)]
        return [_Part(fields[i:j]) for i, j in zip(cuts, cuts[1:])]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        requests = [r for r in (Request(*fields) for fields in partition.requests) if r.top != 0]
        together = getattr(self.fetch, "together", None)
        if together is None or len(requests) < 2:
            answers = (batch for r in requests for batch in self.fetch(r))
        else:
            answers = together(requests)
        for batch in answers:
            yield batch.select(self.names)


def read_planned(spark: SparkSession, requests: list[Request], fetch: Fetch, schema: T.StructType, key: str | None = None) -> DataFrame:
    """The rows that ``fetch`` gives for all ``requests``; ``key`` names the id column that ranges are of."""
    name = f"planned_{uuid.uuid4().hex}"
    names = schema.names
    packed = zlib.compress(pickle.dumps([(r.skip, r.top, r.start, r.end) for r in requests]), 1)
    most = max(LEAST_TASKS, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)

    class Planned(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return schema

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return _Reader(packed, fetch, key, names, most)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Planned)
    return spark.read.format(name).load()


def _apart(requests: list[Request]) -> Iterator[list[Request]]:
    """Requests in lists of ranges that do not overlap, in the order of ids; those of a plan are one such list."""
    rest = sorted(requests, key=lambda r: r.start)
    while rest:
        taken, left = [], []
        for r in rest:
            (left if taken and r.start <= taken[-1].end else taken).append(r)
        yield taken
        rest = left


@dataclass
class _RangesOfParquet:
    path: str
    key: str

    def __call__(self, request: Request) -> Iterator[pa.RecordBatch]:
        """Batch by batch as they are asked for: a scanner would hold whole row groups, and of each file all that it has read."""
        wanted = (ds.field(self.key) >= request.start) & (ds.field(self.key) <= request.end)
        files = ds.dataset(self.path, format="parquet")
        for fragment in files.get_fragments():
            groups = [g.id for g in fragment.subset(wanted, schema=files.schema).row_groups]
            if not groups:
                continue
            if not fragment.physical_schema.equals(files.schema):  # columns that this file lacks or has in another type
                yield from fragment.scanner(schema=files.schema, filter=wanted, batch_size=BATCH_ROWS, batch_readahead=1, use_threads=False).to_batches()
                continue
            with fragment.open() as source:
                for batch in pq.ParquetFile(source, pre_buffer=False, buffer_size=READ_AHEAD).iter_batches(BATCH_ROWS, row_groups=groups, use_threads=False):
                    ids = batch.column(self.key)
                    yield batch.filter(pc.and_(pc.greater_equal(ids, request.start), pc.less_equal(ids, request.end)))

    def together(self, requests: list[Request]) -> Iterator[pa.RecordBatch]:
        """One pass over the row groups between the first id and the last answers all requests."""
        for ranges in _apart(requests):
            starts, ends = np.array([r.start for r in ranges]), np.array([r.end for r in ranges])
            for batch in self(Request(start=ranges[0].start, end=ranges[-1].end)):
                ids = batch.column(self.key).to_numpy(zero_copy_only=False)
                found = ids <= ends[np.searchsorted(starts, ids, side="right") - 1] if len(ids) else np.zeros(0, bool)
                yield batch if found.all() else batch.filter(pa.array(found))


def ranges_of_parquet(path: str, key: str) -> Fetch:
    """A stand-in for a service that is asked for ranges of ids: Parquet files that every task can open; row groups without such ids are skipped.

    Where files are not in the order of ids, every task reads them all, but only once for its requests together.
    """
    return _RangesOfParquet(path, key)


@dataclass
class _PagesOfParquet:
    path: str

    def __call__(self, request: Request) -> Iterator[pa.RecordBatch]:
        return self.together([request])

    def together(self, requests: list[Request]) -> Iterator[pa.RecordBatch]:
        """Each row group is read once for all pages that lie in it."""
        pages = sorted((r.skip, r.skip + r.top) for r in requests)
        last, first, at = max(high for _, high in pages), 0, 0
        for fragment in sorted(ds.dataset(self.path, format="parquet").get_fragments(), key=lambda f: f.path):
            if at >= last:
                return
            for group in fragment.split_by_row_group():
                rows = group.row_groups[0].num_rows
                while first < len(pages) and pages[first][1] <= at:
                    first += 1
                if first == len(pages):
                    return
                if any(low < at + rows and high > at for low, high in pages[first:]):
                    table = group.to_table()
                    for low, high in pages[first:]:
                        if low >= at + rows:
                            break
                        if high > at:
                            yield from table.slice(max(0, low - at), min(rows, high - at) - max(0, low - at)).to_batches()
                at += rows


def pages_of_parquet(path: str) -> Fetch:
    """The same for pages: rows ``skip`` to ``skip + top`` in the order of files; only row groups that hold some of them are read."""
    return _PagesOfParquet(path)
