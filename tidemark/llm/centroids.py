"""Clustering of vectors around centroids in whole numbers, over dictionaries of distinct subvectors.

Each component x of a vector becomes floor(scale * x), a whole number, so that distances, sums and centroids are exact. The dimensions are
cut into blocks of ``width``. Vectors are dealt into chunks of ``chunk`` rows; within a chunk every block has a dictionary of its distinct subvectors, and
a vector is its codes, one a block: nothing is lost. A round computes the distance of every dictionary entry to that block of every
centroid once, and a vector's distance is the sum over its codes. Sums of a cluster come from counts of codes: entries times how
often the cluster holds them. A dictionary never has more entries than its chunk rows, whatever the data, so
memory is bounded; only centroids travel, k * dimensions numbers, and each task sends back one sum per cluster. Vectors are not shuffled.

Starting centroids are the ``k`` kept vectors with the smallest SHA-256 of ``seed:id``, in that order; ties of repeated ids go by components.
A vector belongs to the nearest centroid, the smaller number on a tie. A round replaces a centroid by the floor of its vectors' mean; empty ones stay.

Nulls and repeats: a vector that is null, has another number of components, or a null, NaN or infinite one is left out, and so is one with a component
beyond 2^27 after scaling, whose squared distance has no 64-bit integer. Rows that share an id are different vectors. A vector without an id is
assigned, but is no starting centroid. With fewer than ``k`` starts there are fewer clusters; with none the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

K, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64
# Rows of a chunk, and components of a block. Narrow blocks have few distinct subvectors.
CHUNK, WIDTH = 8192, 2
LARGEST = 1 << 27


@dataclass
class Clusters:
    """``rows``: the id, ``cluster`` and ``distance`` of every kept vector; ``centroids``: the final ones by number."""

    rows: DataFrame
    centroids: np.ndarray


def whole_numbers(values: list | pa.ListArray, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and their components as whole numbers."""
    column = values if isinstance(values, pa.Array) else pa.array(values, pa.list_(pa.float64()))
    sizes = np.diff(column.offsets.to_numpy())
    fits = (sizes == dimensions) & ~np.asarray(column.is_null())
    kept = np.flatnonzero(fits)
    # A null component reads as NaN.
    flat = column.take(pa.array(kept)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(kept), dimensions)
    with np.errstate(invalid="ignore", over="ignore"):
        numbers = np.floor(flat * scale)
    fine = (np.abs(numbers) <= LARGEST).all(axis=1)
    return kept[fine], numbers[fine].astype(np.int64)


def encode_block(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a block of components, and the code of every row."""
    low = block.min(axis=0)
    span = block.max(axis=0) - low + 1
    if float(np.prod(span.astype(float))) < 2**62:
        # One number a subvector: sorting numbers is faster than sorting rows.
        steps = np.cumprod(np.concatenate([[1], span[:0:-1]]))[::-1]
        distinct, codes = np.unique((block - low) @ steps, return_inverse=True)
        return np.stack([distinct // s % n for s, n in zip(steps, span, strict=True)], axis=1) + low, codes.ravel()
    distinct, codes = np.unique(block, axis=0, return_inverse=True)
    return distinct, codes.ravel()


def encode_chunk(numbers: np.ndarray, width: int = WIDTH) -> tuple[bytes, list[int], bytes]:
    """Codes of all rows, block after block; entries per block; and all dictionaries one after the other."""
    codes, sizes, entries = [], [], []
    for low in range(0, numbers.shape[1], width):
        distinct, own = encode_block(numbers[:, low : low + width])
        codes.append(own.astype("<u2" if CHUNK <= 1 << 16 else "<u4"))
        sizes.append(len(distinct))
        entries.append(distinct.astype("<i4").ravel())
    return np.concatenate(codes).tobytes(), sizes, np.concatenate(entries).tobytes()


class Chunk:
    """A chunk as read back: ``codes`` (blocks x rows) and a dictionary for each block."""

    def __init__(self, rows: int, codes: bytes, sizes: list[int], entries: bytes, dimensions: int, width: int):
        self.rows, self.dimensions, self.width = rows, dimensions, width
        self.codes = np.frombuffer(codes, "<u2" if CHUNK <= 1 << 16 else "<u4").reshape(-1, rows)
        flat, self.dictionaries, at = np.frombuffer(entries, "<i4").astype(np.int64), [], 0
        for block, size in enumerate(sizes):
            wide = min(width, dimensions - block * width)
            self.dictionaries.append(flat[at : at + size * wide].reshape(size, wide))
            at += size * wide

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of every row."""
        total = np.zeros((self.rows, len(centroids)), np.int64)
        for block, (codes, entries) in enumerate(zip(self.codes, self.dictionaries, strict=True)):
            own = centroids[:, block * self.width : block * self.width + entries.shape[1]]
            partial = np.square(entries[:, None, :] - own[None, :, :]).sum(axis=2)
            total += partial[codes]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(self.rows), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """The sum of every cluster's rows, from how often it holds each code."""
        parts = []
        for codes, entries in zip(self.codes, self.dictionaries, strict=True):
            held = np.bincount(cluster * len(entries) + codes, minlength=k * len(entries)).reshape(k, len(entries))
            parts.append(held @ entries)
        return np.concatenate(parts, axis=1)


def encode_vectors(vectors: DataFrame, id_name: str, vector: str, dimensions: int = DIMENSIONS, scale: int = SCALE, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """One row for each chunk: ``ids, codes, sizes, entries``."""
    kind = dict(vectors.dtypes)[id_name]
    schema = f"ids array<{kind}>, codes binary, sizes array<int>, entries binary"
    if not 0 < chunk <= CHUNK:
        raise ValueError(f"a chunk has 1 to {CHUNK} rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def packed(ids: pa.Array, numbers: np.ndarray) -> pa.RecordBatch:
            codes, sizes, entries = encode_chunk(numbers, width)
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.RecordBatch.from_arrays(
                [lists, pa.array([codes], pa.binary()), pa.array([sizes], pa.list_(pa.int32())), pa.array([entries], pa.binary())],
                ["ids", "codes", "sizes", "entries"],
            )

        def taken(size: int) -> pa.RecordBatch:
            nonlocal held, waiting
            ids = pa.concat_arrays([i for i, _ in held])
            numbers = np.concatenate([n for _, n in held])
            held, waiting = [(ids[size:], numbers[size:])], waiting - size
            return packed(ids[:size], numbers[:size])

        for batch in batches:
            kept, numbers = whole_numbers(batch.column(1), dimensions, scale)
            if len(kept):
                held.append((batch.column(0).take(pa.array(kept)), numbers))
                waiting += len(kept)
            while waiting >= chunk:
                yield taken(chunk)
        if waiting:
            yield taken(waiting)

    return vectors.select(F.col(id_name).alias("id"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, schema)


def starting_centroids(vectors: DataFrame, id_name: str, vector: str, k: int = K, seed: int = 1, dimensions: int = DIMENSIONS, scale: int = SCALE) -> np.ndarray:
    """The ``k`` kept vectors with the smallest hash of their id; only those reach the driver."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce(F.abs(F.floor(x * scale)) <= LARGEST, F.lit(False)) & ~F.isnan(x))
    kept = vectors.where((F.size(v) == dimensions) & fine & F.col(id_name).isNotNull())
    numbers = F.transform(v, lambda x: F.floor(x * scale).cast("bigint"))
    named = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_name).cast("string")), 256).alias("h"), numbers.alias("n"))
    rows = named.orderBy("h", "n").limit(k).collect()
    return np.array([r["n"] for r in rows], np.int64).reshape(len(rows), dimensions)


def _chunks(batches: Iterator[pa.RecordBatch], dimensions: int, width: int) -> Iterator[tuple[pa.Array, Chunk]]:
    for batch in batches:
        for at in range(batch.num_rows):
            ids, codes, sizes, entries = (batch.column(c)[at] for c in range(4))
            yield ids.values, Chunk(len(ids), codes.as_py(), sizes.as_py(), entries.as_py(), dimensions, width)


def moved(encoded: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The centroids after one round: one row per task and cluster is added up, k of them reach the driver."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for _, chunk in _chunks(batches, dimensions, width):
            cluster, _ = chunk.nearest(centroids)
            counts += np.bincount(cluster, minlength=k)
            sums += chunk.sums(cluster, k)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at]), pa.array(list(sums[at]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = encoded.mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    # Sums over all tasks may pass 64 bits; the quotients do not.
    each = parts.select("cluster", "n", F.posexplode("sums").alias("dim", "s"))
    added = each.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    after = centroids.copy()
    for row in added.collect():
        after[row["cluster"], row["dim"]] = int(row["s"]) // row["n"]
    return after


def assigned(encoded: DataFrame, centroids: np.ndarray, id_name: str, width: int = WIDTH) -> DataFrame:
    """The id, ``cluster`` and ``distance`` of every vector."""
    kind = encoded.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in _chunks(batches, centroids.shape[1], width):
            cluster, distance = chunk.nearest(centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], [id_name, "cluster", "distance"])

    return encoded.mapInArrow(run, f"`{id_name}` {kind}, cluster int, distance bigint")


def cluster_vectors(
    vectors: DataFrame, id_name: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
    seed: int = 1, dimensions: int = DIMENSIONS, scale: int = SCALE, width: int = WIDTH, chunk: int = CHUNK,
) -> Clusters:
    """Vectors clustered in ``rounds`` rounds and assigned once more."""
    starts = starting_centroids(vectors, id_name, vector, k, seed, dimensions, scale)
    encoded = materialize(encode_vectors(vectors, id_name, vector, dimensions, scale, width, chunk), "subvectors")
    if not len(starts):
        return Clusters(assigned(encoded.limit(0), np.zeros((1, dimensions), np.int64), id_name, width), starts)
    centroids = starts
    for _ in range(rounds):
        centroids = moved(encoded, centroids, width)
    return Clusters(materialize(assigned(encoded, centroids, id_name, width), "clusters"), centroids)


def with_inertia(found: Clusters) -> DataFrame:
    """Rows with ``cluster_inertia`` and ``inertia``: distances added up over their cluster and over all."""
    own = found.rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # As many rows as clusters, so at most k.
    both = own.crossJoin(F.broadcast(own.agg(F.sum("cluster_inertia").alias("inertia"))))
    return found.rows.join(F.broadcast(both), "cluster")
