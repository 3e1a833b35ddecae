"""Token ids of documents as flat unsigned integer files with 64-bit document offsets, read by memory mapping.

A folder holds one set of files per written partition: ``<name>.bin`` (ids, little-endian, 16 bits wide if the vocabulary allows, else
32), ``<name>.idx`` (64-bit offsets of its documents in ids, one more than documents) and ``<name>.ids`` (64-bit doc_ids; the lowest
integer stands for null), and the table ``manifest`` with, for each partition in order, name, documents, ids and the bases: how many
documents and ids all partitions before it hold, from prefix sums over one row per partition. A task that is run again writes
under a new name, and only names in the manifest count.

Documents are dealt out by ranges of doc_id and sorted inside them, so the files in order of their partition are the documents in ascending
doc_id order, null first; documents that share a doc_id follow each other by a hash of their text. A null or empty text has the
end id alone. The folder must be one that every executor can reach; memory mapping needs it mounted, other file systems are read in ranges.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder, vocabulary_size

NULL_ID = -(2**63)


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
    return fs.LocalFileSystem(), os.path.abspath(folder)


def write_token_files(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 0, partitions: int | None = None) -> None:
    """Encode and write all documents; ``end_id`` follows each document's ids."""
    spark = documents.sparkSession
    width = 2 if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else 4
    own = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    parts = own.repartitionByRange(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        name, encode = uuid.uuid4().hex, encoder(tokenizer).encode
        end, kind = np.array([end_id], "<u4").tobytes(), f"<u{width}"
        part, docs, ids = -1, 0, 0
        with (
            system.open_output_stream(f"{path}/{name}.bin") as flat,
            system.open_output_stream(f"{path}/{name}.idx") as offsets,
            system.open_output_stream(f"{path}/{name}.ids") as names,
        ):
            offsets.write(np.zeros(1, "<i8").tobytes())
            for batch in batches:
                part = batch.column(2)[0].as_py()
                encoded = [e + end for e in encode([t or "" for t in batch.column(1).to_pylist()])]
                flat.write(np.frombuffer(b"".join(encoded), "<u4").astype(kind).tobytes())
                ends = ids + np.cumsum([len(e) // 4 for e in encoded])
                offsets.write(ends.astype("<i8").tobytes())
                names.write(batch.column(0).fill_null(NULL_ID).to_numpy().astype("<i8").tobytes())
                docs, ids = docs + len(encoded), int(ends[-1])
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([docs], pa.int64()), pa.array([ids], pa.int64()), pa.array([width], pa.int32())], ["part", "name", "docs", "ids", "width"])

    rows = parts.withColumn("_part", F.spark_partition_id()).mapInArrow(run, "part int, name string, docs bigint, ids bigint, width int")
    rows.write.parquet(f"{folder}/written")
    # One row per partition: their number is that of tasks, not of documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    written = spark.read.parquet(f"{folder}/written")
    bases = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_base") for c in ("docs", "ids")]
    written.select("*", *bases).write.parquet(f"{folder}/manifest")


class TokenFile:
    """One partition's files. Nothing is read before it is asked for."""

    def __init__(self, folder: str, name: str, docs: int, ids: int, width: int):
        self.system, self.path = file_system(folder)
        self.name, self.kind, self.ids = name, f"<u{width}", ids
        self.offsets = self._array("idx", "<i8", docs + 1)
        self.doc_ids = self._array("ids", "<i8", docs)
        self.flat = self._array("bin", self.kind, ids) if self._local() else None

    def _local(self) -> bool:
        return isinstance(self.system, fs.LocalFileSystem)

    def _array(self, end: str, kind: str, count: int) -> np.ndarray:
        path = f"{self.path}/{self.name}.{end}"
        if self._local():
            return np.memmap(path, kind, "r", shape=(count,))
        with self.system.open_input_file(path) as f:
            return np.frombuffer(f.read(), kind)

    def document(self, at: int) -> np.ndarray:
        start, end = int(self.offsets[at]), int(self.offsets[at + 1])
        if self.flat is not None:
            return self.flat[start:end]
        width = np.dtype(self.kind).itemsize
        with self.system.open_input_file(f"{self.path}/{self.name}.bin") as f:
            f.seek(start * width)
            return np.frombuffer(f.read((end - start) * width), self.kind)


def read_token_files(spark: SparkSession, folder: str, slice_docs: int = 50_000, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids`` of every document in the files.

    ``start`` counts the ids of all documents before it. A task maps a slice of a file.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    slices = manifest.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("docs") - 1, F.lit(slice_docs).cast("bigint"))).alias("first"))
    slices = slices.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(folder, row["name"], row["docs"], row["ids"], row["width"])
                last = min(row["docs"], row["first"] + slice_docs)
                for low in range(row["first"], last, 1000):
                    high = min(last, low + 1000)
                    ids = [np.asarray(file.document(at)) for at in range(low, high)]
                    names = np.asarray(file.doc_ids[low:high])
                    columns = [
                        pa.array(names, pa.int64(), mask=names == NULL_ID),
                        pa.array(row["ids_base"] + np.asarray(file.offsets[low:high])),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return slices.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else ""))
