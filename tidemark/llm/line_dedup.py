"""Removal of lines that repeat across documents, with levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys of at least
``min_chars`` code points are hashed to 128 bits. A run is a table bucketed and sorted by that hash with one row per key: in
how many documents it was seen and the largest doc_id that holds it. Each batch of documents is reduced to one row per
key and merge-anti-joined with all runs; the keys that none knows become a run of its own, sightings of known keys
are logged. ``fanout`` runs of a level are merged into one of the next. Runs and batches share their bucketing, so that the joins move nothing but the batch.

Nulls and repeats: a null text is one empty line, and stays null in ``drop_repeated_lines``; rows that share a doc_id
count as one document; documents with a null doc_id are one document that is smaller than any other. Columns besides
``doc_id`` and ``text`` are carried along untouched by ``drop_repeated_lines``.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.session import materialize, new_folder

SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: str) -> bytes | None:
    """The key in UTF-8."""
    return line.encode("utf-8", "surrogatepass").strip(SPACE).lower()


def key_hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "surrogatepass")) >= min_chars)


def line_hashes(documents: DataFrame, min_chars: int = 20) -> DataFrame:
    """``doc_id, h1, h2``: a row per document and distinct hash of its long enough lines."""

    def run(batch: pa.RecordBatch) -> dict:
        ids, owners, hashes = batch.column(0), [], []
        for at, text in enumerate(batch.column(1).to_pylist()):
            if text:
                keys = {k for k in map(line_key, text.split("\n")) if _long_enough(k, min_chars)}
                hashes += map(key_hash, keys)
                owners += [at] * len(keys)
        pairs = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
        return {"doc_id": ids.take(pa.array(owners, pa.int64())), "h1": pairs[:, 0], "h2": pairs[:, 1]}

    kind = dict(documents.dtypes)["doc_id"]
    return map_batches(documents.select("doc_id", "text"), run, f"doc_id {kind}, h1 bigint, h2 bigint")


@dataclass
class LineRuns:
    """Levelled runs of ``h1, h2, docs, last_doc`` in the shared folder."""

    spark: SparkSession
    buckets: int = 32
    fanout: int = 3
    levels: list[list[str]] = field(default_factory=lambda: [[]])
    names: list[str] = field(default_factory=list)
    hits: list[DataFrame] = field(default_factory=list)

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        rows = rows.select("h1", "h2", "docs", "last_doc").repartition(self.buckets, "h1", "h2")
        writer = rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        writer.option("path", new_folder(self.spark, "line-run")).saveAsTable(name)
        self.names.append(name)
        return name

    def add(self, lines: DataFrame) -> DataFrame:
        """Merge a batch of ``doc_id, h1, h2``; returns the keys that no earlier batch had.

        New keys become a run; what the batch adds to known keys is logged in ``hits``, which is small.
        """
        batch = lines.distinct().groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last_doc"))
        batch = fresh = self.spark.table(self._write(batch))
        for run in self._runs():
            fresh = fresh.join(run, ["h1", "h2"], "left_anti")
        name = self._write(fresh)
        fresh = self.spark.table(name)
        if self.levels != [[]]:
            self.hits.append(materialize(batch.join(fresh, ["h1", "h2"], "left_anti"), "line-hits"))
        self.levels[0].append(name)
        self._compact()
        return fresh

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _compact(self) -> None:
        """The runs of a full level become one run of the next; no two of them share a key."""
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) >= self.fanout:
                merged = _union([self.spark.table(name) for name in self.levels[depth]])
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[depth + 1].append(self._write(merged))
                self.levels[depth] = []

    def repeated(self, min_docs: int) -> DataFrame:
        """Keys found in at least ``min_docs`` documents, over all batches."""
        rows = _union([*self._runs(), *self.hits]).groupBy("h1", "h2")
        return rows.agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc")).where(F.col("docs") >= min_docs)

    def forget(self) -> None:
        """Take the runs' names out of the session catalog; their files stay."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def repeated_lines(documents: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 3) -> DataFrame:
    """``doc_id, hashes``: for each document the hashes of the keys whose lines it loses.

    The table is dealt into ``batches`` by doc_id, as if they had arrived one after another; the result does not depend on it.
    """
    spark = documents.sparkSession
    folder = new_folder(spark, "line-hashes")
    lines = line_hashes(documents, min_chars)
    kind = dict(documents.dtypes)["doc_id"]
    lines.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema(f"doc_id {kind}, h1 bigint, h2 bigint, batch int").parquet(folder)
    runs = LineRuns(spark, buckets=max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))), fanout=fanout)
    for at in range(batches):
        runs.add(lines.where(F.col("batch") == at).drop("batch"))
    repeated = materialize(runs.repeated(min_docs), "repeated-lines")
    runs.forget()
    lost = lines.join(repeated, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("hashes"))


def kept_lines(documents: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 3) -> DataFrame:
    """All columns of ``documents`` with ``text`` less its repeated lines, in struct ``_lines``: text, n_lines, n_dropped."""
    lost = repeated_lines(documents, min_chars, min_docs, batches, fanout).toDF("_lost_id", "_lost_hashes")
    joined = documents.join(lost, F.col("doc_id").eqNullSafe(F.col("_lost_id")), "left").drop("_lost_id")
    at = joined.columns.index("text")

    def run(batches_):
        for batch in batches_:
            texts, counts, drops = [], [], []
            for text, hashes in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                kept = lines
                if hashes:
                    gone = {(h["h1"], h["h2"]) for h in hashes}
                    kept = [x for x in lines if not (_long_enough(k := line_key(x), min_chars) and tuple(np.frombuffer(key_hash(k), "<i8").tolist()) in gone)]
                texts.append("\n".join(kept) if text is not None else "")
                counts.append(len(lines))
                drops.append(len(lines) - len(kept))
            out = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(drops, pa.int64())], ["text", "n_lines", "n_dropped"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], [*batch.schema.names[:-1], "_lines"])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema), "_lines struct<text: string, n_lines: bigint, n_dropped: bigint>"])
    return joined.mapInArrow(run, fields)


def drop_repeated_lines(documents: DataFrame, **options) -> DataFrame:
    """``documents`` with repeated lines taken out of ``text``; every row stays, a null text stays null."""
    out = kept_lines(documents, **options)
    return out.select(*[F.when(F.col("text").isNotNull(), F.col("_lines.text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in documents.columns])
