"""A corpus cleaned and packed by the training-data operators, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from tidemark.llm.common import prepare, read_table
from tidemark.session import materialize


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a field trained on the labels scores below the threshold."""
    prepare(spark)
    field = toxicity.train(toxicity.train_rows(spark, docs, read_table(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, field)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the last of them alone."""
    prepare(spark)
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_leaked(spark, docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 4096 tokens."""
    prepare(spark)
    return packing.pack_pieces(packing.encode_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False))


STAGES = [("toxicity", toxic), ("line dedup", lines), ("n-gram join", near_duplicates), ("decontamination", leaks), ("packing", packed)]
# Learning, tokenizers and local search are beyond SQL; a test compares the rows with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
