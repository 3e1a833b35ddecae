"""Language of whole texts: known words first, then progressively shorter character n-grams.

A word is a run of letters, lower-cased. A word met in the learned texts scores the logarithm of its smoothed relative frequency in each language. A
word that was not met backs off: with ``_`` at both ends it is read as character n-grams, the longest first; the first length of which
any n-gram was met gives the mean of the logarithms of those n-grams' relative frequencies, and a word of which not even a
letter was met says nothing. A text's language has the largest sum over all its words and the logarithm of the language's
share of labelled rows; its score is the share of that language in the evidence, softened by the root of the number of words.

Learning: words and n-grams of labelled texts are counted by Spark, n-grams once for each distinct word of a language. The share of a language is
counted over all labelled rows. Of each language the frequencies come from the distinct texts with the smallest hashes, at most
``max_rows`` of them and ``max_chars`` characters together (a documented bound on labelled rows; texts are read whole). The model that is
broadcast, sorted hashes of words and n-grams with a row of logarithms each, cannot outgrow those characters.

Nulls and ties: a null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was learned. Rows with a null language,
text or without a letter are not learned from. Languages that tie go by their name. Rows that share an id are different documents; a null id is kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.session import materialize

MAX_ROWS, MAX_CHARS = 10_000, 10_000_000
LONGEST, SMOOTHING = 5, 0.5
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
_KEY = "wordsandngrams!!"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; runs of other number signs alone are no words."""
    found = WORD.findall(text.lower()) if text else []
    return found if text is None or text.isascii() else [w for w in found if any(map(str.isalpha, w))]


def ngrams_of(word: str, n: int) -> list[str]:
    padded = f"_{word}_"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def hashes(parts: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(parts, object), hash_key=_KEY, categorize=False).astype(np.uint64).view(np.int64)


@dataclass
class Model:
    """Logarithms of relative frequencies by language, in the order of sorted hashes of words and n-grams."""

    languages: list[str]
    priors: np.ndarray
    word_keys: np.ndarray
    word_logs: np.ndarray
    ngram_keys: list[np.ndarray]
    ngram_logs: list[np.ndarray]

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row of logarithms for each of these distinct words."""
        out = np.zeros((len(words), len(self.languages)))
        at, known = _places(self.word_keys, hashes(words))
        out[known] = self.word_logs[at[known]]
        left = np.flatnonzero(~known)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            grams = [ngrams_of(words[i], n) for i in left]
            owner = np.repeat(np.arange(len(left)), [len(g) for g in grams])
            flat = [g for own in grams for g in own]
            if not flat:
                continue
            at, known = _places(self.ngram_keys[n - 1], hashes(flat))
            owner, rows = owner[known], self.ngram_logs[n - 1][at[known]]
            found = np.bincount(owner, minlength=len(left))
            total = np.stack([np.bincount(owner, rows[:, c], len(left)) for c in range(rows.shape[1])], axis=1)
            met = found > 0
            out[left[met]] = total[met] / found[met, None]
            left = left[~met]
        return out


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part


def training_rows(documents: DataFrame, text: str = "text", lang: str = "lang", max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> tuple[DataFrame, dict[str, int]]:
    """``lang, text`` of the rows learned from, and the number of labelled rows of each language."""
    named = documents.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    placed = named.withColumn("u", F.xxhash64("text", "lang"))
    shares = {r["lang"]: r["n"] for r in placed.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # Only hashes and lengths move, copies meet before they do, and each task sends at most max_rows texts of a language.
    order = Window.partitionBy("lang").orderBy("u")
    texts = placed.groupBy("lang", "u").agg(F.max(F.length("text")).alias("n"))
    first = texts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_rows)
    running = first.withColumn("sum", F.sum("n").over(order)).where(F.col("sum") <= max_chars)
    last = running.groupBy("lang").agg(F.max("u").alias("last"))
    # One row a language.
    taken = placed.join(F.broadcast(last), "lang").where(F.col("u") <= F.col("last"))
    taken = taken.groupBy("lang", "u").agg(F.first("text").alias("text"))
    return taken.select("lang", "text"), shares


def learn(documents: DataFrame, text: str = "text", lang: str = "lang", max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model:
    """A model of the labelled ``documents``; leave held-out rows away before."""
    rows, shares = training_rows(documents, text, lang, max_rows, max_chars)
    languages = sorted(shares, key=str.encode)
    total = sum(shares.values())
    priors = np.log(np.array([shares[name] for name in languages], float) / max(1, total))

    def split(batch: pa.RecordBatch) -> dict:
        """Words of a batch, counted by language."""
        langs, found = [], []
        for name, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = words_of(own)
            found += own
            langs += [name] * len(own)
        counted = pd.DataFrame({"lang": langs, "word": found}).value_counts(sort=False).reset_index(name="n")
        return {"lang": pa.array(counted["lang"], pa.string()), "word": pa.array(counted["word"], pa.string()), "n": pa.array(counted["n"], pa.int64())}

    words = map_batches(rows, split, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = materialize(words, "lang-words")

    def cut(batch: pa.RecordBatch) -> dict:
        langs, size, grams = [], [], []
        for name, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for n in range(1, LONGEST + 1):
                own = ngrams_of(word, n)
                grams += own
                langs += [name] * len(own)
                size += [n] * len(own)
        return {"lang": pa.array(langs, pa.string()), "size": pa.array(size, pa.int32()), "h": hashes(grams)}

    grams = map_batches(words.select("lang", "word"), cut, "lang string, size int, h bigint").groupBy("lang", "size", "h").agg(F.count("*").alias("n"))
    known = map_batches(words.select("lang", "word", "n"), lambda b: {"lang": b.column(0), "size": pa.array(np.zeros(b.num_rows, np.int32)), "h": hashes(b.column(1).to_pylist()), "n": b.column(2)}, "lang string, size int, h bigint, n bigint")
    counts = known.unionByName(grams).toArrow().to_pandas()
    tables = [_logarithms(counts[counts["size"] == n], languages) for n in range(LONGEST + 1)]
    return Model(languages, priors, tables[0][0], tables[0][1], [t[0] for t in tables[1:]], [t[1] for t in tables[1:]])


def _logarithms(counts: pd.DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(counts["h"].to_numpy(np.int64), return_inverse=True)
    place = {name: i for i, name in enumerate(languages)}
    table = np.zeros((len(keys), len(languages)))
    np.add.at(table, (at, counts["lang"].map(place).to_numpy(np.int64)), counts["n"].to_numpy(float))
    smooth = table + SMOOTHING
    return keys, np.log(smooth / (table.sum(axis=0) + SMOOTHING * max(1, len(keys)))).astype(np.float32)


def predict(documents: DataFrame, model: Model, text: str = "text", id_name: str = "doc_id") -> DataFrame:
    """The id, ``lang_pred``, ``score`` and ``n_words`` of every document."""
    kind = dict(documents.dtypes)[id_name]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        model = shared.value
        found = [words_of(t) for t in batch.column(1).to_pylist()]
        sizes = np.array([len(w) for w in found])
        pred, score = [UNKNOWN] * len(found), np.zeros(len(found))
        if sizes.sum() and model.languages:
            codes, distinct = pd.factorize(np.array([w for own in found for w in own], object))
            rows = model.word_scores(list(distinct))
            owner = np.repeat(np.arange(len(found)), sizes)
            sums = np.stack([np.bincount(owner, rows[codes, c], len(found)) for c in range(rows.shape[1])], axis=1)
            total = sums + model.priors
            best = total.argmax(axis=1)
            soft = np.exp((total - total.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(sizes, 1))[:, None])
            shares = soft / soft.sum(axis=1, keepdims=True)
            for i in np.flatnonzero(sizes):
                pred[i], score[i] = model.languages[best[i]], shares[i, best[i]]
        return {"id": batch.column(0), "lang_pred": pa.array(pred, pa.string()), "score": score, "n_words": pa.array(sizes, pa.int64())}

    found = map_batches(documents.select(id_name, text), run, f"id {kind}, lang_pred string, score double, n_words bigint")
    return found.withColumnRenamed("id", id_name)
