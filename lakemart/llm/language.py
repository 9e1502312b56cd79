"""Operator 8: languages by string kernels.

Two texts are similar if they share many n-grams: the blended-spectrum presence
kernel counts the n-grams of 1 to ``N`` characters that occur in both, whatever
how often, and divides by the root of the product of their numbers. A text is
lower-cased, everything but letters is one blank. n-grams are numbered by a
hash, so a text is a row of ``DIMENSIONS`` bits.

The kernel to all training texts would be too much at prediction. Nyström's
method takes some of them as landmarks: the kernel to these, times the inverse
root of the kernel among them, are the features of a text, and a ridge
regression on them per language (one against the rest) is kernel ridge
regression in the space of the landmarks. Scoring a batch is two matrix
products.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm import arrays
from lakemart.llm.common import free_name, ship, with_row_key

N = 4
BITS = 14
DIMENSIONS = 1 << BITS
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_folded: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For every code point the number of its lower-case letter, 0 if it is no letter."""
    if not _folded:
        table = np.zeros(0x110000, dtype=np.uint32)
        for start, stop in ((0, 0xD800), (0xE000, 0x32000)):
            for c in range(start, stop):
                if chr(c).isalpha():
                    lower = chr(c).lower()
                    table[c] = ord(lower) if len(lower) == 1 else c
        _folded.append(table)
    return _folded[0]


def presence(column: pa.Array, n: int = N) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bits as a uint8 matrix, texts with a letter) for stretches of a column."""
    for lo, hi, data, bounds in arrays.pieces(column, most=512):
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        begins = (data & 0xC0) != 0x80  # bytes that begin a code point
        ends = np.concatenate([[0], np.cumsum(begins)])[bounds]
        letters = _fold()[points]
        has_letter = np.add.reduceat(np.concatenate([letters > 0, [False]]).astype(np.int64), np.minimum(ends[:-1], len(letters)))
        has_letter = (has_letter > 0) & (np.diff(ends) > 0)
        # A blank stands before every text, and no two blanks follow each other.
        codes = np.insert(letters, ends[:-1], 0)
        row = np.repeat(np.arange(hi - lo), np.diff(ends) + 1)
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0) | (row[1:] != row[:-1])
        codes, row = codes[keep].astype(np.uint64), row[keep]
        bits = np.zeros((hi - lo, DIMENSIONS), dtype=np.uint8)
        gram = np.zeros(len(codes), dtype=np.uint64)
        for size in range(1, n + 1):
            # The hash of the n-gram that ends at each character.
            gram = np.concatenate([np.zeros(1, dtype=np.uint64), gram[:-1]]) * np.uint64(0x100000001B3) + codes + np.uint64(size)
            hashed = (arrays.mix(gram) >> np.uint64(64 - BITS)).astype(np.int64)
            inside = np.zeros(len(row), dtype=bool)
            inside[size - 1 :] = row[size - 1 :] == row[: max(0, len(row) - size + 1)]
            bits[row[inside], hashed[inside]] = 1
        yield lo, hi, bits, has_letter


def _kernel(bits: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernel between rows of bits and landmarks (already divided by the root of their size)."""
    size = np.sqrt(np.maximum(bits.sum(axis=1, dtype=np.float32), 1))
    return bits.astype(np.float32) @ landmarks.T / size[:, None]


@dataclass
class Model:
    """Landmarks as packed bits, and the map from kernel values to a score per language."""

    landmarks: np.ndarray
    weights: np.ndarray
    languages: list[str]

    def __post_init__(self):
        bits = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        self._scaled = bits / np.sqrt(np.maximum(bits.sum(axis=1, keepdims=True), 1))

    def scores(self, bits: np.ndarray) -> np.ndarray:
        return _kernel(bits, self._scaled) @ self.weights


def train(packed: np.ndarray, names: list[str], landmarks: int, ridge: float = 1e-3) -> Model:
    """Kernel ridge regression in the space of landmarks, which are taken from the languages in turn."""
    languages = sorted(set(names))
    label = np.array([languages.index(x) for x in names])
    landmarks = max(landmarks, len(languages))  # each language has one at least
    turn = np.empty(len(label), dtype=np.int64)
    for k in range(len(languages)):
        turn[label == k] = np.arange((label == k).sum())
    chosen = np.lexsort((label, turn))[:landmarks]
    model = Model(packed[chosen], np.zeros((len(chosen), len(languages)), dtype=np.float32), languages)
    among = _kernel(np.unpackbits(model.landmarks, axis=1), model._scaled).astype(np.float64)
    value, vector = np.linalg.eigh((among + among.T) / 2)
    large = value > 1e-6 * value.max()
    root = vector[:, large] / np.sqrt(value[large])
    features = np.concatenate([_kernel(np.unpackbits(packed[i : i + 256], axis=1), model._scaled) for i in range(0, len(packed), 256)]) @ root
    target = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Rare languages count as much as frequent ones.
    weight = 1.0 / np.bincount(label)[label]
    gram = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
    model.weights = (root @ np.linalg.solve(gram, features.T @ (target * weight[:, None]))).astype(np.float32)
    return model


def fit(docs: DataFrame, sample: int = 1600, landmarks: int = 96, lang: str = "lang", text: str = "text") -> Model | None:
    """A model from a sample of labelled rows; None if there is no labelled text with a letter.

    At most ``sample`` rows are used: of each language as many, those whose text
    and label have the smallest digest, so the sample does not depend on the
    layout of the table. What reaches the driver is 2 kB of bits per row. Only
    the ``sample`` most frequent languages can be learned.
    """
    ship(docs.sparkSession)
    row = free_name(docs, "_row")
    labelled = with_row_key(docs, row).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(row).alias("row"), F.xxhash64(F.lit("sample"), F.col(text)).alias("digest")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    # One row per different text; texts don't move here.
    slim = labelled.groupBy("lang", "digest").agg(F.min("row").alias("row"))
    known = slim.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample).collect()
    if not known:
        return None
    quota = max(1, sample // len(known))
    # Digests are even: below these bounds are about four times as many rows as are wanted, in any table.
    bounds = [(k["lang"], min(2**63 - 1, -(2**63) + 2**64 * 4 * quota // k["n"])) for k in known]
    # A row per language. As an Arrow table, as a list would start Python workers of another kind, that stay.
    bounds = docs.sparkSession.createDataFrame(pa.table(dict(zip(("of", "bound"), map(list, zip(*bounds, strict=True)), strict=True))))
    few = slim.join(F.broadcast(bounds), (F.col("lang") == F.col("of")) & (F.col("digest") <= F.col("bound")))
    ranked = few.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("digest")))
    chosen = ranked.filter(F.col("nth") <= quota)
    picked = F.broadcast(chosen.select(F.col("row").alias("picked"), "nth"))  # at most ``sample`` rows
    chosen = labelled.join(picked, F.col("row") == F.col("picked"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, bits, has_letter in presence(batch.column(2)):
                rows = np.packbits(bits, axis=1)
                usable = [rows[i].tobytes() if has_letter[i] else None for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(usable, pa.binary())], names=["lang", "nth", "bits"]
                )

    rows = chosen.select("lang", "nth", "text").mapInArrow(pack, "lang string, nth int, bits binary").filter("bits IS NOT NULL").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["nth"]))
    packed = np.array([np.frombuffer(r["bits"], dtype=np.uint8) for r in rows])
    return train(packed, [r["lang"] for r in rows], landmarks)


def predict(docs: DataFrame, model: Model | None, text: str = "text", name: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1, in place of columns of these names.

    A text that is NULL or has no letter is ``und`` with score 0, and so is
    every text if there is no model. The score is the share of the language in
    the softmax of five times the regression values; ties go to the first
    language by name. Only the text decides. No shuffle; an empty table stays
    empty.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kept, both = docs.drop(name, score), free_name(docs, "_language")

    def label(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            languages, scores = _labelled(column, shared.value)
            yield pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(scores)], names=["lang", "score"])

    # Not to be computed twice, whatever is selected or filtered later.
    labelled = F.arrow_udf(label, "lang string, score double").asNondeterministic()
    told = kept.withColumn(both, labelled(text))
    return told.select(*kept.columns, F.col(both)["lang"].alias(name), F.col(both)["score"].alias(score))


def _labelled(column: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray]:
    """Language and score of every text of a column."""
    languages, scores = [UNKNOWN] * len(column), np.zeros(len(column))
    for lo, _, bits, has_letter in presence(column) if model else ():
        values = model.scores(bits[has_letter]).astype(np.float64)
        exp = np.exp(5 * (values - values.max(axis=1, keepdims=True)))
        share = exp / exp.sum(axis=1, keepdims=True)
        for i, k in zip((lo + np.flatnonzero(has_letter)).tolist(), values.argmax(axis=1).tolist(), strict=True):
            languages[i] = model.languages[k]
        scores[lo + np.flatnonzero(has_letter)] = share.max(axis=1)
    return languages, scores


def training_rows(docs: DataFrame) -> DataFrame:
    """The documents that may be learned from: all but those whose id has CRC-32 remainder 2 modulo 4."""
    return docs.filter(F.col("lang").isNotNull() & ~_held_out())


def _held_out():
    """NULL ids count as held out, so nothing is learned from them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


def predicted_languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = fit(training_rows(docs))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return predict(slim, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def with_known_language(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """``docs`` without those whose language can't be told: no letter or, if wanted, a score below ``least``.

    If there is nothing to learn from, no text can be judged but for its
    letters: only those that are NULL or have none are left out.
    """
    model = fit(training_rows(docs))
    if model is None:
        return with_letters(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            languages, scores = _labelled(column, shared.value)
            yield pa.array([x != UNKNOWN for x in languages] & (scores >= least))

    # Only texts go to Python and only a flag comes back; the other columns stay where they are.
    return docs.filter(F.arrow_udf(known, "boolean")("text"))


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without those whose text is NULL or has no letter. No shuffle."""
    ship(docs.sparkSession)

    def keep(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([bool(t) and any(_fold()[ord(c)] for c in t) for t in column.to_pylist()], pa.bool_())

    return docs.filter(F.arrow_udf(keep, "boolean")(text))
