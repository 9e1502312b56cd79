"""Operator 7: quality rules whose cutoffs carry a guarantee.

Each rule rejects a document if a measure of its text is above a cutoff. The
cutoffs are chosen on labelled documents, per stratum (language): among fixed
candidates the strictest for which the share of good documents that it rejects
is below ``risk``, shown by an exact binomial test. The tests of all strata,
and rules share one error probability (Bonferroni); the candidates of a rule are
tested in a fixed sequence from lenient to strict up to the first that fails,
which costs nothing. So with probability 1 - ``error`` every chosen cutoff keeps
its promise. A stratum with too few labels to show anything, or none, takes
the cutoff shown on the good documents of all strata together, one more group in
the count of tests; that one promises the risk over all of them, not for each. Where
the stratum's own labels speak against it, the next more lenient candidate is taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm import arrays
from lakemart.llm.common import apart, ship, stored

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
_WORD = ~arrays.SPACE
_NEWLINE = np.arange(256) == 0x0A
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Measures of a rule: name, value in thousandths, candidate cutoffs from strict to lenient.
RULES: dict[str, list[int]] = {
    "symbols": [20, 30, 50, 75, 100, 150, 200, 300],  # symbols per 1000 characters of words
    "repeats": [50, 100, 150, 200, 250, 300, 350, 400, 450],  # words in repeated windows per 1000 words
    "lines": [50, 100, 150, 200, 300, 400, 500],  # repeated lines per 1000 lines with a word
    "length": [8000, 9000, 10000, 12000, 15000, 20000],  # characters per 1000 words
}
RISK = 0.005
ERROR = 0.05


def _repeated(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether a value occurs before or after in the same row: -1 no, 0 the first time, 1 again."""
    key = arrays.mix(values ^ arrays.mix(row.astype(np.uint64)))
    order = np.lexsort((np.arange(len(key)), key))
    ordered = key[order]
    same = np.concatenate([[False], ordered[1:] == ordered[:-1], [False]])
    out = np.full(len(key), -1, dtype=np.int8)
    out[order[same[:-1]]] = 1
    out[order[~same[:-1] & same[1:]]] = 0
    return out


def measure(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The five measures and the number of lines with a word, for each text of a piece."""
    rows = len(bounds) - 1
    starts, ends, row = arrays.words(data, bounds)
    n_words = np.bincount(row, minlength=rows)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[bounds[1:]] - total[bounds[:-1]]

    chars = per_text(_WORD[data] & ((data & 0xC0) != 0x80))
    symbols = per_text(_SYMBOL[data])
    # Lines: whole, as they stand between line breaks; only those with a word count.
    begin, end, line_row = arrays.words(data, bounds, _NEWLINE)
    have = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, line_row = begin[have], end[have], line_row[have]
    again = _repeated(arrays.word_hashes(data, begin, end), line_row) == 1
    # Windows of three words of one text.
    hashes = arrays.word_hashes(data, starts, ends)
    covered = np.zeros(len(hashes) + 1, dtype=bool)
    if len(hashes) > 2:
        at = np.flatnonzero(row[2:] == row[:-2])
        grams = arrays.run_hashes(hashes, at, at + 3)
        twice = at[_repeated(grams, row[at]) >= 0]
        for k in range(3):
            covered[twice + k] = True
    return [
        n_words, chars, symbols, np.bincount(line_row[again], minlength=rows),
        np.bincount(row[covered[:-1]], minlength=rows), np.bincount(line_row, minlength=rows),
    ]


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` with the measures and n_lines of every whole text. No shuffle."""
    ship(docs.sparkSession)
    names = [*MEASURES, "n_lines"]
    kept = docs.select(*keep)
    schema = kept.withColumns({n: F.lit(0).cast("long") for n in names}).schema

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros(batch.num_rows, dtype=np.int64) for _ in names]
            for lo, hi, data, bounds in arrays.pieces(batch.column(0)):
                for target, values in zip(out, measure(data, bounds), strict=True):
                    target[lo:hi] = values
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(x) for x in out)], names=schema.names)

    return docs.select(F.col(text), *keep).mapInArrow(compute, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _values() -> dict[str, Column]:
    """Each rule's measure in thousandths; 0 where there is nothing to divide by."""

    def per_thousand(part: str, whole: str) -> Column:
        return F.coalesce(F.call_function("div", F.col(part) * 1000, F.nullif(F.col(whole), F.lit(0))), F.lit(0))

    return {
        "symbols": per_thousand("n_symbols", "word_chars"), "repeats": per_thousand("n_repeat_words", "n_words"),
        "lines": per_thousand("n_dup_lines", "n_lines"), "length": per_thousand("word_chars", "n_words"),
    }


def _below(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` successes, for ``k`` up to the mean: terms fall from ``k`` down, so some spreads are enough."""
    first = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term, total = 1.0, 0.0
    while k >= 0 and term > 1e-18 * total:
        total += term
        term *= k / (n - k + 1) * ((1 - p) / p)
        k -= 1
    return min(1.0, math.exp(first) * total)


def tail(rejected: int, n: int, p: float) -> float:
    """Probability of at most ``rejected`` successes in ``n`` trials of probability ``p``."""
    if rejected >= n:
        return 1.0
    return _below(rejected, n, p) if rejected <= n * p else 1.0 - above(rejected, n, p)


def above(rejected: int, n: int, p: float) -> float:
    """Probability of more than ``rejected`` successes: at most so many failures."""
    if rejected >= n:
        return 0.0
    return _below(n - rejected - 1, n, 1 - p) if rejected >= n * p else 1.0 - tail(rejected, n, p)


def most_rejected(n: int, risk: float, error: float) -> int:
    """The largest number of rejections among ``n`` good documents that shows a rejection rate below ``risk``; -1 if none does.

    It shows it if so few rejections had at most probability ``error`` at the rate ``risk``.
    """
    lo, hi = -1, int(n * risk) + 1
    while hi - lo > 1:
        middle = (lo + hi) // 2
        lo, hi = (middle, hi) if tail(middle, n, risk) <= error else (lo, middle)
    return lo


def most_likely(n: int, risk: float, error: float) -> int:
    """The largest number of rejections among ``n`` good documents that doesn't speak against the rate ``risk``.

    More would have at most probability ``error`` at that rate.
    """
    lo, hi = -1, n
    while hi - lo > 1:
        middle = (lo + hi) // 2
        lo, hi = (lo, middle) if above(middle, n, risk) <= error else (middle, hi)
    return hi


def _counted(holdout: DataFrame) -> DataFrame:
    """Per stratum n and the number of documents above each candidate, one aggregation."""
    return holdout.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *(F.sum((F.col(rule) > c).cast("long")).alias(f"{rule}_{c}") for rule, steps in RULES.items() for c in steps),
    )


def _tested(counts: DataFrame, risk: float, error: float) -> DataFrame:
    """``counts``, one row per stratum, with the rejections ``allowed``, those ``likely``, and pool_allowed and counts of the pool."""
    names = [f"{rule}_{c}" for rule, steps in RULES.items() for c in steps]
    everything = Window.partitionBy()
    pooled = counts.withColumns({f"pool_{x}": F.sum(x).over(everything) for x in ["n", *names]})
    # Only strata with labels are tested; the pool is one more.
    groups = pooled.withColumn("groups", F.sum((F.col("n") > 0).cast("long")).over(everything) + 1)
    allowed = F.udf(lambda n, groups: most_rejected(n, risk, error / (len(RULES) * groups)), "long")
    likely = F.udf(lambda n: most_likely(n, risk, error), "long")
    return groups.withColumns({"allowed": allowed("n", "groups"), "pool_allowed": allowed("pool_n", "groups"), "likely": likely("n")})


def _own(rule: str) -> Column:
    return F.coalesce(*(F.when(F.col(f"{rule}_{c}") <= F.col("allowed"), F.lit(c)) for c in RULES[rule]))


def _pooled(rule: str) -> Column:
    fits = lambda c: (F.col(f"pool_{rule}_{c}") <= F.col("pool_allowed")) & (F.col(f"{rule}_{c}") <= F.col("likely"))
    return F.coalesce(*(F.when(fits(c), F.lit(c)) for c in RULES[rule]))


def cutoffs(holdout: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, one cutoff per rule) from good documents (stratum, one value per rule); NULL where its own labels show none.

    The strictest candidate wins that rejects no more documents than the test
    allows; a stricter one rejects as many at least, so all more lenient ones
    pass, too.
    """
    ship(holdout.sparkSession)
    return _tested(_counted(holdout), risk, error).select("stratum", *(_own(rule).alias(f"cut_{rule}") for rule in RULES))


def limits(strata: DataFrame, holdout: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, one cutoff per rule) for each of ``strata``: its own, or the pooled one where it has too few labels for any."""
    ship(holdout.sparkSession)
    counts = _counted(holdout).withColumnRenamed("stratum", "_of")
    every = strata.select("stratum").distinct().join(counts, F.col("stratum").eqNullSafe(F.col("_of")), "left").drop("_of")
    tested = _tested(every.fillna(0, [c for c in counts.columns if c != "_of"]), risk, error)
    return tested.select("stratum", *(F.when(F.col("allowed") < 0, _pooled(rule)).otherwise(_own(rule)).alias(f"cut_{rule}") for rule in RULES))


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per document: doc_id, the five measures, base_failed, kept, and the rules that reject it.

    Cutoffs come from the documents labelled good (``quality`` 1 in every label
    of the id) that the base rules keep. A document without language is in the
    stratum NULL; a stratum with too few labels, or none, has the pooled cutoffs.
    NULL and blank texts fail the base rules, as they have no words. Repeated rows are judged alike.
    Labels of unknown ids are ignored; empty tables give empty results.
    """
    rows = stored(
        measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("stratum"), "text"), ["doc_id", "stratum"])
        .withColumns(_values()).withColumn("base_failed", base_failed()),
        "measured",
    )
    good = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.min("quality").alias("quality")).filter("quality = 1")
    holdout = rows.filter(~F.col("base_failed")).join(good.select(apart("labelled").alias("good")), apart("doc_id") == F.col("good"), "left_semi")
    cuts = limits(rows, holdout, risk, error).withColumnRenamed("stratum", "of")
    ruled = rows.join(cuts, F.col("stratum").eqNullSafe(F.col("of")), "left")
    failed = F.filter(F.array(*(F.when(F.col(rule) > F.col(f"cut_{rule}"), F.lit(rule)) for rule in RULES)), lambda r: r.isNotNull())
    return ruled.select(
        "doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"), F.array_join(failed, ",").alias("failed_rules")
    )
