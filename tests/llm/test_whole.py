"""Whole queries against plain versions: quality rules (7), languages (8), the mix with very many equal ids (6)."""

import collections
import math
import random
import time
import zlib

import duckdb
import numpy as np
import pytest

from lakemart.llm import language, mixing, quality
from lakemart.llm.common import ordered_places
from lakemart.llm.oracles import ORACLES
from tests.llm.test_rows import brute_measures, words

# 6 ------------------------------------------------------------------------------------------------------------------


def test_ordered_places_of_a_crowded_group(spark):
    """Places are those of one sort, whether values repeat above the bound or not, and whatever the files."""
    rng = random.Random(6)
    data = [(rng.choice("gh"), rng.randrange(3), rng.randrange(4), rng.choice(["often", "often", "less", *"abcdef", None])) for _ in range(900)]
    rows_ = spark.createDataFrame(data, "grp string, part long, size long, same string")
    expected = collections.Counter()
    for g in "gh":
        own = sorted((r for r in data if r[0] == g), key=lambda r: (r[1], r[2], r[3] is not None, r[3] or ""))
        expected.update((*r, n) for n, r in enumerate(own))
    for heavy, parts in ((50, 1), (50, 5), (300, 3), (10**6, 2)):
        placed = ordered_places(rows_.repartition(parts), "grp", "part", ["size", "same"], "same", "nth", heavy=heavy)
        assert collections.Counter(tuple(r) for r in placed.collect()) == expected, (heavy, parts)


def test_mix_of_very_many_rows_without_id(spark):
    """60,000 NULL ids: the copies are those of the SQL, and the same after the files are cut anew."""
    docs = spark.range(64_000).selectExpr(
        "IF(id < 60000, NULL, id) AS doc_id", "repeat('w ', CAST(id % 37 AS int)) AS text", "IF(id % 5 = 0, 'b', 'a') AS source"
    )
    count = lambda df: collections.Counter((r["doc_id"], r["size"], r["target"], r["n_copies"]) for r in df.collect())
    found = count(mixing.mixed_documents(docs.repartition(3)))
    assert found == count(mixing.mixed_documents(docs.repartition(7)))
    duck = duckdb.connect()
    duck.execute("""CREATE TABLE documents AS SELECT CASE WHEN id < 60000 THEN NULL ELSE id END AS doc_id, repeat('w ', CAST(id % 37 AS INT)) AS text,
        CASE WHEN id % 5 = 0 THEN 'b' ELSE 'a' END AS source FROM range(64000) t(id)""")
    sql = duck.execute(f"SELECT doc_id, size, target, n_copies FROM ({ORACLES['op6_source_mix']})").fetchall()
    assert found == collections.Counter(sql)


# 7 ------------------------------------------------------------------------------------------------------------------


def plain_tail(k, n, p):
    """Probability of at most k successes, term by term."""
    return math.fsum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def plain_verdicts(docs, labels):
    """{doc_id: kept} by cutoffs found with loops."""
    measured = {}
    for doc_id, text, lang in docs:
        n, chars, symbols, dup, repeats, failed = brute_measures(text)
        lines = sum(1 for line in (text or "").split("\n") if words(line))
        part = lambda a, b: a * 1000 // b if b else 0
        values = {"symbols": part(symbols, chars), "repeats": part(repeats, n), "lines": part(dup, lines), "length": part(chars, n)}
        measured[doc_id] = lang, values, failed
    good = [d for d, q in labels if q == 1 and d in measured and not measured[d][2]]
    strata = {m[0] for m in measured.values()}
    with_labels = {measured[d][0] for d in good}
    error = quality.ERROR / (len(quality.RULES) * (len(with_labels) + 1))

    def allowed(n):
        k = -1
        while n and k + 1 <= n and plain_tail(k + 1, n, quality.RISK) <= error:
            k += 1
        return k

    def cut(stratum, rule):
        own = [measured[d][1][rule] for d in good if measured[d][0] == stratum]
        pool = [measured[d][1][rule] for d in good]
        most, most_of_pool = allowed(len(own)), allowed(len(pool))
        likely = next(k for k in range(len(own) + 1) if k == len(own) or 1 - plain_tail(k, len(own), quality.RISK) <= quality.ERROR)
        for c in quality.RULES[rule]:
            above = sum(v > c for v in own)
            if most >= 0 and above <= most or most < 0 and sum(v > c for v in pool) <= most_of_pool and above <= likely:
                return c
        return None

    cuts = {(s, rule): cut(s, rule) for s in strata for rule in quality.RULES}
    return {
        d: not failed and not any(cuts[s, rule] is not None and v > cuts[s, rule] for rule, v in values.items())
        for d, (s, values, failed) in measured.items()
    }


def test_quality_query_against_loops(spark):
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(2400):
        lang = rng.choices(["en", "de", None], [8, 2, 1])[0]
        bad = rng.random() < 0.1
        own = [f"w{rng.randrange(4000)}" + ("#$%" * rng.randrange(1, 4) if bad and rng.random() < 0.5 else "") for _ in range(rng.randrange(52, 75))]
        if bad and rng.random() < 0.3:
            own[10:30] = own[30:50]
        text = " ".join(own) if rng.random() < 0.7 else "\n".join(" ".join(own[k : k + 9]) for k in range(0, len(own), 9))
        docs.append((i, text + ("\nsame line" * rng.randrange(6) if bad else ""), lang))
        if rng.random() < 0.9:
            labels.append((i, 0 if bad else 1))
    docs += [(9000, None, "en"), (9001, "", None), (9002, "short", "de")]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["kept"] for r in quality.judged(table, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    expected = plain_verdicts(docs, labels)
    assert found == expected
    verdicts = [expected[d] for d, q in labels if q == 0]
    assert verdicts.count(False) > 50 and sum(not expected[d] for d, q in labels if q == 1) < 40


@pytest.mark.parametrize("n", [10**6, 10**9])
def test_binomial_bounds_of_very_many_labels(n):
    began = time.perf_counter()
    allowed, likely = quality.most_rejected(n, 0.005, 0.01), quality.most_likely(n, 0.005, 0.01)
    assert time.perf_counter() - began < 10
    spread = math.sqrt(n * 0.005 * 0.995)
    # Near the normal quantile at 1 %, 2.326 spreads from the mean.
    assert abs((0.005 * n - allowed) / spread - 2.326) < 0.05 and abs((likely - 0.005 * n) / spread - 2.326) < 0.05
    assert abs(quality.tail(allowed, n, 0.005) + quality.above(allowed, n, 0.005) - 1) < 1e-9


# 8 ------------------------------------------------------------------------------------------------------------------


def plain_bits(text):
    """The numbers of a text's n-grams, character by character."""
    mask, out = (1 << 64) - 1, set()
    codes = [0]
    for c in text:
        code = language._fold()[ord(c)].item()
        if code or codes[-1]:
            codes.append(code)

    def mixed(h):
        h ^= h >> 30
        h = h * 0xBF58476D1CE4E5B9 & mask
        h ^= h >> 27
        h = h * 0x94D049BB133111EB & mask
        return h ^ h >> 31

    for end in range(len(codes)):
        for size in range(1, language.N + 1):
            if end + 1 >= size:
                h = 0
                for k in range(1, size + 1):
                    place = end - size + k
                    h = (h * 0x100000001B3 + codes[place] + k) & mask
                out.add(mixed(h) >> (64 - language.BITS))
    return out


def plain_language(train, texts, landmarks):
    """Predictions by kernels between sets and kernel ridge regression over the landmarks, in double precision."""
    languages = sorted({lang for lang, _ in train})
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    by_lang = {x: [bits for lang, bits in train if lang == x] for x in languages}
    marks = [by_lang[x][turn] for turn in range(len(train)) for x in languages if turn < len(by_lang[x])][:landmarks]
    among = np.array([[kernel(a, b) for b in marks] for a in marks])
    value, vector = np.linalg.eigh(among)
    large = value > 1e-6 * value.max()
    root = vector[:, large] / np.sqrt(value[large])
    x = np.array([[kernel(bits, m) for m in marks] for _, bits in train]) @ root
    y = np.array([[1.0 if lang == c else -1.0 for c in languages] for lang, _ in train])
    w = np.array([1 / len(by_lang[lang]) for lang, _ in train])[:, None]
    beta = np.linalg.solve(x.T @ (x * w) + 1e-3 * np.eye(x.shape[1]), x.T @ (y * w))
    scores = np.array([[kernel(plain_bits(t), m) for m in marks] for t in texts]) @ root @ beta
    return [languages[k] for k in scores.argmax(axis=1)], scores


def test_language_query_against_sets(documents):
    """The predictions are those of a plain classifier that is fitted on the same rows."""
    docs = documents.filter("text IS NULL OR length(text) < 700").limit(60)
    found = {r["doc_id"]: r for r in language.predicted_languages(docs).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    held_out = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}
    assert {d: r["held_out"] for d, r in found.items()} == held_out
    # The rows learned from, in the order of their digests: different texts with a label.
    digest = docs.selectExpr("lang", "text", "xxhash64('sample', text) AS digest").filter("lang IS NOT NULL AND text IS NOT NULL")
    learned = {(r["lang"], r["text"]) for r in rows if r["lang"] and not held_out[r["doc_id"]]}
    ordered = sorted({(r["lang"], r["digest"], r["text"]) for r in digest.collect() if (r["lang"], r["text"]) in learned})
    train = [(lang, plain_bits(text)) for lang, _, text in ordered if any(language._fold()[ord(c)] for c in text)]
    texts = [(r["doc_id"], r["text"]) for r in rows if r["text"] and any(language._fold()[ord(c)] for c in r["text"])]
    expected, scores = plain_language(train, [t for _, t in texts], 96)
    clear = np.sort(scores, axis=1)[:, -1] - np.sort(scores, axis=1)[:, -2] > 0.01
    pairs = [(found[d]["lang_pred"], lang) for (d, _), lang, ok in zip(texts, expected, clear, strict=True) if ok]
    assert len(pairs) > 0.9 * len(texts) and all(a == b for a, b in pairs)
    assert all(found[r["doc_id"]]["lang_pred"] == "und" for r in rows if r["doc_id"] not in {d for d, _ in texts})
