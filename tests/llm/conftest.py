"""Hand-made documents with what real ones bring along."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    words = "the of and alpha beta gamma delta river stone cloud light house garden winter summer north south train paper music".split()
    return " ".join(rng.choice(words) + rng.choice(["", "", ",", "s"]) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty, blank and very long texts, equal ids, repeated rows, extra columns with clashing names."""
    rng = random.Random(7)
    shared = sentence(rng, 60)
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b\f\r ", "en", "b", 6), (None, shared, "en", "a", 1),
        (None, None, None, None, None), (4, shared, "en", None, 1), (5, "pre " + shared + " post", "de", "b", 1),
        (5, "other " + shared, "de", "b", 1), (6, "ümlaut été 漢字 \U0001f600 \x00 end", "fr", "a", 1), (7, "12 34 ### $$ 5", None, "a", 1),
        (8, sentence(rng, 60_000), "en", "long", 1), (9, "x" * 300_000, "en", "long", 1),
        *[(10, "same row " + shared, "en", "a", 1)] * 5, *[(20 + i, "tie " + shared, "en", "b", 1) for i in range(5)],
    ]
    taken = "_row row fp size shard slot grown_shard score lang_pred target taken kept stratum n_copies _copy _mix_row _near_row Item_ID start"
    extra = [f"'{name}' AS `{name}`" for name in taken.split()]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2).selectExpr("*", *extra)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, testdata):
    return spark.read.parquet(f"{testdata}/documents.parquet")
