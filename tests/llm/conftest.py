"""Documents with everything that may go wrong, as a fixture of every test here."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def prose(seed: int, words: int, start: str = "") -> str:
    rng = random.Random(seed)
    stock = [f"{start}{a}{b}" for a in "kstnhm" for b in ("a", "ela", "ori", "un", "ié", "o")]
    out = []
    for i in range(words):
        out.append("".join(rng.choices(stock, k=rng.randint(1, 3))))
        if i % 17 == 16:
            out[-1] += "\n"
    return " ".join(out)


def odd_rows() -> list[tuple]:
    rows = [
        (1, None, "en", "s1", None),
        (2, "", "en", "s1", 0),
        (3, " \t\n\x0b\x0c\r ", None, None, 7),
        (4, prose(1, 120), "en", "s1", None),
        (5, prose(1, 120), "en", "s2", None),  # a copy
        (6, prose(1, 119) + " other", "fr", "s1", None),  # a near copy
        (7, prose(2, 60_000), "en", "s1", None),  # very long
        (8, "one", "en", "s1", 3),
        (8, "one", "en", "s1", 3),  # the same row again
        (None, prose(3, 80), "de", "s1", None),
        (None, None, None, None, None),
        (9, "ÄÖ İ ﬁ \U0001f600 é " * 30, "de", "s1", None),
        (10, "line\n" * 90, "en", "s1", None),
        (11, "<|endoftext|> $$$ %%% ### " * 40, "en", "s1", None),
        (12, "12345 67890 !!! ...", "es", "s1", None),
    ]
    rows += [(20 + i, prose(100 + i, 90) + "\nshared last line of the site", "en", "s1", None) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with columns of names that operators might use inside."""
    from pyspark.sql import functions as F

    names = ("key", "fp", "id", "n", "_row", "_w", "kept", "n_words", "shard", "_gone", "node",
             "lines", "_lines", "lines_dropped", "stratum", "block", "size", "_key", "length")
    return odd.withColumns({name: F.lit("x") for name in names})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 1, 0) for i in range(1, 50)] + [(None, 1, 0), (4, None, None), (5, 0, 1), (4, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
