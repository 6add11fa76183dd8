from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tidecast.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def plain(row):
    return tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_counts_of_odd_texts(odd):
    got = quality.with_counts(odd, ["doc_id", "text"])
    for row in got.collect():
        assert plain(row) == counts(row["_row"]["text"]), row["_row"]["doc_id"]


def test_every_row_is_judged(odd, labels):
    rows = quality.judge_quality(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(not r["kept"] for r in rows if r["base_failed"])


def test_binomial_tail(spark):
    cases = [(0, 10, 0.1), (3, 50, 0.05), (40, 5000, 0.01), (0, 0, 0.5), (7, 7, 0.3)]
    for k, n, p in cases:
        row = spark.range(1).select(
            quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("t")
        ).first()
        want = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
        assert math.isclose(math.exp(row["t"]), want, rel_tol=1e-9)


def test_cutoffs_hold_their_promise(spark):
    """Good texts with few symbols, bad ones with many: the cutoff falls between, and no
    more good texts are rejected than allowed."""
    rows = [(i, "en" if i % 2 else "fr", 100, 500, (i % 20 == 0) * 3 if i % 4 else 90, 0, 0, False) for i in range(8000)]
    counted = spark.createDataFrame(
        rows, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long,"
        " n_dup_lines long, n_repeat_words long, base_failed boolean"
    )
    labels = counted.select("doc_id", F.when(F.col("doc_id") % 4 != 0, 1).otherwise(0).alias("quality"))
    limits = {r["_stratum"]: r for r in quality.cutoffs(counted, labels).collect()}
    assert set(limits) == {"en", "fr", None}
    assert limits["en"]["_c_symbols_per_word"] is not None
    judged = quality.judged(counted, quality.cutoffs(counted, labels)).join(labels, "doc_id")
    good = judged.where("quality = 1")
    assert good.where("not kept").count() <= quality.SETTINGS.max_rejected * good.count()
    assert judged.where("quality = 0 and stratum = 'fr' and kept").count() == 0
    # The shared stratum has no texts here, so no rule is on.
    assert all(v is None for v in limits[None][1:])


def test_few_labels_prove_nothing(odd, labels, spark):
    limits = quality.cutoffs(quality.narrow_counts(odd, "lang"), labels).collect()
    assert all(v is None for r in limits for v in r[1:])
    none = spark.createDataFrame([], labels.schema)
    assert quality.judge_quality(odd, none).count() == odd.count()


def test_keep_good_keeps_columns(odd, clashing, labels, nothing):
    kept = quality.keep_good(clashing, labels)
    assert kept.columns == clashing.columns
    want = sorted(
        (r["doc_id"] or 0, r["text"]) for r in odd.collect() if not counts(r["text"])[-1]
    )
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == want
    assert quality.keep_good(nothing, labels).count() == 0


def test_no_python_in_the_plan(odd, labels):
    plan = quality.judge_quality(odd, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
