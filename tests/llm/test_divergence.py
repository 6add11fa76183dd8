"""Divergences against a slow form in Python's whole numbers."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidecast.llm import divergence
from tidecast.llm.divergence import Settings

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, s: Settings):
    docs = [tuple(r[c] or "" for c in ("text", "lang", "source")) for r in rows]
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        terms = TERM.findall(text.translate(LOWER))
        groups[lang].add(source)
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= s.min_docs]
        v = len(kept)

        def share(of):
            n = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + s.prior) // (n + s.prior * v) for t in kept}

        p = {source: share(counts[lang, source]) for source in sources}
        q = share(sum((counts[lang, x] for x in sources), Counter()))
        for source in sources:
            pairs = [(-sum(abs(p[source][t] - p[o][t]) for t in kept), o) for o in sources - {source}]
            terms = [(q[t] - p[source][t], t) for t in kept if counts[lang, source][t] and p[source][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[: s.top_terms])):
                out |= {(lang, source, part, x, -n, i + 1) for i, (n, x) in enumerate(found)}
    return out


CASES = [
    Settings(min_docs=2),
    # Everything is cut: spills after each document, a bucket a few cells, a tile two sources.
    Settings(min_docs=2, top_terms=3, held_cells=5, bucket_cells=7, tile=2),
    Settings(min_docs=10_000),
]


@pytest.mark.parametrize("settings", CASES)
def test_equals_the_slow_form(odd, clashing, settings):
    want = slow(odd.collect(), settings)
    for docs in (odd, clashing):
        found = divergence.source_divergences(docs, settings).collect()
        assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_no_rows_and_no_terms(spark, nothing):
    assert divergence.source_divergences(nothing).count() == 0
    rows = spark.createDataFrame(
        [(None, "x", "a"), ("1 2 3", "x", "b"), ("", None, None)], "text string, lang string, source string"
    )
    found = {tuple(r) for r in divergence.source_divergences(rows).collect()}
    assert found == {("x", "a", "pair", "b", 0, 1), ("x", "b", "pair", "a", 0, 1)}


def test_shares_are_exact_for_large_counts():
    counts, total = np.array([0, 1, 7 * 10**14, 3]), np.array([9 * 10**14])
    got = divergence.shares(counts, total, 17, 5)
    assert got.tolist() == [1 + 10**9 * (int(c) + 5) // (9 * 10**14 + 85) for c in counts]


def test_tasks_spill(spark, odd):
    small = divergence.stripes(odd.coalesce(1), Settings(held_cells=50))
    whole = divergence.stripes(odd.coalesce(1))
    assert small.count() > whole.count()
    for name in ("docs", "counts"):
        of = (lambda r: r[name]) if name == "docs" else (lambda r: sum(r[name]))
        totals = [Counter() for _ in range(2)]
        for total, rows in zip(totals, (small, whole)):
            for r in rows.collect():
                total[r["lang"], bytes(r["term"])] += of(r)
        assert totals[0] == totals[1]


def test_long_text_is_counted_in_pieces():
    text = ("Äb " * 600_000 + "x" * 2_000_000).encode()
    assert divergence.terms_of(text) == {"Äb".encode(): 600_000, b"x" * 2_000_000: 1}
    assert pa.array([text], pa.binary())[0].as_py() == text
