"""Spelling variants against all pairs of a small vocabulary."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidecast.llm import spelling
from tidecast.llm.spelling import Settings

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_words(rows, s: Settings) -> dict[str, int]:
    found = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = run.translate(LOWER)
            key = "" if r["doc_id"] is None else r["doc_id"]
            h = zlib.crc32(f"{key}:{run}".encode())
            if h % s.slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= s.min_length:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= s.min_count}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_forms(words: dict[str, int], s: Settings):
    near = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= s.form_ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {
        (w, form[w], root(w), n, len(near[w]), None if form[w] is None else words[form[w]])
        for w, n in words.items()
    }


def variants(seed: int) -> list[tuple]:
    """Texts with misspelt words of very different frequency, chains of forms, and ties."""
    rng, letters, rows = random.Random(seed), "abcdeéÿß", []

    def edited(w: str) -> str:
        i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
        new = "" if kind == 0 else rng.choice(letters)
        return w[:i] + new + w[i + (kind < 2) :]

    for n in range(12):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(4, 9)))
        near = edited(w)
        chain = [w, near, edited(near), edited(w)]
        for word, copies in zip(chain, (1000, 40, 3, 3)):
            rows.append((n, " ".join([word.upper() if rng.random() < 0.1 else word] * copies)))
    long = "".join(rng.choice(letters) for _ in range(90))
    for i, word in enumerate((long, long[:40] + long[41:], long + "a", "a" * 100, "a" * 101, long[:70] + "x" + long[71:])):
        rows.append((100 + i, f"{word} " * (30 if i == 0 else 2)))
    return rows + [(None, "rabarbar rabarbar rabarber"), (None, None), (7, ""), (8, "rabarbar" * 2_000)]


CASES = [
    Settings(min_length=3),
    # Spills, many tasks, small batches, and a bitmap that is nearly full.
    Settings(min_length=3, symbols=3, slip=7, held_words=2, task_words=5, batch_keys=50, inline=5, bitmap_bits=6),
    Settings(min_length=3, min_count=1, symbols=20, form_ratio=2, slip=2, inline=95),
]


@pytest.mark.parametrize("settings", CASES)
@pytest.mark.parametrize("seed", [1, 2])
def test_forms_equal_all_pairs(spark, settings, seed):
    docs = spark.createDataFrame(variants(seed), "doc_id long, text string").repartition(5)
    words = slow_words(docs.collect(), settings)
    want = slow_forms(words, settings)
    got = spelling.spelling_forms(docs, settings).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(f is not None and f != r for _, f, r, *_ in want) or settings.min_count == 1


def test_odd_rows(odd, clashing, nothing):
    settings = Settings(min_length=6)
    want = slow_forms(slow_words(odd.collect(), settings), settings)
    for docs in (odd, clashing):
        assert {tuple(r) for r in spelling.spelling_forms(docs, settings).collect()} == want
    assert spelling.spelling_forms(nothing, settings).count() == 0


def test_neighbourhoods_are_whole_and_without_repeats():
    s = Settings(symbols=3)
    symbols = spelling._symbols(s)
    rng = np.random.default_rng(3)
    for length in (1, 2, 5, 9):
        letters = rng.choice(np.frombuffer(b"abcdefgh", np.uint8), (20, length))
        got = [Counter() for _ in letters]
        for rows, keys in spelling.neighbourhoods(letters, s):
            for r, k in zip(rows, keys):
                got[r][int(k)] += 1
        for word, found in zip(letters, got):
            reduced = [int(x) for x in symbols[word]]
            every = {tuple(reduced)}
            for i in range(length + 1):
                for a in (1, 2, 3):
                    every.add(tuple(reduced[:i] + [a] + reduced[i:]))
                    if i < length:
                        every.add(tuple(reduced[:i] + [a] + reduced[i + 1 :]))
                if i < length:
                    every.add(tuple(reduced[:i] + reduced[i + 1 :]))
            want = Counter(sum(x * 4**p for p, x in enumerate(reversed(w))) for w in every)
            assert found == want


def test_letters_of_two_bytes_count_as_one(spark):
    words = spark.createDataFrame([("éàüößéà",), ("éàüößéá",)], "word string")
    from pyspark.sql import functions as F

    assert words.select(F.levenshtein("word", F.lit("éàüößéà"), 1)).collect() == [(0,), (1,)]
