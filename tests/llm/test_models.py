"""Language ID, n-gram scores and benchmark passages against plain Python."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidecast.llm import decontaminate, eliasfano, fmindex, langid, lm

from .conftest import prose


def test_language_of_held_out_texts(spark, data):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.train(langid.sample(docs.where(~langid.held_out()).select("text", "lang")))
    rows = langid.predict(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_tables_give_what_the_filters_give():
    net = langid.train([("der und die ä", "de"), ("the and of", "en")], langid.Settings(epochs=1))
    rows = langid.windows_of("The straße of the und é. ".encode() * 30, 256)
    slow = np.concatenate(net.convolved(rows)[0], axis=1)
    assert np.allclose(slow, net.pooled(rows), atol=1e-4)


def test_language_of_odd_rows(odd, clashing, nothing):
    net = langid.train(langid.sample(odd))
    assert net.languages == ["de", "en", "es", "fr"]
    rows = {r["doc_id"]: r for r in langid.predict(clashing, net).collect()}
    assert {rows[i]["lang_pred"] for i in (1, 2, 3, 12)} == {"und"}
    assert rows[7]["lang_pred"] in net.languages and 0 <= rows[7]["score"] <= 1
    assert langid.predict(odd, net).count() == odd.count()
    assert langid.predict(nothing, net).count() == 0
    empty = langid.train(langid.sample(nothing))
    assert {r["lang_pred"] for r in langid.predict(odd, empty).collect()} == {"und"}


def test_the_sample_is_bounded_and_repeats(spark):
    docs = spark.range(3000).select(
        F.concat(F.lit("text "), F.col("id")).alias("text"), F.when(F.col("id") % 5 > 0, "a").otherwise("b").alias("lang")
    )
    settings = langid.Settings(per_language=40)
    got = langid.sample(docs, settings)
    assert Counter(x for _, x in got) == {"a": 40, "b": 40}
    assert sorted(got) == sorted(langid.sample(docs.repartition(7), settings))


def _syllables(lang: int, seed: int, words: int = 60) -> str:
    rng, own = random.Random(1000 * lang + seed), random.Random(lang)
    stock = ["".join(own.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(4)]
    return " ".join("".join(rng.choices(stock, k=rng.randint(1, 2))) for _ in range(words))


def test_every_language_is_learned(spark):
    """Eighty languages, one of which has almost all rows, one only three."""
    rows = [(_syllables(lang, i), f"l{lang:02d}") for lang in range(80) for i in range(3 if lang == 7 else 25)]
    rows += [(_syllables(0, i), "l00") for i in range(25, 2500)]
    settings = langid.Settings(per_language=25, epochs=20)
    taken = langid.sample(spark.createDataFrame(rows, "text string, lang string"), settings)
    assert Counter(x for _, x in taken) == {f"l{lang:02d}": 3 if lang == 7 else 25 for lang in range(80)}
    net = langid.train(taken, settings)
    docs = spark.createDataFrame([(lang, _syllables(lang, 9999)) for lang in range(80)], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, net, settings).collect()}
    assert sum(found[lang] == f"l{lang:02d}" for lang in range(80)) >= 76


def test_the_sample_is_shared_out_and_never_leaves_a_language_out(spark):
    docs = spark.range(4000).select(F.col("id").cast("string").alias("text"), (F.col("id") % 50).cast("string").alias("lang"))
    got = langid.sample(docs, langid.Settings(sample_texts=120))
    assert Counter(Counter(x for _, x in got).values()) == {2: 50}
    with pytest.raises(ValueError, match="50 languages"):
        langid.sample(docs, langid.Settings(sample_texts=49))


def test_excerpts_come_from_the_whole_text(spark):
    text = "".join(f"{i:06d}" for i in range(20_000))
    docs = spark.createDataFrame([(text[j:], "x") for j in range(20)] + [("short", "x")], "text string, lang string")
    places = []
    for excerpt, _ in langid.sample(docs):
        if excerpt == "short":
            continue
        parts = excerpt.split("\n")
        assert [len(p) for p in parts] == [512] * 4 and all(p in text for p in parts)
        places += [text.index(p) for p in parts]
    assert len(places) == 80 and min(places) < 30_000 and max(places) > 90_000


def test_sequences_and_tries():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n, top = int(rng.integers(0, 200)), int(rng.choice([5, 300, 70_000, 2**40, 2**63]))
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        e, _ = eliasfano.EliasFano.read(eliasfano.EliasFano.of(values, top).tobytes())
        asked = np.concatenate([rng.integers(0, top, 50, dtype=np.uint64), values])
        assert (e.all() == values).all()
        assert (e.get(np.arange(n)) == values).all()
        assert (e.successor(asked) == np.searchsorted(values, asked)).all()
    for _ in range(40):
        order, words = int(rng.integers(1, 4)), int(rng.choice([4, 50, 3000]))
        grams = np.unique(rng.integers(0, words, (80, order)), axis=0)
        codes = rng.integers(0, 60_000, len(grams)).astype(np.uint16)
        trie = eliasfano.Trie.read(eliasfano.Trie.of(grams, codes, words).tobytes())
        asked = np.concatenate([grams, rng.integers(0, words, (50, order))])
        known = dict(zip(map(tuple, grams.tolist()), codes.tolist()))
        assert trie.find(asked).tolist() == [known.get(tuple(x), eliasfano.MISSING) for x in asked.tolist()]


def test_mapped_trie(tmp_path):
    grams = np.array([[1, 2], [1, 5], [3, 1]])
    trie = eliasfano.Trie.of(grams, np.array([5, 6, 7], np.uint16), 10)
    (tmp_path / "trie").write_bytes(trie.tobytes())
    found = eliasfano.Trie.mapped(str(tmp_path / "trie"))
    assert found.find(np.array([[1, 5], [1, 3], [9, 9]])).tolist() == [6, eliasfano.MISSING, eliasfano.MISSING]


def slow_scores(rows, prior):
    texts = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [b""]) for r in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c, b = Counter(), Counter()
    for i, words in texts:
        if not held(i):
            c.update(words)
            b.update(zip([None, *words[:-1]], words))
    n, v = sum(c.values()), len(c)
    p1 = lambda w: (c[w] + 1) / (n + v + 1)
    total = lambda h: c[b""] if h is None else c[h]
    out = []
    for i, words in texts:
        base = sum(math.log10(p1(w)) for w in words)
        score = sum(
            math.log10((b[h, w] + prior * p1(w)) / (total(h) + prior)) for h, w in zip([None, *words[:-1]], words)
        )
        out.append((i, held(i), len(words), sum(c[w] > 0 for w in words), n, base, score))
    return out


def test_scores_against_plain_counts(odd, clashing, nothing):
    settings = lm.Settings(block_tokens=500, shard_words=100, shard_bigrams=400)
    want = sorted(slow_scores(odd.collect(), settings.prior), key=lambda r: (r[0] or -1, r[2]))
    for docs, own in ((odd, settings), (clashing, lm.Settings())):
        got = sorted(map(tuple, lm.score_texts(docs, own).collect()), key=lambda r: (r[0] or -1, r[2]))
        assert [g[:5] for g in got] == [w[:5] for w in want]
        for g, w in zip(got, want):
            assert math.isclose(g[5], w[5], rel_tol=1e-9)
            assert abs(g[6] - w[6]) <= 3e-4 * w[2]
    assert lm.score_texts(nothing).count() == 0


def test_probabilities_sum_to_one():
    """Over all words and the one unknown, for a seen context."""
    c = Counter("a b a c a b end".split())
    n, v, prior = sum(c.values()), len(c), 100.0
    p1 = lambda w: (c[w] + 1) / (n + v + 1)
    after_a = Counter({"b": 2, "c": 1})
    total = sum((after_a[w] + prior * p1(w)) / (3 + prior) for w in [*c, "unknown"])
    assert math.isclose(total, 1.0)


def test_index_finds_all_places():
    rng = np.random.default_rng(1)
    for _ in range(150):
        text = rng.integers(0, int(rng.choice([2, 3, 6])), int(rng.integers(0, 60)))
        text = np.append(text, 0)
        index = fmindex.Index(text, sample=int(rng.choice([1, 3, 16])))
        lengths = rng.integers(1, 5, 15)
        phrases = np.zeros((15, 4), np.int64)
        for i, k in enumerate(lengths):
            phrases[i, :k] = rng.integers(1, 7, k)
        low, high = index.search(phrases, lengths)
        for i, k in enumerate(lengths):
            want = [p for p in range(len(text) - k + 1) if (text[p : p + k] == phrases[i, :k]).all()]
            assert sorted(index.locate(np.arange(low[i], high[i])).tolist()) == want


WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def slow_words(text):
    return WORDS.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))


def slow_hits(rows, items, window=10):
    phrases = {}
    for item, text in items:
        words = slow_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            phrases.setdefault(tuple(words[i : i + window]), set()).add("null" if item is None else str(item))
    out = []
    for r in rows:
        words, found = slow_words(r["text"]), set()
        hit = [False] * len(words)
        for k in {len(p) for p in phrases}:
            for i in range(len(words) - k + 1):
                names = phrases.get(tuple(words[i : i + k]))
                if names:
                    found |= names
                    hit[i : i + k] = [True] * k
        out.append((r["doc_id"], len(words), sum(hit), sorted(found)))
    return out


@pytest.fixture(scope="module")
def benchmark(spark):
    inside = prose(1, 120).split()
    items = [(1, " ".join(inside[20:45])), (2, " ".join(inside[40:52]).upper()), (3, "one"), (3, "12345"), (4, None),
             (5, ""), (None, "line line line"), (6, "never anywhere seen words"), (7, " ".join(inside[20:45])), (10, "ÄÖ İ")]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("shard_words", [50, 1 << 21])
def test_passages_against_plain_search(odd, clashing, nothing, benchmark, shard_words):
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    settings = decontaminate.Settings(shard_words=shard_words)
    order = lambda r: (r[0] or -1, r[1], r[2])
    want = sorted(slow_hits(odd.collect(), items), key=order)
    assert sum(w[2] > 0 for w in want) > 5
    got = decontaminate.find_passages(clashing, benchmark, settings).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=order) == want
    for r in got:
        assert r["n_hit"] == sum(s["end"] - s["start"] for s in r["spans"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_removed_passages(odd, clashing, nothing, benchmark, spark):
    out = decontaminate.remove_passages(clashing, benchmark)
    assert out.columns == clashing.columns
    before = {r["doc_id"]: (r["text"], h) for r, h in zip(odd.collect(), slow_hits(odd.collect(), [(r["item_id"], r["text"]) for r in benchmark.collect()]))}
    for r in out.collect():
        text, hits = before[r["doc_id"]]
        if r["doc_id"] is None:
            continue
        if hits[2]:
            assert len(slow_words(r["text"])) == hits[1] - hits[2]
            assert r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == text
    none = spark.createDataFrame([], benchmark.schema)
    assert decontaminate.find_passages(odd, none).where("n_hit > 0").count() == 0
    assert decontaminate.remove_passages(nothing, benchmark).count() == 0
    with pytest.raises(ValueError):
        decontaminate.find_passages(odd, benchmark, decontaminate.Settings(max_benchmark_bytes=3))
