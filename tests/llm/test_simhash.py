from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidecast.llm import golay, simhash
from tidecast.llm.components import components
from tidecast.llm.simhash import Settings


def slow_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    items = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    found = [xxhash.xxh64_intdigest(x, 42) for x in items]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def groups(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and linked(i, j):
                a, b = find(i), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_golay_code_is_perfect():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    found = golay.nearest(words)
    assert len(np.unique(golay.nearest(np.arange(1 << 14)))) > 1
    # A codeword comes back from up to three flipped bits.
    code = words ^ golay.ERRORS[golay.REMAINDERS[words >> 11] ^ (words & 0x7FF)]
    for weight in range(4):
        for row, index in zip(code[:200], found[:200]):
            bits = random.Random(int(row)).sample(range(23), weight)
            assert golay.nearest(np.array([row ^ sum(1 << b for b in bits)]))[0] == index


def test_words_two_bits_apart_share_a_key():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 3000)
    own = golay.keys(words)
    assert set((own >= 0).sum(axis=1)) <= {1, 6}
    for bits in range(3):
        other = words.copy()
        for _ in range(bits):
            other ^= 1 << rng.integers(0, 23, len(words))
        theirs = golay.keys(other)
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(own, theirs))


def test_keys_meet_their_distance():
    rng = np.random.default_rng(3)
    fp = rng.integers(-(1 << 63), 1 << 63, 1000)
    for bits in range(3):
        other = fp.copy()
        for i in range(len(fp)):
            for b in rng.choice(64, bits, replace=False).tolist():
                other[i] ^= np.int64(1 << b if b < 63 else -(1 << 63))
        own = [set() for _ in fp]
        theirs = [set() for _ in fp]
        for sets, values in ((own, fp), (theirs, other)):
            for rows, found in simhash.close_keys(values):
                for row, key in zip(rows.tolist(), found.tolist()):
                    sets[row].add(key)
        assert all(a & b for a, b in zip(own, theirs)), bits


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (7, 8)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len({roots[i] for i in range(61)}) == 1
    assert len({roots[i] for i in range(100, 140)}) == 1
    assert roots[0] != roots[100]
    assert len(roots) == len(found) == 101
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_odd_rows(odd):
    rows = odd.collect()
    fp = {}
    for r in rows:
        fp.setdefault(r["doc_id"], slow_fingerprint(r["text"]))
    ids = [i for i in fp if i is not None]
    want = groups(ids, lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 2)
    got = simhash.simhash_groups(odd).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert r["fp"] & (1 << 64) - 1 == fp[r["doc_id"]]
            assert r["component_id"] == want[r["doc_id"]]


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Many fingerprints in one bucket go by midpoints; groups equal brute force."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    marks = {i: base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for i in range(120)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = spark.createDataFrame([(i, signed(f)) for i, f in marks.items()], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, k: docs)
    got = {r["doc_id"]: r["component_id"] for r in simhash.simhash_groups(rows).collect()}
    assert got == groups(list(marks), lambda i, j: (marks[i] ^ marks[j]).bit_count() <= 2)


def slow_keepers(rows):
    sets = {}
    for r in rows:
        words = (r["text"] or "").encode().lower().split()
        sets.setdefault(r["doc_id"], set(zip(*(words[i:] for i in range(5)))) or {tuple(words)})
    ids = [i for i in sets if i is not None]
    same = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    return groups(ids, lambda i, j: same(sets[i], sets[j]))


def test_near_copies(odd, clashing):
    want = slow_keepers(odd.collect())
    got = {r["doc_id"]: r["keeper"] for r in simhash.near_copy_groups(odd).collect()}
    assert got == want
    assert got[5] == got[6] == 4
    left = simhash.drop_near_copies(clashing)
    assert left.columns == clashing.columns
    stays = sorted(r["doc_id"] or -1 for r in left.collect())
    assert stays == sorted(r["doc_id"] or -1 for r in odd.collect() if r["doc_id"] is None or want[r["doc_id"]] == r["doc_id"])


def test_near_copies_of_the_test_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r["doc_id"]: r["keeper"] for r in simhash.near_copy_groups(docs).collect()}
    assert got == slow_keepers(docs.collect())


def test_empty_table(nothing):
    assert simhash.simhash_groups(nothing).count() == 0
    assert simhash.drop_near_copies(nothing, Settings()).count() == 0


def test_near_copies_around_the_limit_are_found(spark):
    """Copies with scattered edits, similarity from 0.8 up: nearly all are linked, none below."""
    from .conftest import prose

    rng = random.Random(8)
    rows, alike = [], {}
    for i in range(300):
        words = prose(1000 + i, 400, start="v").split()
        other = list(words)
        for at in rng.sample(range(400), rng.randint(1, 14)):
            other[at] = f"edit{i}x{at}"
        a, b = (set(zip(*(w[j:] for j in range(5)))) for w in (words, other))
        alike[2 * i + 1] = len(a & b) / len(a | b) >= 0.8
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["keeper"] for r in simhash.near_copy_groups(docs).collect()}
    found = {i: got[i] == i - 1 for i in alike}
    assert not any(found[i] and not alike[i] for i in alike)
    assert sum(found[i] for i in alike if alike[i]) >= 0.97 * sum(alike.values())


def star(seed, variants, words=300, inserts=6):
    """Texts of edited copies and, last, of their original."""
    from .conftest import prose

    rng = random.Random(seed)
    original = prose(seed, words, start="o").split()
    texts = []
    for i in range(variants):
        copy = list(original)
        for j, at in enumerate(sorted(rng.sample(range(words), inserts), reverse=True)):
            copy.insert(at, f"new{i}x{j}")
        texts.append(" ".join(copy))
    return [*texts, " ".join(original)]


def test_stars_of_copies_around_a_late_original_are_whole(spark):
    """Copies are like the original, not like each other; it has the highest id."""
    rows = [(i, t) for i, t in enumerate(star(3, 50) + star(4, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = slow_keepers(docs.collect())
    got = {r["doc_id"]: r["keeper"] for r in simhash.near_copy_groups(docs).collect()}
    assert got == want


def test_crowded_buckets_compare_all_that_no_link_joins(spark):
    """Chains in one bucket: pairs of different components meet once, linked ones never."""
    ids = list(range(300))
    crowded = spark.createDataFrame([(7, i, 300) for i in ids], "key long, id long, n long")
    roots = {i: i % 3 for i in ids if i < 200}
    known = spark.createDataFrame(list(roots.items()), "node long, root long")
    every = lambda x, y: F.lit(True)
    got = [(r["a"], r["b"]) for r in simhash.unlinked_pairs(crowded, known, (), every).collect()]
    root = lambda i: roots.get(i, i)
    assert len(got) == len(set(got))
    assert set(got) == {(i, j) for i in ids for j in ids if i < j and root(i) != root(j)}
    assert len(simhash.led(crowded, (), every).collect()) == 299


def test_ids_that_share_many_crowded_keys_meet_once(spark):
    """In the first key they share; an id with keys of several sets meets in every one."""
    ids, keys = range(20), range(30)
    of = {i: [k for k in keys if (i * 7 + k) % 5 or k > 25] for i in ids}
    rows = [(k, i, 20, p) for i in ids for p, k in enumerate(of[i])]
    crowded = spark.createDataFrame(rows, "key long, id long, n long, pos long")
    none = spark.createDataFrame([], "node long, root long")
    every = lambda x, y: F.lit(True)
    met = simhash.unlinked_meetings(crowded, none, ("pos",), every).select("x.id", "y.id")
    pairs = sorted(tuple(sorted(r)) for r in met.collect())
    assert pairs == [(i, j) for i in ids for j in ids if i < j]
    twice = spark.createDataFrame([(3,)], "id long")
    met = simhash.unlinked_meetings(crowded, none, ("pos",), every, twice).select("x.id", "y.id")
    assert sum(3 in tuple(r) for r in met.collect()) == sum(len(set(of[3]) & set(of[j])) for j in ids if j != 3)


def test_common_shingles_go_by_a_share_of_the_table(spark, monkeypatch):
    """A passage of one text in forty is common in a table far larger than the least sample."""
    monkeypatch.setattr(simhash, "SAMPLED", 64)
    line = "a line that many of them hold"
    texts = [(i, f"{i}a {i}b {i}c {i}d {i}e " + (line if i % 40 == 0 else f"{i}f")) for i in range(8000)]
    found = simhash.common_shingles(spark.createDataFrame(texts, "doc_id long, text string"), 8000, 5)
    assert set(simhash.shingle_set(line, 5)) <= set(found)


def test_near_copies_with_edits_in_one_block_are_all_found(spark):
    """Appended, cut off and replaced passages around the limit: groups equal brute force."""
    from .conftest import prose

    rows = []
    for i in range(40):
        words = prose(3000 + i, 400, start=f"s{i % 7}").split()
        added = prose(4000 + i, 99, start="t").split()
        edited = (
            words + added[: (40, 60, 80, 97)[i // 3 % 4]],
            words[: 400 - (40, 60, 78, 85)[i // 3 % 4]],
            words[:150] + added[: 20 + i // 2] + words[170 + i // 2 :],
        )[i % 3]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = slow_keepers(docs.collect())
    assert sum(want[i] == i - 1 for i in range(1, 80, 2)) >= 30
    assert {r["doc_id"]: r["keeper"] for r in simhash.near_copy_groups(docs).collect()} == want


def test_sets_of_the_similarity_share_a_first_shingle():
    """At any order of common shingles, down to exactly 0.8."""
    rng = np.random.default_rng(9)
    for turn in range(400):
        n = int(rng.integers(1, 60))
        union = rng.choice(1 << 20, n, replace=False).astype(np.uint64)
        both = -(-8 * n // 10)
        mine = both + int(rng.integers(0, n - both + 1))
        x = np.sort(union[:mine])
        y = np.sort(np.concatenate([union[:both], union[mine:]]))
        common = simhash.placed(rng.permutation(union)[: int(rng.integers(0, n + 1))])
        assert np.intersect1d(*(simhash.first_shingles(z, common, 0.8) for z in (x, y))).size


def test_the_pipeline_drops_by_fingerprints(spark):
    """Texts of one fingerprint whose shingle sets have little in common; ids that repeat."""
    import corpus_pipeline

    def text(seed):
        return "red green blue " * 300 + " ".join(f"w{seed}x{i}" for i in range(40))

    marks = {seed: simhash.shingle_fingerprint(text(seed), 3) for seed in range(3)}
    assert all((marks[a] ^ marks[b]).bit_count() <= 2 for a in marks for b in marks)
    docs = [(10, text(0)), (11, text(1)), (12, "one other text of its own"), (12, text(2))]
    docs += [(None, text(0)), (13, "again " + text(0).upper())]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    few = df.where("doc_id IN (10, 11)")
    assert simhash.drop_near_copies(few).count() == 2
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert [r["doc_id"] for r in stage(spark, few, "").collect()] == [10]
    # Of the rows of a repeated id the least fingerprint stands for the document.
    own = simhash.shingle_fingerprint(docs[2][1], 3)
    want = [None, 10] + ([12, 12] if own < marks[2] else [])
    left = [r["doc_id"] for r in simhash.drop_simhash_copies(df).collect()]
    assert sorted(left, key=lambda x: x or 0) == want
