from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidecast.llm import lines, shards
from tidecast.llm.common import ranked


def slow_lines(rows, ratio, min_pages):
    pages, held = Counter(), Counter()
    visible = lambda s: bool(s.strip(" \t\n\x0b\x0c\r"))
    for r in rows:
        pages[r["source"]] += 1
        for line in set((r["text"] or "").split("\n")):
            if visible(line):
                held[r["source"], line] += 1
    bad = {(s, x) for (s, x), k in held.items() if pages[s] >= min_pages and k > ratio * pages[s]}
    out = []
    for r in rows:
        if r["text"] is None:
            out.append((r["doc_id"], None, 0, 0))
            continue
        cut = r["text"].split("\n")
        kept = [x for x in cut if (r["source"], x) not in bad]
        out.append((r["doc_id"], "\n".join(kept), len(cut), len(cut) - len(kept)))
    return out


def order(row):
    return tuple((v is not None, v) for v in row)


def test_lines_against_plain_counting(odd, clashing):
    settings = lines.Settings(ratio=0.3, min_pages=10)
    want = sorted(slow_lines(odd.collect(), 0.3, 10), key=order)
    assert any(w[3] for w in want)
    for docs in (odd, clashing):
        got = lines.drop_site_lines(docs, settings=settings)
        picked = got.select("doc_id", "text", "lines_seen", "lines_dropped").collect()
        assert sorted(map(tuple, picked), key=order) == want


def test_clean_documents_keep_their_columns(odd, clashing, nothing):
    settings = lines.Settings(ratio=0.3, min_pages=10)
    out = lines.clean_documents(clashing, settings)
    assert out.columns == clashing.columns
    assert out.count() == clashing.count()
    cut = out.where("doc_id >= 20").select("text", "n_chars").collect()
    assert all("shared last line" not in r["text"] and r["n_chars"] == len(r["text"]) for r in cut)
    assert lines.clean_documents(nothing).count() == 0


def test_small_sites_are_left_alone(odd):
    got = lines.drop_site_lines(odd, settings=lines.Settings(ratio=0.0, min_pages=1000))
    assert got.where("lines_dropped > 0").count() == 0


def test_shards_hold_near_equal_bytes(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = shards.shard_documents(docs, 7).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        data_ = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data_) + 16, zlib.crc32(data_))
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert sorted(slots) == list(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 3 * max(r["size"] for r in rows)


def test_shards_of_equal_rows_and_one_source(spark):
    """All metadata equal: only the hash of the id orders them, and the cut still halves."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"),
                                    F.lit("en").alias("lang"), F.lit("s").alias("source"))
    counts = [r["count"] for r in shards.shard_documents(docs, 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 8


def test_odd_rows_are_all_placed(odd, clashing, nothing):
    for docs in (odd, clashing):
        rows = shards.shard_documents(docs, 5).collect()
        assert len(rows) == odd.count()
        by = defaultdict(list)
        for r in rows:
            by[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shards.shard_documents(nothing, 5).count() == 0
    assert shards.shard_count(0, 10) == 1 and shards.shard_count(21, 10) == 3


def test_ranks_cross_buckets_without_gaps(spark):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.lit("a")).alias("g"))
    out = ranked(rows, ["g"], "id", "at", chunk=37).collect()
    by = defaultdict(list)
    for r in out:
        by[r["g"]].append(r["at"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(out) == 1000
