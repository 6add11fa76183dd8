"""The pipeline against the stages done one text at a time, and on odd rows."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import tiktoken

import corpus_pipeline
from tidecast.llm import bpe, decontaminate, lines, quality

from .test_lines_and_shards import slow_lines
from .test_models import slow_hits, slow_words
from .test_simhash import slow_keepers


def slow_run(folder):
    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality._sql()}) WHERE kept").fetchall()}
    names = ("doc_id", "text", "source")
    docs = [dict(zip(names, r)) for r in con.execute("SELECT doc_id, text, source FROM documents").fetchall()]
    docs = [d for d in docs if d["doc_id"] in kept]
    cleaned = slow_lines(docs, lines.SETTINGS.ratio, lines.SETTINGS.min_pages)
    docs = [{"doc_id": i, "text": text} for i, text, _, _ in cleaned]
    keepers = slow_keepers(docs)
    docs = [d for d in docs if keepers[d["doc_id"]] == d["doc_id"]]
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    out = {}
    path, pattern = bpe.public_vocabulary()
    coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    for d, (_, n, hit, _) in zip(docs, slow_hits(docs, items)):
        out[d["doc_id"]] = (n - hit, None if hit else coder.encode_ordinary(d["text"] or ""))
    return out


def test_whole_run(spark, data):
    want = slow_run(data)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, data).collect()}
    assert set(got) == set(want)
    coder = bpe.codec(*((lambda p: (bpe.description_of(p[0]), p[1]))(bpe.public_vocabulary())))
    cut = 0
    for i, (n_words, ids) in want.items():
        own = np.frombuffer(got[i]["packed_ids"], "<u4").tolist()
        assert got[i]["n_tokens"] == len(own)
        text = coder.decode(own)
        assert hashlib.sha256(text).hexdigest() == got[i]["decoded_sha256"]
        assert len(slow_words(text.decode())) == n_words
        if ids is None:
            cut += 1
        else:
            assert own == ids
    assert cut


def test_stages_on_odd_rows(spark, clashing, nothing, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items = spark.createDataFrame([(1, "one"), (None, None)], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (clashing, nothing):
        before = docs
        for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, before, str(tmp_path))
            path = str(tmp_path / f"{name}-{len(docs.columns)}")
            out.write.parquet(path)
            after = spark.read.parquet(path)
            if at < len(corpus_pipeline.STAGES) - 1:
                assert after.columns == docs.columns, name
            assert after.count() <= before.count()
            if at > 2 or name == "line_dedup":
                assert after.count() == before.count(), name
            before = after


def test_stage_names_follow_the_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]
    assert decontaminate.Settings().window == 10
