from __future__ import annotations

import random

import numpy as np

from tidecast.llm import bpe, preferences, tokens
from tidecast.llm.preferences import Template


def test_counts_of_odd_texts(odd, clashing):
    path, pattern = bpe.public_vocabulary()
    coder = bpe.codec(bpe.description_of(path), pattern)
    want = sorted((r["doc_id"] or -1, len(coder.encode(r["text"]))) for r in odd.collect())
    for docs in (odd, clashing):
        blocks = tokens.flat_blocks(docs, path, pattern, block=100).cache()
        spans = tokens.document_spans(tokens.separators(blocks)).collect()
        assert all(s["closed"] for s in spans)
        names = {(r["file"], r["block"], i): d for r in blocks.collect() for i, d in enumerate(r["ids"])}
        got = [(names[s["file"], s["block"], s["nth"]] or -1, s["n_tokens"]) for s in spans]
        assert sorted(got) == want


def test_empty_table(nothing):
    path, pattern = bpe.public_vocabulary()
    blocks = tokens.flat_blocks(nothing, path, pattern)
    assert tokens.document_spans(tokens.separators(blocks)).count() == 0


def test_flat_files_in_blocks(spark, tmp_path):
    """Documents that span blocks, empty ones, separators on block borders, open ends."""
    rng = random.Random(4)
    want = []
    for f in range(6):
        flat, document = [], 0
        for _ in range(rng.randint(0, 30)):
            n = rng.choice([0, 0, 1, 7, 8, 9, 40])
            want.append((f"f{f}.bin", document, len(flat), n, True))
            flat += [rng.randrange(1000) for _ in range(n)] + [tokens.END_OF_DOCUMENT]
            document += 1
        if f % 2:
            want.append((f"f{f}.bin", document, len(flat), 3, False))
            flat += [1, 2, 3]
        (tmp_path / f"f{f}.bin").write_bytes(np.array(flat, "<u2").tobytes())
    blocks = tokens.file_blocks(spark, str(tmp_path), block=8)
    got = tokens.document_spans(tokens.separators(blocks)).collect()
    rows = [(r["file"].rsplit("/", 1)[1], r["document"], r["start"], r["n_tokens"], r["closed"]) for r in got]
    assert sorted(rows) == sorted(want)


TURN = "pair long, turn long, role string, text string"


def pairs(spark, chosen, rejected):
    out = preferences.preference_pairs(
        spark.createDataFrame(chosen, TURN), spark.createDataFrame(rejected, TURN), Template("<", ">", "/", "a")
    )
    return {r["pair"]: tuple(r)[1:] for r in out.collect()}


def test_prompt_is_the_longest_common_prefix(spark):
    chosen = [(1, 0, "u", "hi"), (1, 1, "a", "yes"), (1, 2, "u", "ok"), (1, 3, "a", "x"),
              (2, 0, "u", "q"), (3, 0, "u", "same"), (3, 1, "a", None), (5, 9, None, ""), (None, 0, "u", "n")]
    rejected = [(1, 0, "u", "hi"), (1, 1, "a", "no"), (1, 2, "u", "ok"),
                (3, 0, "u", "same"), (3, 1, "a", None), (4, 0, "a", "alone"), (5, 1, None, None)]
    got = pairs(spark, chosen, rejected)
    assert got[1] == (1, "<u>hi/", "<a>yes/<u>ok/<a>x/", "<a>no/<u>ok/", "3-7,16-18", "3-6")
    # Once different, later equal turns are not prompt.
    assert got[2] == (0, "", "<u>q/", "", "", "")
    assert got[3] == (2, "<u>same/<a>/", "", "", "", "")
    assert got[4] == (0, "", "", "<a>alone/", "", "3-9")
    assert got[5] == (0, "", "<>/", "<>/", "", "")
    assert got[None][2] == "<u>n/"


def test_spans_cut_out_the_answers(spark):
    rng = random.Random(2)
    chosen, rejected = [], []
    for p in range(40):
        for t in range(rng.randint(1, 7)):
            chosen.append((p, t, rng.choice("ua"), "é" * rng.randint(0, 5)))
        rejected += [(p, t, r, x) for q, t, r, x in chosen if q == p and t < 3]
        rejected.append((p, 50, "a", "end"))
    for _, (n, prompt, a, b, sa, sb) in pairs(spark, chosen, rejected).items():
        for text, spans in ((a, sa), (b, sb)):
            for part in filter(None, spans.split(",")):
                start, end = map(int, part.split("-"))
                assert text[end - 1] == "/" and text[:start].endswith("<a>")


def test_repeated_turns_and_empty_tables(spark):
    rows = [(1, 0, "u", "x"), (1, 0, "u", "x"), (1, None, "a", "y")]
    assert pairs(spark, rows, rows)[1][0] == 3
    none = spark.createDataFrame([], TURN)
    assert preferences.preference_pairs(none, none).count() == 0


def test_swaps_change_the_last_answer_only(spark, data):
    turns = spark.read.parquet(f"{data}/conversations.parquet")
    rows, swapped = preferences.answer_swaps(turns)
    assert rows.count() == swapped.count() == turns.count()
    changed = rows.join(swapped.withColumnRenamed("text", "other"), ["pair", "turn", "role"]).where("text <> other")
    assert changed.groupBy("pair").count().where("count > 1").count() == 0
