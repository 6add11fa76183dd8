from __future__ import annotations

import hashlib

import pytest
import tiktoken

from tidecast.llm import bpe

PATH, PATTERN = bpe.public_vocabulary()


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


def test_same_ids_as_ranks_give(spark, odd, reference):
    got = bpe.encode_texts(odd, PATH, PATTERN, ("ids", "n_tokens", "ids_sha256", "decoded_sha256", "decoded"))
    want = [(r["doc_id"], reference.encode_ordinary(r["text"] or ""), r["text"] or "") for r in odd.collect()]
    rows = [(r["doc_id"], r["ids"], r["decoded"]) for r in got.collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted(rows, key=order) == sorted(want, key=order)
    for r in got.collect():
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_round_trip_through_ids(spark, odd):
    coded = bpe.encode_texts(odd, PATH, PATTERN, ("ids",)).where("doc_id is not null")
    back = {(r["doc_id"], r["text"]) for r in bpe.decode_ids(coded, PATH, PATTERN).collect()}
    assert back == {(r["doc_id"], r["text"] or "") for r in odd.collect() if r["doc_id"] is not None}


def test_split_characters_and_offsets():
    coder = bpe.codec(bpe.description_of(PATH), PATTERN)
    text = "né \U0001f9ff ok"
    ids = coder.encode(text)
    spans = coder.offsets(ids)
    data = text.encode()
    assert b"".join(data[a:b] for a, b in spans) == data
    # Some id ends inside a character, and only together do they decode.
    assert any(coder.decode([i]).decode("utf-8", "replace") == "�" for i in ids)
    assert coder.decode(ids).decode() == text


def test_long_texts_are_cut_between_pieces(reference, monkeypatch):
    coder = bpe.Codec(bpe.description_of(PATH), PATTERN, cache_pieces=50)
    monkeypatch.setattr(bpe, "SEGMENT", 40)
    text = "It's  a   text,\n with 12 odd  gaps   and ünïcode — " * 30
    assert coder.encode(text) == reference.encode_ordinary(text)


def test_empty_table_and_unknown_output(nothing, odd):
    assert bpe.encode_texts(nothing, PATH, PATTERN, ("ids",)).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_texts(odd, PATH, PATTERN, ("nonsense",))


def test_clashing_columns(clashing):
    assert bpe.encode_texts(clashing, PATH, PATTERN, ("n_tokens",)).columns == ["doc_id", "n_tokens"]
