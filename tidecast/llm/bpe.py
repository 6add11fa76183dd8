"""Byte-level BPE: texts to ids and back, in Arrow batches.

A text is cut by the vocabulary's pattern; each piece is written in the 256-letter
alphabet that stands for bytes and merged by the tokenizers library. Distinct pieces
are encoded once per task as long as the piece cache lasts. Decoding looks every id's
bytes up again, so ids that end inside a character join up with the next id's bytes.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import query, table

#: Pieces in a worker's cache; beyond, the half that came last goes.
CACHE_PIECES = 600_000
#: Characters of a text that are cut into pieces at a time.
SEGMENT = 1_000_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 as itself, others from 256 on."""
    shown = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    letters, spare = [], 256
    for byte in range(256):
        if byte in shown:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The two parts each token is merged from, in rank order.

    The parts are what is left of the token when only lower ranks are merged.
    """
    pairs = []
    for token, own in sorted(ranks.items(), key=lambda item: item[1]):
        if len(token) < 2:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = own, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], own)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            pairs.append((parts[0], parts[1]))
    return pairs


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """The rank file as a description that the tokenizers library loads."""
    letters = byte_letters()
    spell = lambda token: "".join(letters[b] for b in token)
    return json.dumps(
        {
            "version": "1.0",
            "truncation": None,
            "padding": None,
            "added_tokens": [],
            "normalizer": None,
            # Pieces arrive already cut by the pattern.
            "pre_tokenizer": {
                "type": "ByteLevel",
                "add_prefix_space": False,
                "trim_offsets": False,
                "use_regex": False,
            },
            "post_processor": None,
            "decoder": None,
            "model": {
                "type": "BPE",
                "dropout": None,
                "unk_token": None,
                "continuing_subword_prefix": None,
                "end_of_word_suffix": None,
                "fuse_unk": False,
                "byte_fallback": False,
                "ignore_merges": False,
                "vocab": {spell(token): rank for token, rank in ranks.items()},
                "merges": [[spell(a), spell(b)] for a, b in merge_pairs(ranks)],
            },
        }
    )


class Codec:
    """Encodes and decodes with one vocabulary; made once per Python worker."""

    def __init__(self, description: str, pattern: str, cache_pieces: int = CACHE_PIECES):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.find = regex.compile(pattern).findall
        # A single blank between a visible character and a letter opens a piece, so a
        # long text may be cut before it.
        self.gap = regex.compile(r"(?<=\S) (?=\p{L})").search
        self.limit = cache_pieces
        self.cache: dict[str, tuple[int, ...]] = {}
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocab = json.loads(description)["model"]["vocab"]
        self.bytes_of = {
            rank: bytes(byte_of[letter] for letter in token) for token, rank in vocab.items()
        }
        self.decimal = {rank: str(rank) for rank in self.bytes_of}
        self.same = {rank: rank for rank in self.bytes_of}  # one object per id

    def learn(self, new: list[str]) -> None:
        """Encode pieces that the cache lacks, in batches of the library."""
        for start in range(0, len(new), 10_000):
            part = new[start : start + 10_000]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            for piece, one in zip(part, found):
                self.cache[piece] = tuple(map(self.same.__getitem__, one.ids))

    def segments(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SEGMENT:
            cut = self.gap(text, start + SEGMENT)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for segment in self.segments(text or ""):
            pieces = self.find(segment)
            new = set(pieces).difference(self.cache)
            if new:
                if len(self.cache) + len(new) > self.limit:
                    self.cache = dict(islice(self.cache.items(), self.limit // 2))
                    new = set(pieces).difference(self.cache)
                self.learn(list(new))
            ids.extend(chain.from_iterable(map(self.cache.__getitem__, pieces)))
        return ids

    def offsets(self, ids: Iterable[int]) -> list[tuple[int, int]]:
        """Start and end byte of each id in the UTF-8 of the text."""
        found, at = [], 0
        for i in ids:
            end = at + len(self.bytes_of[i])
            found.append((at, end))
            at = end
        return found

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of the ids; characters split between ids come together again."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(description: str, pattern: str) -> Codec:
    # Spark's tasks are the parallel part; the library's own threads only get in the way.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Codec(description, pattern)


@lru_cache(maxsize=4)
def description_of(ranks_path: str) -> str:
    return tokenizer_json(read_ranks(ranks_path))


OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "starts": ("array<int>", pa.list_(pa.int32())),
    "n_tokens": ("bigint", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
    "decoded": ("string", pa.string()),
    "packed_ids": ("binary", pa.binary()),
}


def encode_texts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    outputs: tuple[str, ...] = ("ids",),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key`` and, of each row's text, the wanted ``outputs``:

    ids, packed_ids (four little-endian bytes each), starts (first byte of each id in the text's UTF-8), n_tokens, ids_sha256 (of
    the decimal ids joined by blanks), decoded (the text from its ids) and
    decoded_sha256 (of its bytes). A null or empty text has no ids. Special tokens'
    names are plain text. Rows are independent: repeated rows and null keys keep their
    place, other columns are left out. Memory follows the longest text of a batch.
    """
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"no such output: {sorted(unknown)}")
    spark = docs.sparkSession
    # The vocabulary's size is fixed, whatever the data.
    shared = spark.sparkContext.broadcast(description_of(ranks_path))
    narrow = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    key_type = docs.schema[key].dataType.simpleString()
    schema = f"key {key_type}, " + ", ".join(f"{o} {OUTPUTS[o][0]}" for o in outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value, pattern)
        for batch in batches:
            # A few rows at a time: texts may be very long.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                columns: dict[str, list] = {o: [] for o in outputs}
                for value in part.column(1):
                    ids = coder.encode(value.as_py())
                    for o in outputs:
                        columns[o].append(_output(coder, o, ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(columns[o], OUTPUTS[o][1]) for o in outputs]],
                    names=["key", *outputs],
                )

    return narrow.mapInArrow(run, schema).withColumnRenamed("key", key)


def _output(coder: Codec, name: str, ids: list[int]):
    if name == "ids":
        return ids
    if name == "packed_ids":
        return np.array(ids, "<u4").tobytes()
    if name == "starts":
        return [start for start, _ in coder.offsets(ids)]
    if name == "n_tokens":
        return len(ids)
    if name == "ids_sha256":
        return hashlib.sha256(" ".join(map(coder.decimal.__getitem__, ids)).encode()).hexdigest()
    if name == "decoded":
        return coder.decode(ids).decode("utf-8", "replace")
    return hashlib.sha256(coder.decode(ids)).hexdigest()


def decode_ids(
    coded: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """``key`` and ``text`` of each row's ids. Bytes that form no character become U+FFFD.

    Null ids give an empty text; an id outside the vocabulary is an error.
    """
    shared = coded.sparkSession.sparkContext.broadcast(description_of(ranks_path))
    narrow = coded.select(coded[key].alias("key"), coded[ids].alias("ids"))
    key_type = coded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value, pattern)
        for batch in batches:
            texts = [
                coder.decode(row.as_py() or []).decode("utf-8", "replace")
                for row in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["key", "text"]
            )

    return narrow.mapInArrow(run, f"key {key_type}, text string").withColumnRenamed("key", key)


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path of the rank file and the pattern of the installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


@query("op1_byte_level_bpe")
def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, and decoded again from its ids."""
    path, pattern = public_vocabulary()
    return encode_texts(
        table(spark, folder, "documents"),
        path,
        pattern,
        ("n_tokens", "ids_sha256", "decoded_sha256"),
    ).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
