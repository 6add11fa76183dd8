"""Benchmark passages in documents, found by an FM-index per shard of documents.

A shard is some documents of one task. Its words become numbers; words that cannot be
part of a phrase (outside the words of all phrases of a length, or in a run of such
words shorter than that length) become separators before the index is built, so it
holds what a phrase could match and nothing else. All phrases are searched backward at
once, their places located, and the places merged into spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, query, table
from .fmindex import Index


def _fold() -> bytes:
    """A-Z in lower case; all ASCII but digits and letters become blanks."""
    out = bytearray(range(256))
    for byte in range(0x80):
        letter = chr(byte)
        out[byte] = ord(letter.lower()) if letter.isalnum() else 0x20
    return bytes(out)


FOLD = _fold()
WORD = re.compile(rb"[^\x20]+")


def words_of(text: str | None) -> Iterator[list[bytes]]:
    for piece in pieces((text or "").encode("utf-8", "surrogatepass").translate(FOLD)):
        yield piece.split()


@dataclass(frozen=True)
class Settings:
    """``max_benchmark_bytes`` bounds what is sent to every task; a larger benchmark is
    an error and can be given in parts. ``shard_words`` bounds the words of an index."""

    window: int = 10
    max_benchmark_bytes: int = 256 << 20
    shard_words: int = 1 << 21


@dataclass
class Phrases:
    """Distinct windows as rows of word numbers, and the items of each."""

    window: int
    numbers: dict[bytes, int] = field(default_factory=dict)
    rows: np.ndarray = None
    lengths: np.ndarray = None
    items: list[tuple[str, ...]] = field(default_factory=list)
    #: Per phrase length, which word numbers its phrases hold.
    allowed: dict[int, np.ndarray] = field(default_factory=dict)


def phrases_of(items: list[tuple[object, str | None]], window: int) -> Phrases:
    """All windows of ``window`` words; an item of fewer words is one phrase.

    Items are told apart by id; a null id is written ``null``. Items without words have
    no phrase.
    """
    out = Phrases(window)
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        words = [w for part in words_of(text) for w in part]
        numbers = [out.numbers.setdefault(w, len(out.numbers) + 1) for w in words]
        name = "null" if item is None else str(item)
        for start in range(max(1, len(numbers) - window + 1) if numbers else 0):
            found.setdefault(tuple(numbers[start : start + window]), set()).add(name)
    order = sorted(found)
    out.lengths = np.array([len(p) for p in order], np.int64)
    out.rows = np.zeros((len(order), window), np.int64)
    for i, phrase in enumerate(order):
        out.rows[i, : len(phrase)] = phrase
    out.items = [tuple(sorted(found[p])) for p in order]
    for length in sorted(set(out.lengths.tolist())):
        allowed = np.zeros(len(out.numbers) + 1, bool)
        allowed[out.rows[out.lengths == length]] = True
        allowed[0] = False
        out.allowed[length] = allowed
    return out


def matchable(codes: np.ndarray, phrases: Phrases) -> np.ndarray:
    """Which places lie in a run that could hold a phrase of some length."""
    keep = np.zeros(len(codes), bool)
    for length, allowed in phrases.allowed.items():
        inside = allowed[codes]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= length
        change = np.zeros(len(codes) + 1, np.int64)
        change[starts[long]] += 1
        change[ends[long]] -= 1
        keep |= np.cumsum(change[:-1]) > 0
    return keep


class Shard:
    """Documents waiting for their index."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.texts: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []
        self.n_words: list[int] = []
        self.size = 0

    def add(self, text: str | None) -> None:
        number = self.phrases.numbers.get
        parts = [
            np.fromiter(map(number, words, repeat(0)), np.int32, len(words))
            for words in words_of(text)
        ]
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        places = np.flatnonzero(matchable(codes, self.phrases))
        # A zero wherever a word between two kept ones is missing, and after the text.
        gaps = np.flatnonzero(np.diff(places, append=len(codes) + 1) > 1) + 1
        self.texts.append(np.insert(codes[places], gaps, 0))
        self.places.append(np.insert(places, gaps, -1))
        self.owners.append(np.full(len(self.places[-1]), len(self.n_words), np.int64))
        self.n_words.append(len(codes))
        self.size += len(codes)

    def found(self) -> list[tuple[list[str], list[tuple[int, int]]]]:
        """Per document its items and merged spans of hit words [start, end)."""
        out: list = [([], []) for _ in self.n_words]
        text = np.concatenate(self.texts) if self.texts else np.zeros(0, np.int32)
        if not len(text) or not len(self.phrases.items):
            return out
        places, owners = np.concatenate(self.places), np.concatenate(self.owners)
        index = Index(text)
        low, high = index.search(self.phrases.rows, self.phrases.lengths)
        counts = high - low
        phrase = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[phrase]
        at = index.locate(rows)
        change = np.zeros(len(text) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + self.phrases.lengths[phrase], -1)
        hit = np.cumsum(change[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            first = int(places[start])
            out[owners[start]][1].append((first, first + end - start))
        pairs = np.unique(owners[at] * len(counts) + phrase)
        names: dict[int, set[str]] = {}
        for pair in pairs.tolist():
            names.setdefault(pair // len(counts), set()).update(self.phrases.items[pair % len(counts)])
        for owner, items in names.items():
            out[owner] = (sorted(items), out[owner][1])
        return out


def without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    data = text.encode("utf-8", "surrogatepass")
    bounds = [m.span() for m in WORD.finditer(data.translate(FOLD))]
    kept, at = [], 0
    for start, end in spans:
        kept.append(data[at : bounds[start][0]])
        at = bounds[end - 1][1]
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def read_benchmark(benchmark: DataFrame, settings: Settings) -> Phrases:
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    if size > settings.max_benchmark_bytes:
        raise ValueError(f"benchmark of {size} bytes; give it in parts of max_benchmark_bytes")
    return phrases_of([(r["item_id"], r["text"]) for r in rows.collect()], settings.window)


def _by_shard(
    batches: Iterator[pa.RecordBatch], phrases: Phrases, text: int, settings: Settings
) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    """(rows, what was found in each, n_words of each), shard by shard."""
    waiting: list[pa.RecordBatch] = []
    shard = Shard(phrases)

    def done() -> Iterator[tuple[pa.RecordBatch, list, list]]:
        found, at = shard.found(), 0
        for part in waiting:
            end = at + part.num_rows
            yield part, found[at:end], shard.n_words[at:end]
            at = end

    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            for value in part.column(text):
                shard.add(value.as_py())
            waiting.append(part)
            if shard.size >= settings.shard_words:
                yield from done()
                waiting, shard = [], Shard(phrases)
    yield from done()


FOUND = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:int,end:int>>"


def find_passages(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """doc_id, n_words, n_hit, items and merged spans (in words) of every row.

    Null and empty texts have no words; equal rows are judged alike. An empty benchmark
    hits nothing. Other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_benchmark(benchmark, settings))
    key = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, n_words in _by_shard(batches, shared.value, 1, settings):
            hits = [sum(b - a for a, b in spans) for _, spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array([items for items, _ in found], pa.list_(pa.string())),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in spans] for _, spans in found],
                        pa.list_(span),
                    ),
                ],
                names=["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    narrow = docs.select("doc_id", F.col("text").cast("string"))
    return narrow.mapInArrow(run, f"doc_id {key}, {FOUND}")


def remove_passages(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with the merged spans cut out of ``text``, and n_chars following it."""
    shared = docs.sparkSession.sparkContext.broadcast(read_benchmark(benchmark, settings))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, _ in _by_shard(batches, shared.value, place, settings):
            column = part.column(place)
            texts = [without(t.as_py(), spans) for t, (_, spans) in zip(column, found)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts, column.type) if i == place else part.column(i)
                    for i in range(part.num_columns)
                ],
                names=part.schema.names,
            )

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(length, "n_chars"))
    return out.select(*docs.columns)


@query("op7_fm_index_decontamination")
def fm_index_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Which words of which documents stand in benchmark windows."""
    found = find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
