"""Scores of texts under a bigram model kept in Elias-Fano tries.

Tokens are words and one end per text; the first token's context is the start. With
c the training counts, N all tokens and V distinct ones,

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | h) = (c(h w) + prior * p(w)) / (c(h) + prior)

Texts are handled in blocks of a task. A block sends its distinct words, then its
distinct bigrams, packed and sorted, to shards by hash; a shard adds the blocks' counts,
builds its part of the model, and answers every block in the block's own order. So the
counts cover the whole corpus, a word or bigram travels once per block however frequent
it is, and no machine holds the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, split_words, table, written
from .eliasfano import MISSING, EliasFano, Trie, dequantise, quantise

END = b""


@dataclass(frozen=True)
class Settings:
    """``prior``: weight of the word model; the sizes bound blocks and shards."""

    prior: float = 100.0
    block_tokens: int = 2_000_000
    shard_words: int = 250_000
    shard_bigrams: int = 1_000_000


def trained(doc_id: str = "doc_id", parts: int = 7, held: int = 2) -> Column:
    """Texts to learn from: crc32 of the id's digits does not leave ``held``. A null id is learned from."""
    left = F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
    return F.coalesce(left != held, F.lit(True))


def text_blocks(docs: DataFrame, settings: Settings) -> DataFrame:
    """Blocks of texts: ids, learned flags, token counts, distinct words and word codes.

    The words of a block are numbered from 0 by falling frequency; codes are 4-byte
    numbers, text after text, each closed by the end token.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    key_arrow = pa.int32() if key == "int" else pa.string() if key == "string" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, learned, lengths, chunks, size = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal number
            coded = pa.chunked_array(chunks).combine_chunks().dictionary_encode()
            codes = coded.indices.to_numpy()
            order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            counted = np.repeat(np.array(learned, bool), lengths)
            codes = place[codes]
            counts = np.bincount(codes[counted], minlength=len(order))
            words = b"\n".join(coded.dictionary.take(pa.array(order)).to_pylist())
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 24 | (number - 1)], pa.int64()),
                    pa.array([ids], pa.list_(key_arrow)),
                    pa.array([learned], pa.list_(pa.bool_())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([size], pa.int64()),
                    pa.array([len(order)], pa.int64()),
                    pa.array([words], pa.binary()),
                    pa.array([_small(counts)], pa.binary()),
                    pa.array([_packed(codes)], pa.binary()),
                ],
                names=["block", "ids", "learned", "lengths", "tokens", "distinct", "words", "counts", "codes"],
            )

        for batch in batches:
            for doc_id, text, own in zip(*batch.columns):
                words = split_words(text.as_py())
                words.append(END)
                ids.append(doc_id.as_py())
                learned.append(own.as_py())
                lengths.append(len(words))
                chunks.append(pa.array(words, pa.binary()))
                size += len(words)
                if size >= settings.block_tokens:
                    yield block()
                    ids, learned, lengths, chunks, size = [], [], [], [], 0
        if ids:
            yield block()

    narrow = docs.select("doc_id", F.col("text").cast("string"), trained().alias("learned"))
    return narrow.mapInArrow(
        run,
        f"block bigint, ids array<{key}>, learned array<boolean>, lengths array<bigint>, "
        "tokens bigint, distinct bigint, words binary, counts binary, codes binary",
    )


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, compressed: high bytes are mostly zero."""
    wide = values.astype("<i8").view(np.uint8).reshape(len(values), 8)
    return pa.compress(np.ascontiguousarray(wide.T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True) if n else b""
    wide = np.frombuffer(planes, np.uint8).reshape(8, n)
    return np.ascontiguousarray(wide.T).view("<i8").reshape(n)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: rows are large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _row(names: list[str], kinds: list[pa.DataType], values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


def _shards_of_words(words: list[bytes], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each word, and the words' order by shard."""
    found = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    shard = (found % np.uint64(shards)).astype(np.int64)
    return shard, np.argsort(shard, kind="stable")


def word_requests(blocks: DataFrame, shards: int) -> DataFrame:
    """(shard, block, words, counts): each block's words for each shard."""
    names = ["shard", "block", "words", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, counted in zip(*batch.columns):
                words = data.as_py().split(b"\n")
                counts = _unsmall(counted.as_py(), len(words))
                shard, order = _shards_of_words(words, shards)
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in np.flatnonzero(np.diff(edges)).tolist():
                    part = order[edges[s] : edges[s + 1]]
                    sent = b"\n".join([words[i] for i in part.tolist()])
                    yield _row(names, kinds, [s, block.as_py(), sent, _small(counts[part])])

    return blocks.select("block", "words", "counts").mapInArrow(
        run, "shard bigint, block bigint, words binary, counts binary"
    )


def word_answers(requests: DataFrame, shards: int) -> DataFrame:
    """(block, shard, numbers, counts, total, distinct, largest): a number from 1 and the
    corpus count of each word asked for, in the order asked; and the shard's sums and
    largest number."""
    names = ["block", "shard", "numbers", "counts", "total", "distinct", "largest"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def answer(group: pa.Table) -> pa.Table:
        asked = [w.split(b"\n") for w in group.column("words").to_pylist()]
        words = pa.chunked_array([pa.array(w, pa.binary()) for w in asked]).combine_chunks()
        coded = words.dictionary_encode()
        place = coded.indices.to_numpy()
        counts = np.concatenate(
            [_unsmall(c, len(w)) for c, w in zip(group.column("counts").to_pylist(), asked)]
        )
        sums = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(sums, place, counts)
        shard = group.column("shard")[0].as_py()
        numbers = 1 + np.arange(len(sums), dtype=np.int64) * shards + shard
        out, at = [], 0
        for block, own in zip(group.column("block").to_pylist(), asked):
            part = place[at : at + len(own)]
            at += len(own)
            values = [
                block, shard, _packed(numbers[part]), _small(sums[part]),
                int(sums.sum()), int((sums > 0).sum()), int(numbers.max()),
            ]
            out.append(_row(names, kinds, values))
        return pa.Table.from_batches(out)

    return requests.groupBy("shard").applyInArrow(
        answer,
        "block bigint, shard bigint, numbers binary, counts binary, total bigint, distinct bigint,"
        " largest bigint",
    )


def _words_back(words: bytes, answers: list[dict], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and corpus count of each of a block's words."""
    own = words.split(b"\n")
    shard, order = _shards_of_words(own, shards)
    sizes = np.bincount(shard, minlength=shards)
    parts = [(a, int(sizes[a["shard"]])) for a in sorted(answers, key=lambda a: a["shard"])]
    numbers, counts = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
    numbers[order] = np.concatenate([_unpacked(a["numbers"], n) for a, n in parts])
    counts[order] = np.concatenate([_unsmall(a["counts"], n) for a, n in parts])
    return numbers, counts


@dataclass
class Bigrams:
    """A block's tokens as distinct bigrams: which ones, and where."""

    pairs: np.ndarray  # context * (distinct + 1) + word; context 0 is the start
    place: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, lengths: np.ndarray, learned: np.ndarray, distinct: int) -> Bigrams:
        context = np.empty(len(codes), np.int64)
        context[1:] = codes[:-1] + 1
        context[np.cumsum(lengths) - lengths] = 0
        pairs, place = np.unique(context * (distinct + 1) + codes, return_inverse=True)
        counts = np.bincount(place[np.repeat(learned, lengths)], minlength=len(pairs))
        return cls(pairs, place, counts)

    def split(self, distinct: int) -> tuple[np.ndarray, np.ndarray]:
        return self.pairs // (distinct + 1), self.pairs % (distinct + 1)


def _mixed(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ word.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Numbered:
    """A block's bigrams by corpus numbers, in the order in which shards are asked."""

    def __init__(self, row: dict, shards: int, word_shards: int, total: int, distinct: int):
        lengths = np.array(row["lengths"], np.int64)
        codes = _unpacked(row["codes"], int(lengths.sum()))
        self.lengths, self.codes = lengths, codes
        numbers, self.word_counts = _words_back(row["words"], row["answers"], word_shards)
        own = len(numbers)
        self.bigrams = Bigrams.of(codes, lengths, np.array(row["learned"], bool), own)
        first, self.word = self.bigrams.split(own)
        ends = int(self.word_counts[codes[-1]])  # every text ends in the end token
        self.context = np.concatenate([[0], numbers])[first]
        self.context_counts = np.concatenate([[ends], self.word_counts])[first]
        self.number = numbers[self.word]
        self.base = np.log10(self.word_counts + 1.0) - np.log10(total + distinct + 1.0)
        shard = (_mixed(self.context, self.number) % np.uint64(shards)).astype(np.int64)
        self.order = np.lexsort((self.number, self.context, shard))
        self.edges = np.searchsorted(shard[self.order], np.arange(shards + 1))


def bigram_requests(blocks: DataFrame, sizes: dict, prior: float) -> DataFrame:
    """(shard, block, keys, counts, contexts, lower): each block's bigrams for each shard."""
    names = ["shard", "block", "keys", "counts", "contexts", "lower"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
    words = sizes["numbers"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = Numbered(row, sizes["shards"], sizes["word_shards"], sizes["total"], sizes["distinct"])
            lower = quantise(n.base)
            for s in np.flatnonzero(np.diff(n.edges)).tolist():
                part = n.order[n.edges[s] : n.edges[s + 1]]
                key = n.context[part].astype(np.uint64) * np.uint64(words) + n.number[part].astype(np.uint64)
                values = [
                    s,
                    row["block"],
                    EliasFano.of(key, words * words).tobytes(),
                    _small(n.bigrams.counts[part]),
                    _small(n.context_counts[part]),
                    lower[n.word[part]].astype("<u2").tobytes(),
                ]
                yield _row(names, kinds, values)

    return blocks.mapInArrow(
        run, "shard bigint, block bigint, keys binary, counts binary, contexts binary, lower binary"
    )


def _small(values: np.ndarray) -> bytes:
    """Counts in one byte each; those of 255 and more follow in eight bytes."""
    short = np.minimum(values, 255).astype(np.uint8)
    return short.tobytes() + values[values >= 255].astype("<i8").tobytes()


def _unsmall(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", offset=n)
    return out


def shard_trie(
    keys: np.ndarray, counts: np.ndarray, contexts: np.ndarray, lower: np.ndarray, words: int, prior: float
) -> Trie:
    """The trie of the bigrams seen in training; equal keys' counts are added."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    sums = np.add.reduceat(counts[order], heads) if len(heads) else np.zeros(0, np.int64)
    seen = sums > 0
    first = order[heads[seen]]
    p = (sums[seen] + prior * 10 ** dequantise(lower[first])) / (contexts[first] + prior)
    grams = np.stack([keys[heads[seen]] // np.uint64(words), keys[heads[seen]] % np.uint64(words)], axis=1)
    return Trie.of(grams, quantise(np.log10(p)), words)


def bigram_answers(requests: DataFrame, words: int, prior: float) -> DataFrame:
    """(block, shard, codes): the quantised log10 p(w | h) of each bigram asked for that
    training has seen, in the order asked; ``MISSING`` for others."""
    names, kinds = ["block", "shard", "codes"], [pa.int64(), pa.int64(), pa.binary()]

    def answer(group: pa.Table) -> pa.Table:
        keys = [EliasFano.read(k)[0].all() for k in group.column("keys").to_pylist()]
        sizes = [len(k) for k in keys]
        whole = np.concatenate(keys)
        unpack = lambda c: np.concatenate(
            [_unsmall(d, n) for d, n in zip(group.column(c).to_pylist(), sizes)]
        )
        lower = np.concatenate([np.frombuffer(d, "<u2") for d in group.column("lower").to_pylist()])
        trie = shard_trie(whole, unpack("counts"), unpack("contexts"), lower, words, prior)
        # From here on the trie is read in its flat form.
        trie = Trie.read(trie.tobytes())
        out = []
        shard = group.column("shard")[0].as_py()
        for block, own in zip(group.column("block").to_pylist(), keys):
            grams = np.stack([own // np.uint64(words), own % np.uint64(words)], axis=1)
            out.append(_row(names, kinds, [block, shard, trie.find(grams).astype("<u2").tobytes()]))
        return pa.Table.from_batches(out)

    return requests.groupBy("shard").applyInArrow(
        answer, "block bigint, shard bigint, codes binary"
    )


def block_scores(blocks: DataFrame, sizes: dict, prior: float, key: str) -> DataFrame:
    """One row per text out of blocks with both kinds of answers."""
    key_arrow = pa.int32() if key == "int" else pa.string() if key == "string" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = Numbered(row, sizes["shards"], sizes["word_shards"], sizes["total"], sizes["distinct"])
            parts = sorted(row["found"], key=lambda a: a["shard"])
            codes = np.empty(len(n.order), np.uint16)
            codes[n.order] = np.concatenate([np.frombuffer(a["codes"], "<u2") for a in parts])
            base = n.base[n.word]
            unseen = base + np.log10(prior / (n.context_counts + prior))
            p = np.where(codes == MISSING, unseen, dequantise(codes))
            starts = np.cumsum(n.lengths) - n.lengths
            known = (n.word_counts > 0)[n.codes].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], key_arrow),
                    pa.array([not x for x in row["learned"]], pa.bool_()),
                    pa.array(n.lengths, pa.int64()),
                    pa.array(np.add.reduceat(known, starts), pa.int64()),
                    pa.array(np.full(len(starts), sizes["total"]), pa.int64()),
                    pa.array(np.add.reduceat(n.base[n.codes], starts), pa.float64()),
                    pa.array(np.add.reduceat(p[n.bigrams.place], starts), pa.float64()),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return blocks.mapInArrow(
        run,
        f"doc_id {key}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )


def score_texts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per row.

    Null and empty texts are one end token. Every row is scored, repeated ones alike;
    rows with a null doc_id are learned from. An empty table gives an empty result.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    blocks = written(text_blocks(docs, settings), "lm-blocks", "zstd")
    size = blocks.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("d")
    ).first()
    word_shards = 1 + size["d"] // settings.shard_words
    shards = 1 + size["t"] // settings.shard_bigrams
    answers = written(
        word_answers(word_requests(blocks, word_shards), word_shards), "lm-words", "zstd"
    )
    sums = answers.groupBy("shard").agg(F.max("total").alias("n"), F.max("distinct").alias("v"))
    n, v = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    largest = answers.agg(F.coalesce(F.max("largest"), F.lit(0))).first()[0]
    sizes = {
        "word_shards": word_shards,
        "shards": shards,
        "total": n,
        "distinct": v,
        "numbers": largest + 1,
    }
    grouped = answers.groupBy(F.col("block").alias("of")).agg(
        F.collect_list(F.struct("shard", "numbers", "counts")).alias("answers")
    )
    ready = blocks.drop("counts", "tokens", "distinct").join(grouped, F.col("block") == F.col("of")).drop("of")
    asked = bigram_requests(ready, sizes, settings.prior)
    found = written(bigram_answers(asked, sizes["numbers"], settings.prior), "lm-bigrams")
    grouped = found.groupBy(F.col("block").alias("of")).agg(
        F.collect_list(F.struct("shard", "codes")).alias("found")
    )
    complete = ready.join(grouped, F.col("block") == F.col("of")).drop("of")
    return block_scores(complete, sizes, settings.prior, key)


@query("op2_elias_fano_lm")
def elias_fano_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, learned from those that are not held out."""
    return score_texts(table(spark, folder, "documents"))
