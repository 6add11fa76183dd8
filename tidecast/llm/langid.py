"""Language of a text by a small convolutional network over bytes.

Bytes are folded to 64 classes and embedded; filters of several widths slide over a
window, each keeps its largest answer, and a softmax over these answers gives the
language. Training is plain numpy on a bounded, balanced sample of labelled texts;
all windows of every text are scored in batches inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, table, written

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``per_language``, ``sample_texts`` and ``sample_chars`` bound the training sample: that
    many texts of a language and of all together, every language with the same number, and
    of each text that many characters, in ``train_windows`` excerpts from anywhere in it, of
    which as many windows are learned."""

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 12
    embedding: int = 8
    per_language: int = 400
    sample_texts: int = 25_600
    sample_chars: int = 2048
    train_windows: int = 4
    epochs: int = 6
    rate: float = 0.01
    seed: int = 7


def byte_classes() -> np.ndarray:
    """64 classes: blank and signs 0, digits 1, letters 2-27 in either case, then lead
    bytes by their low bits and trail bytes by theirs."""
    classes = np.zeros(256, np.int64)
    classes[0x30:0x3A] = 1
    for i in range(26):
        classes[0x41 + i] = classes[0x61 + i] = 2 + i
    classes[0xC0:] = 28 + (np.arange(64) % 4)
    classes[0x80:0xC0] = 32 + (np.arange(64) % 32)
    return classes


CLASSES = byte_classes()


def windows_of(data: bytes, size: int) -> np.ndarray:
    """The text's bytes as classes in rows of ``size``; the last row is padded by blanks.

    All but the first row start inside a letter run at times; with rows of hundreds of
    bytes that loses nothing of note.
    """
    codes = CLASSES[np.frombuffer(data, np.uint8)]
    rows = max(1, -(-len(codes) // size))
    out = np.zeros(rows * size, np.int64)
    out[: len(codes)] = codes
    return out.reshape(rows, size)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def convolved(self, rows: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Largest answer of each filter per row and, per width, where it was."""
        x = self.embedding[rows]
        pooled, places = [], []
        for kernel, bias in zip(self.filters, self.biases):
            width = kernel.shape[0] // x.shape[2]
            view = np.lib.stride_tricks.sliding_window_view(x, width, axis=1)
            flat = view.transpose(0, 1, 3, 2).reshape(len(x), -1, kernel.shape[0])
            answers = flat @ kernel
            at = answers.argmax(axis=1)
            best = np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0, :]
            pooled.append(np.maximum(best + bias, 0))
            places.append(at)
        return pooled, places

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """As ``convolved`` without the places: a width is a sum of table look-ups.

        The answer to byte class c at place k of a filter is a fixed number, so a
        filter of width w adds w rows of a 64-row table instead of multiplying.
        """
        size, out = self.embedding.shape[1], []
        for kernel, bias in zip(self.filters, self.biases):
            width = kernel.shape[0] // size
            parts = [self.embedding @ kernel[k * size : (k + 1) * size] for k in range(width)]
            pairs = []
            for k in range(0, width - 1, 2):
                both = parts[k][:, None, :] + parts[k + 1][None, :, :]
                pairs.append((k, both.reshape(-1, kernel.shape[1])))
            last = rows.shape[1] - width + 1
            answers = None
            codes = rows[:, :-1] * 64 + rows[:, 1:]
            for k, both in pairs:
                found = both[codes[:, k : k + last]]
                answers = found if answers is None else np.add(answers, found, out=answers)
            if width % 2:
                answers += parts[-1][rows[:, width - 1 : width - 1 + last]]
            out.append(np.maximum(answers.max(axis=1) + bias, 0))
        return np.concatenate(out, axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Softmax per window."""
        logits = self.pooled(rows) @ self.weights + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)


def train(samples: list[tuple[str, str]], settings: Settings = Settings()) -> Network:
    """Fit the network on (text, language) pairs by Adam; the same pairs give the same net."""
    rng = np.random.default_rng(settings.seed)
    languages = sorted({lang for _, lang in samples})
    at = {lang: i for i, lang in enumerate(languages)}
    rows, wanted = [], []
    for text, lang in sorted(samples):
        cut = windows_of(text.encode("utf-8", "surrogatepass"), settings.window)
        if len(cut) > settings.train_windows:
            cut = cut[rng.choice(len(cut), settings.train_windows, replace=False)]
        rows.append(cut)
        wanted += [at[lang]] * len(cut)
    e, f = settings.embedding, settings.filters
    net = Network(
        languages,
        rng.normal(0, 0.5, (64, e)).astype(np.float32),
        [rng.normal(0, (2 / (w * e)) ** 0.5, (w * e, f)).astype(np.float32) for w in settings.widths],
        [np.zeros(f, np.float32) for _ in settings.widths],
        rng.normal(0, 0.1, (f * len(settings.widths), len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    if not rows:
        return net
    x, y = np.concatenate(rows), np.array(wanted)
    # Every other window ends early, as short texts do.
    ends = np.where(rng.random(len(x)) < 0.5, rng.integers(24, settings.window, len(x)), settings.window)
    x = np.where(np.arange(settings.window) < ends[:, None], x, 0)
    moments: dict[int, list] = {}
    step = 0

    def update(slot: int, value: np.ndarray, grad: np.ndarray) -> None:
        m, v = moments.setdefault(slot, [np.zeros_like(value), np.zeros_like(value)])
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        value -= settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    for _ in range(settings.epochs):
        order = rng.permutation(len(x))
        for start in range(0, len(x), 64):
            pick = order[start : start + 64]
            part, step = x[pick], step + 1
            pooled, places = net.convolved(part)
            hidden = np.concatenate(pooled, axis=1)
            logits = hidden @ net.weights + net.bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p /= len(pick)
            back = (p @ net.weights.T) * (hidden > 0)
            grad_embedding = np.zeros_like(net.embedding)
            grads = []
            for i, width in enumerate(settings.widths):
                g = back[:, i * f : (i + 1) * f]
                # Only the place of the largest answer learns.
                spots = places[i][:, :, None] + np.arange(width)
                codes = part[np.arange(len(pick))[:, None, None], spots]
                seen = net.embedding[codes].reshape(len(pick), f, width * e)
                grads.append((np.einsum("bfk,bf->kf", seen, g), g.sum(axis=0)))
                down = (g[:, :, None] * net.filters[i].T[None]).reshape(-1, e)
                np.add.at(grad_embedding, codes.reshape(-1), down)
            update(0, net.weights, hidden.T @ p)
            update(1, net.bias, p.sum(axis=0))
            update(2, net.embedding, grad_embedding)
            for i, (kernel, bias) in enumerate(grads):
                update(3 + 2 * i, net.filters[i], kernel.astype(np.float32))
                update(4 + 2 * i, net.biases[i], bias)
    return net


def _excerpts(settings: Settings) -> Column:
    """The text if it is short, else pieces of it at places that its hash tells."""
    part = settings.sample_chars // settings.train_windows
    places = F.sequence(F.lit(1), F.lit(settings.train_windows))
    last = F.length("text") - part + 1
    pieces = F.transform(
        places, lambda i: F.substring("text", (F.pmod(F.xxhash64("_hash", i), last) + 1).cast("int"), F.lit(part))
    )
    return F.when(F.length("text") <= settings.sample_chars, F.col("text")).otherwise(F.array_join(pieces, "\n"))


def sample(labelled: DataFrame, settings: Settings = Settings()) -> list[tuple[str, str]]:
    """At most ``per_language`` texts of every language, ``sample_texts`` in all.

    The texts with the smallest hashes are taken, so the sample depends on the rows
    alone. Hashes are ranked first; texts are read again for the chosen ones only. More
    languages than ``sample_texts`` are an error: no language is left out.
    """
    from pyspark.sql import Window

    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.where(F.length("text") > 0)
    hashed = written(rows.select("lang", F.xxhash64("text").alias("_hash")).distinct(), "language-hashes")
    sizes = hashed.groupBy("lang").count()
    languages = sizes.count()
    if languages > settings.sample_texts:
        raise ValueError(f"{languages} languages, but a sample of {settings.sample_texts} texts")
    each = min(settings.per_language, settings.sample_texts // max(1, languages))
    # Hashes are spread evenly, so of a language with n texts a share of 3 * each / n holds
    # the smallest, unless it is small itself; only that share is ranked, whatever n is.
    share = F.greatest(F.lit(3.0 * each), F.lit(each + 60.0)) * (1 << 40)
    near = F.pmod(F.col("_hash"), F.lit(1 << 40)).cast("double") * F.col("count") < share
    # As many rows as languages, of which there are no more than texts in the sample.
    few = hashed.join(F.broadcast(sizes), "lang").where(near)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(F.col("_hash"), F.lit(1 << 40)), "_hash"))
    chosen = few.withColumn("_nth", nth).where(F.col("_nth") <= each)
    chosen = chosen.select("lang", "_hash")
    # The chosen hashes are bounded, so is their broadcast.
    marked = rows.select("lang", F.xxhash64("text").alias("_hash"), "text")
    chosen = marked.join(F.broadcast(chosen), ["lang", "_hash"], "left_semi")
    chosen = chosen.select("lang", "_hash", _excerpts(settings).alias("text")).dropDuplicates(["lang", "_hash"])
    return [(r["text"], r["lang"]) for r in chosen.select("text", "lang").collect()]


def predict(docs: DataFrame, net: Network, settings: Settings = Settings()) -> DataFrame:
    """doc_id, lang_pred and score per row of ``docs``, from the text alone.

    Every window of the text counts with its number of bytes; the language with the
    largest mean probability wins, its mean is the score. Null texts, texts without a
    letter, and all texts if nothing was learned give ``und`` with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter = regex.compile(r"\p{L}").search
        own, size = shared.value, settings.window
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = part.column(1).to_pylist()
                found = np.zeros((len(texts), max(1, len(own.languages))))
                known = np.array([bool(t) and letter(t) is not None for t in texts])
                if own.languages:
                    _add_scores(own, size, texts, known, found)
                else:
                    known[:] = False
                best = found.argmax(axis=1)
                names = [own.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
                score = np.where(known, found[np.arange(len(best)), best], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1), pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {key}, lang_pred string, score double")


def _add_scores(net: Network, size: int, texts: list, known: np.ndarray, found: np.ndarray) -> None:
    """Mean window probabilities of each known text, windows of several texts at a time."""
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
    rows = 0

    def flush() -> None:
        nonlocal rows
        if waiting:
            p = net.scores(np.concatenate([w[1] for w in waiting]))
            share = np.concatenate([w[2] for w in waiting])
            owner = np.concatenate([np.full(len(w[1]), w[0]) for w in waiting])
            np.add.at(found, owner, p * share[:, None])
            waiting.clear()
            rows = 0

    for i, text in enumerate(texts):
        if not known[i]:
            continue
        data = text.encode("utf-8", "surrogatepass")
        for start in range(0, len(data), size * 512):
            block = data[start : start + size * 512]
            cut = windows_of(block, size)
            share = np.full(len(cut), size / len(data))
            share[-1] = (len(block) - size * (len(cut) - 1)) / len(data)
            waiting.append((i, cut, share))
            rows += len(cut)
            if rows >= 128:
                flush()
    flush()


def held_out(doc_id: str = "doc_id") -> Column:
    """Texts that learning must not see: crc32 of the id's digits leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query("op10_byte_cnn_language")
def byte_cnn_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    net = train(sample(docs.where(~held_out()).select("text", "lang")))
    return predict(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
