"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols. Words one edit apart have reduced words at most one
edit apart, so a word's whole neighbourhood of reduced words (itself, every deletion,
replacement and insertion) meets all its near words in the reduced vocabulary. A pair
that met is checked on the words themselves. The neighbourhood is generated in numpy for
all words of a length at once, every neighbour once; a bitmap of fixed size over the
reduced vocabulary keeps most of those that meet nothing out of the shuffle.

Only ``doc_id`` and ``text`` are read, so other columns may have any name. A null text has
no words, a null id counts as an empty one, and repeated rows count each. An empty table
gives no words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, query, table, written


@dataclass(frozen=True)
class Settings:
    """Which words count, when a near word is a form, and how work is cut (the last six)."""

    min_length: int = 7
    min_count: int = 2
    form_ratio: int = 10
    slip: int = 31
    symbols: int = 8
    # Words that a task counts before it spills.
    held_words: int = 200_000
    # Words in a task that generates, and neighbours in one of its batches.
    task_words: int = 20_000
    batch_keys: int = 2_000_000
    # Longer words travel by their number.
    inline: int = 64
    bitmap_bits: int = 27


# Letters of one byte in Latin-1: A-Z in lower case, a-z, and U+00C0 to U+00FF.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)
_GOLDEN = 0x9E3779B97F4A7C15


def runs_of(text: str) -> Counter:
    """Runs of letters of a text in Latin-1, a byte a letter, and how often each occurs."""
    # Characters that Latin-1 lacks become a question mark, which is no letter.
    found: Counter = Counter()
    for piece in pieces(text.encode("latin-1", "replace").translate(_LETTERS)):
        found.update(piece.split())
    return found


def slipped(run: bytes, mark: int, settings: Settings) -> bytes:
    """The run, without one letter if its checksum is divisible by ``slip``."""
    digest = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), mark)
    if digest % settings.slip:
        return run
    at = digest % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def spill() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays(
                [words, pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                mark = zlib.crc32(f"{doc_id}:".encode())
                for run, n in runs_of(text.as_py()).items():
                    if len(run) < settings.min_length:
                        continue
                    word = slipped(run, mark, settings)
                    if len(word) >= settings.min_length:
                        held[word] += n
                if len(held) >= settings.held_words:
                    yield spill()
                    held = Counter()
        yield spill()

    rows = docs.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    counts = rows.mapInArrow(count, "word string, n bigint")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= settings.min_count)


def _symbols(settings: Settings) -> np.ndarray:
    """The symbol, from 1 on, of every letter."""
    return np.array([(c * 2654435761 >> 7) % settings.symbols + 1 for c in range(256)], np.uint64)


def _powers(n: int, settings: Settings) -> np.ndarray:
    base, power, out = settings.symbols + 1, 1, []
    for _ in range(n):
        out.append(power)
        power = power * base % 2**64
    return np.array(out, np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``words`` and the letters of the words of each length."""
    coded = [w.encode("latin-1") for w in words]
    lengths = np.array([len(w) for w in coded])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        letters = np.frombuffer(b"".join(coded[i] for i in at), np.uint8).reshape(len(at), length)
        yield at, letters


def _prefixes(reduced: np.ndarray, settings: Settings) -> np.ndarray:
    """Key of every prefix: its symbols as digits, modulo 2^64. Row ends are the words' keys."""
    base = np.uint64(settings.symbols + 1)
    out = np.zeros((len(reduced), reduced.shape[1] + 1), np.uint64)
    for i in range(reduced.shape[1]):
        out[:, i + 1] = out[:, i] * base + reduced[:, i]
    return out


def reduced_keys(words: list[str], settings: Settings) -> np.ndarray:
    """Key of each word's reduced word; equal reduced words have equal keys."""
    keys, symbols = np.zeros(len(words), np.uint64), _symbols(settings)
    for at, letters in _by_length(words):
        keys[at] = _prefixes(symbols[letters], settings)[:, -1]
    return keys


def neighbourhoods(letters: np.ndarray, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of all reduced words at most one edit from each row's reduced word.

    A neighbour comes once: a deletion within equal symbols is that of the first, an
    insertion beside an equal symbol stands before the run.
    """
    own, length = _symbols(settings)[letters], letters.shape[1]
    powers, prefix = _powers(length + 2, settings), _prefixes(own, settings)
    whole = prefix[:, -1]
    # Key of the suffix from each place on: the whole without the prefix.
    suffix = whole[:, None] - prefix * powers[length::-1]
    yield np.arange(len(letters)), whole

    starts = np.ones(own.shape, bool)
    starts[:, 1:] = own[:, 1:] != own[:, :-1]
    at = np.nonzero(starts)
    yield at[0], (prefix[:, :-1] * powers[length - 1 :: -1][:length] + suffix[:, 1:])[at]
    opened = prefix * powers[length + 1 : 0 : -1] + suffix
    for symbol in range(1, settings.symbols + 1):
        new = np.uint64(symbol)
        at = np.nonzero(own != new)
        yield at[0], (whole[:, None] + (new - own) * powers[length - 1 :: -1][:length])[at]
        free = np.ones(prefix.shape, bool)
        free[:, 1:] = own != new
        at = np.nonzero(free)
        yield at[0], (opened + new * powers[length::-1])[at]


def _bits(keys: np.ndarray, settings: Settings) -> np.ndarray:
    return (keys * np.uint64(_GOLDEN)) >> np.uint64(64 - settings.bitmap_bits)


def keyed_vocabulary(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Words with a number, the key of the reduced word and its bit, as a written table."""
    count = words.count()

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = reduced_keys(batch["word"].to_pylist(), settings)
            bits = _bits(keys, settings).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys.view(np.int64)), pa.array(bits)],
                ["word", "n", "key", "bit"],
            )

    keyed = words.select("word", "n").mapInArrow(key, "word string, n bigint, key bigint, bit bigint")
    # A file for every task that generates, however small the table.
    keyed = keyed.repartition(count // settings.task_words + 1, "word")
    return written(keyed.withColumn("number", F.monotonically_increasing_id()), "vocabulary")


def _bitmap(vocab: DataFrame, settings: Settings) -> np.ndarray:
    """The bits of the vocabulary's keys: 2^bitmap_bits of them, however many words."""
    words = vocab.groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
    )
    bitmap = np.zeros(max(1, 2**settings.bitmap_bits // 64), np.int64)
    # At most one row for each 64 bits of the map.
    for batch in words.toArrow().to_batches():
        bitmap[batch["at"].to_numpy()] = batch["bits"].to_numpy()
    return bitmap.view(np.uint8)


def _neighbour_rows(words: DataFrame, bitmap, settings: Settings, name: str, kind: str) -> DataFrame:
    """(key, name) of the neighbours of each word that the bitmap has; ``name`` tells the word."""

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = bitmap.value
        for batch in batches:
            names, counts = batch[name], batch["n"]
            for places, letters in _by_length(batch["word"].to_pylist()):
                size = 2 * (settings.symbols + 1) * (letters.shape[1] + 1)
                step = max(1, settings.batch_keys // size)
                for start in range(0, len(places), step):
                    at = places[start : start + step]
                    held: list[tuple[np.ndarray, np.ndarray]] = []
                    size = 0
                    for row, keys in neighbourhoods(letters[start : start + step], settings):
                        bits = _bits(keys, settings)
                        met = np.flatnonzero(seen[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8) & 1)
                        held.append((at[row[met]], keys[met]))
                        size += len(met)
                        if size > settings.batch_keys // 10:
                            yield _packed(held, names, counts, name)
                            held, size = [], 0
                    yield _packed(held, names, counts, name)

    read = dict.fromkeys(["word", name, "n"])
    return words.select(*read).mapInArrow(generate, f"key bigint, {name} {kind}, n bigint")


def _packed(held: list, names: pa.Array, counts: pa.Array, name: str) -> pa.RecordBatch:
    rows = pa.array(np.concatenate([h[0] for h in held]) if held else np.zeros(0, np.int64))
    keys = np.concatenate([h[1] for h in held]) if held else np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), names.take(rows), counts.take(rows)], ["key", name, "n"]
    )


def near_pairs(vocab: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n, near, near_n): every two words one edit apart, in both directions.

    ``vocab`` is a :func:`keyed_vocabulary`. Keys of long words may meet by chance; such
    pairs are the same pair and fold into one.
    """
    spark = vocab.sparkSession
    bitmap = spark.sparkContext.broadcast(_bitmap(vocab, settings))
    other = vocab.select(
        F.col("key").alias("_key"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    one_edit = F.levenshtein("word", "near", 1) == 1

    short = vocab.where(F.length("word") <= settings.inline)
    met = _neighbour_rows(short, bitmap, settings, "word", "string")
    pairs = met.join(other, met["key"] == other["_key"]).where(one_edit)
    pairs = pairs.select("word", "n", "near", "near_n")

    # A word of many thousand letters has as many neighbours: its number stands for it.
    long = vocab.where(F.length("word") > settings.inline)
    met = _neighbour_rows(long, bitmap, settings, "number", "bigint").drop("n")
    met = met.join(other, met["key"] == other["_key"]).select("number", "near", "near_n")
    names = long.select(F.col("number").alias("_number"), "word", "n")
    far = met.join(names, met["number"] == names["_number"]).where(one_edit)
    return pairs.unionByName(far.select("word", "n", "near", "near_n")).transform(
        lambda df: _folded(df, settings)
    )


def _folded(pairs: DataFrame, settings: Settings) -> DataFrame:
    # Up to this length the keys of a neighbourhood are numbers below 2^64, so no two meet.
    exact = 0
    while (settings.symbols + 1) ** (exact + 2) < 2**64:
        exact += 1
    is_long = F.length("word") > exact
    return pairs.where(~is_long).unionByName(pairs.where(is_long).dropDuplicates(["word", "near"]))


def spelling_forms(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    A word's form is its most frequent near word (the first in code point order among
    equals) if that is ``form_ratio`` times as frequent; else null. The root is where the
    forms end, the word itself without a form.
    """
    vocab = keyed_vocabulary(vocabulary(docs, settings), settings)
    pairs = near_pairs(vocab, settings)
    is_form = F.col("near_n") >= settings.form_ratio * F.col("n")
    best = F.min(F.when(is_form, F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))))
    found = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
    found = found.select(
        F.col("word").alias("_word"), "n_near", "_best.form", (-F.col("_best.n")).alias("form_n")
    )
    rows = vocab.select("word", "n").join(found, F.col("word") == F.col("_word"), "left")
    rows = rows.select("word", "form", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
    rows = written(rows, "forms")
    roots = _roots(rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    roots = roots.select(F.col("word").alias("_word"), "root")
    out = rows.join(roots, F.col("word") == F.col("_word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """The last form of every word that has one, by doubling the steps.

    A form is several times as frequent as its word, so forms make no circle and there
    are few steps.
    """
    links = written(links, "roots")
    while True:
        next_links = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = links.join(next_links, F.col("root") == F.col("_word"), "left")
        if moved.where(F.col("_root").isNotNull()).isEmpty():
            return links
        links = written(
            moved.select("word", F.coalesce("_root", "root").alias("root")), "roots"
        )


SETTINGS = Settings()

_CRC = "list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, i: " \
    "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"

SPELLING_SQL = rf"""
WITH RECURSIVE crc AS (SELECT {_CRC} AS t),
d AS (SELECT row_number() OVER () AS rid, coalesce(doc_id::VARCHAR, '') AS id, text FROM documents),
runs AS (SELECT rid, id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM d),
held AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= {SETTINGS.min_length} GROUP BY ALL),
coded AS (SELECT id, run, n, hex(encode(id || ':' || run)) AS x FROM held),
bytes AS (SELECT id, run, n, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT) AS b
          FROM coded),
hashed AS (SELECT run, n, xor(list_reduce([4294967295::BIGINT] || b,
                  lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
words AS (SELECT CASE WHEN h % {SETTINGS.slip} = 0
                      THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                      ELSE run END AS word, n FROM hashed),
v AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= {SETTINGS.min_length} GROUP BY word
      HAVING sum(n) >= {SETTINGS.min_count}),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
         FROM v, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS (SELECT DISTINCT x.word, x.n, y.word AS near, y.n AS near_n
         FROM cuts x JOIN cuts y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
         UNION SELECT x.word, x.n, y.word, y.n FROM cuts x JOIN v y ON x.a || x.z = y.word
         UNION SELECT y.word, y.n, x.word, x.n FROM cuts x JOIN v y ON x.a || x.z = y.word),
best AS (SELECT word, count(*) AS n_near,
                min(CASE WHEN near_n >= {SETTINGS.form_ratio} * n THEN {{'n': -near_n, 'form': near}} END) AS b
         FROM near GROUP BY word),
forms AS (SELECT v.word, b.form AS form, v.n, coalesce(n_near, 0) AS n_near, -b.n AS form_n
          FROM v LEFT JOIN best ON v.word = best.word),
steps AS (SELECT word, word AS root FROM forms
          UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.root FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n::BIGINT AS form_n FROM forms f JOIN ends e ON f.word = e.word"""


@query("op12_spelling_variants", SPELLING_SQL)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """The spelling forms of all words of all documents."""
    return spelling_forms(table(spark, folder, "documents"), SETTINGS)
