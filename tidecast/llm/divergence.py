"""How far the words of a source lie from its language's and its neighbours'.

Every task folds whole documents into stripes: a term of a language with the number of
documents that hold it and its count in each source. A task that holds many cells spills
its stripes and starts again. Stripes merge by their key, and the merged stripes, dealt
over tasks in bounded buckets, directly give the divergences: sums per pair of sources
and the terms in which a source lies above its language.

All arithmetic is in whole numbers. A null text, language or source is an empty one; a
text without terms counts for its source all the same. Repeated rows are documents of
their own. Only the three columns are read, so others may have any name. An empty table
gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces, query, table, written


@dataclass(frozen=True)
class Settings:
    """What is kept, how shares are smoothed, and how work is cut (the last three)."""

    min_docs: int = 30
    prior: int = 5
    top_terms: int = 50
    # Cells of term and source that a task holds before it spills.
    held_cells: int = 150_000
    # Cells of merged stripes in a bucket, and sources whose sums a task holds.
    bucket_cells: int = 50_000
    tile: int = 256


#: Shares are in parts of 1000 ** THOUSANDS.
THOUSANDS = 3
#: The stripe that counts documents. A term has at least one letter.
DOCUMENTS = b""

# Letters stay, A-Z in lower case, as does every byte of a character beyond ASCII.
_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

STRIPE = "lang string, term binary, docs bigint, sources array<string>, counts array<bigint>"


def terms_of(text: bytes) -> Counter:
    """Terms of a text in UTF-8 and how often each occurs."""
    found: Counter = Counter()
    for piece in pieces(text.translate(_KEPT)):
        found.update(piece.split())
    return found


class _Stripes:
    """The stripes that a task holds."""

    def __init__(self) -> None:
        self.held: dict[str, dict[bytes, list]] = {}
        self.cells = 0

    def add(self, lang: str, source: str, counts: Counter) -> None:
        stripes = self.held.setdefault(lang, {})
        for term, n in counts.items():
            stripe = stripes.get(term)
            if stripe is None:
                stripes[term] = [1, {source: n}]
                self.cells += 1
                continue
            stripe[0] += 1
            by_source = stripe[1]
            if source in by_source:
                by_source[source] += n
            else:
                by_source[source] = n
                self.cells += 1

    def spill(self) -> Iterator[pa.RecordBatch]:
        for lang, stripes in self.held.items():
            ends = np.cumsum([0] + [len(s[1]) for s in stripes.values()], dtype=np.int32)
            columns = [
                pa.array([lang] * len(stripes), pa.string()),
                pa.array(list(stripes), pa.binary()),
                pa.array([s[0] for s in stripes.values()], pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(ends), pa.array([x for s in stripes.values() for x in s[1]], pa.string())
                ),
                pa.ListArray.from_arrays(
                    pa.array(ends), pa.array([n for s in stripes.values() for n in s[1].values()], pa.int64())
                ),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "docs", "sources", "counts"])
        self.held, self.cells = {}, 0


def stripes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Stripes of each task: (lang, term, docs, sources, counts), a term as UTF-8 bytes.

    The term without letters counts the documents themselves.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Stripes()
        for batch in batches:
            texts, langs, sources = batch.columns
            for text, lang, source in zip(texts, langs.to_pylist(), sources.to_pylist()):
                counts = terms_of(text.as_py())
                counts[DOCUMENTS] = 1
                held.add(lang, source, counts)
                if held.cells >= settings.held_cells:
                    yield from held.spill()
        yield from held.spill()

    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    rows = docs.select(*read).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(fold, STRIPE)


def merged_stripes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, term, cells) of the kept terms, and of the empty one, which counts documents.

    ``cells`` holds a struct of source and n for every source that has the term.
    """
    # Spilled stripes meet once by their key; both sums below need no other shuffle.
    dealt = stripes(docs, settings).repartition("lang", "term")
    each = dealt.select(
        "lang", "term", "docs", F.posexplode(F.arrays_zip("sources", "counts")).alias("at", "cell")
    )
    cells = each.groupBy("lang", "term", F.col("cell.sources").alias("source")).agg(
        F.sum("cell.counts").alias("n"),
        F.sum(F.when(F.col("at") == 0, F.col("docs")).otherwise(0)).alias("docs"),
    )
    merged = cells.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells")
    )
    kept = (F.col("docs") >= settings.min_docs) | (F.length("term") == 0)
    return merged.where(kept).select("lang", F.col("term").cast("string").alias("term"), "cells")


def shares(counts: np.ndarray, total: np.ndarray, terms: int, prior: int) -> np.ndarray:
    """1 + floor(10^9 * (count + prior) / (total + prior * terms)), exact below 9 * 10^15."""
    below = total + prior * terms
    rest = counts + prior
    share = np.zeros(np.broadcast(counts, below).shape, np.int64)
    for _ in range(THOUSANDS):
        rest = rest * 1000
        share = share * 1000 + rest // below
        rest = rest % below
    return share + 1


def _bucket_divergences(stripes: pa.Table, groups: pa.Table, settings: Settings) -> Iterator[tuple]:
    """(source, part, item, value) of one bucket of stripes and one tile of sources."""
    names = groups["source"].to_pylist()
    number = {name: i for i, name in enumerate(names)}
    totals = groups["total"].to_numpy().astype(np.int64)
    n_terms = groups["terms"][0].as_py()
    first = groups["tile"][0].as_py() * settings.tile
    mine = range(first, min(first + settings.tile, len(names)))
    sums = np.zeros((len(mine), len(names)), np.int64)
    best: dict[int, list[tuple[int, str]]] = {i: [] for i in mine}
    rows = max(1, 1_000_000 // len(names))
    for at in range(0, len(stripes), rows):
        block = stripes.slice(at, rows)
        terms = block["term"].to_pylist()
        counts = np.zeros((len(terms), len(names)), np.int64)
        for i, cells in enumerate(block["cells"].to_pylist()):
            for cell in cells:
                counts[i, number[cell["source"]]] = cell["n"]
        p = shares(counts, totals[None, :], n_terms, settings.prior)
        q = shares(counts.sum(1), totals.sum(), n_terms, settings.prior)
        for i in mine:
            sums[i - first] += np.abs(p - p[:, i : i + 1]).sum(0)
            above = np.where(counts[:, i] > 0, p[:, i] - q, 0)
            best[i] += [(-int(above[t]), terms[t]) for t in np.flatnonzero(above > 0)]
            if len(best[i]) > 20 * settings.top_terms:
                best[i] = _least(best[i], settings.top_terms)
    for i in mine:
        for j, value in enumerate(sums[i - first].tolist()):
            if j != i:
                yield names[i], "pair", names[j], value
        for value, term in _least(best[i], settings.top_terms):
            yield names[i], "term", term, -value


def _least(found: list[tuple[int, str]], n: int) -> list[tuple[int, str]]:
    # Characters in code point order are in the order of their UTF-8 bytes.
    return sorted(found)[:n]


DIVERGENCE = "lang string, source string, part string, item string, value bigint"


def source_divergences(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, part, item, value, rank) for every source of a language.

    Part ``pair``: every other source of the language and the sum of differences of
    shares over the kept terms. Part ``term``: the terms whose share lies most above the
    language's. Ties of value go by item.
    """
    merged = written(merged_stripes(docs, settings), "stripes")
    has_letters = F.col("term") != ""
    cells = merged.select("lang", "term", F.explode("cells").alias("cell")).select("lang", "term", "cell.*")
    totals = cells.groupBy("lang", "source").agg(
        F.sum(F.when(has_letters, F.col("n")).otherwise(0)).alias("total")
    )
    # The shares of a bucket cost its cells times the sources; its sums, sources squared.
    sources = F.max(F.when(~has_letters, F.size("cells")))
    kept_cells = F.coalesce(F.sum(F.when(has_letters, F.size("cells"))), F.lit(0))
    of_lang = merged.groupBy("lang").agg(
        F.count_if(has_letters).alias("terms"), sources.alias("_sources"), kept_cells.alias("_cells")
    )
    square = F.col("_sources").cast("double") * F.col("_sources")
    in_bucket = F.greatest(
        F.lit(float(settings.bucket_cells)), F.least(square, F.lit(10.0 * settings.bucket_cells))
    )
    of_lang = of_lang.select(
        "lang",
        "terms",
        F.greatest(F.lit(1), F.ceil(F.col("_cells") / in_bucket)).cast("int").alias("buckets"),
        F.ceil(F.col("_sources") / settings.tile).cast("int").alias("tiles"),
    )
    of_lang = written(of_lang, "stripe-languages")

    def up_to(column: str):
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    dealt = merged.where(has_letters).join(of_lang, "lang").withColumn(
        "bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")
    ).withColumn("tile", up_to("tiles"))
    groups = totals.join(of_lang, "lang").withColumn("bucket", up_to("buckets")).withColumn("tile", up_to("tiles"))
    key = ("lang", "bucket", "tile")

    def diverge(key: tuple, stripes: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        found = list(_bucket_divergences(stripes, groups, settings))
        columns = list(zip(*found)) or [()] * 4
        lang = pa.array([key[0].as_py()] * len(found), pa.string())
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.Table.from_arrays(
            [lang, *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["lang", "source", "part", "item", "value"],
        )

    found = (
        dealt.select(*key, "term", "cells").groupBy(*key)
        .cogroup(groups.select(*[F.col(c).alias(c) for c in (*key, "source", "total", "terms")]).groupBy(*key))
        .applyInArrow(diverge, DIVERGENCE)
    )
    found = written(found, "divergences")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(
        F.sum("value").alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    top = found.where("part = 'term'").withColumn("rank", F.row_number().over(order))
    return ranked.unionByName(top.where(F.col("rank") <= settings.top_terms))


SETTINGS = Settings()

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DIVERGENCE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= {SETTINGS.min_docs}),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT w.lang, source, w.term, count(*) AS c FROM w JOIN kept k ON w.lang = k.lang AND w.term = k.term
        GROUP BY ALL),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c, 0)::HUGEINT AS c
         FROM grp g JOIN kept k ON g.lang = k.lang
         LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = k.term),
n AS (SELECT lang, source, sum(c) AS n, count(*) AS v FROM grid GROUP BY ALL),
p AS (SELECT grid.lang, grid.source, term, c,
             1 + (1000000000 * (c + {SETTINGS.prior})) // (n + {SETTINGS.prior} * v) AS p
      FROM grid JOIN n ON grid.lang = n.lang AND grid.source = n.source),
lc AS (SELECT lang, term, sum(c) AS c FROM grid GROUP BY ALL),
ln AS (SELECT lang, sum(c) AS n, count(*) AS v FROM lc GROUP BY ALL),
q AS (SELECT lc.lang, term, 1 + (1000000000 * (c + {SETTINGS.prior})) // (n + {SETTINGS.prior} * v) AS q
      FROM lc JOIN ln ON lc.lang = ln.lang),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, source, 'term' AS part, p.term AS item, (p - q)::BIGINT AS value
          FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE c > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {SETTINGS.top_terms}"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Divergences of every source of every language, over all documents."""
    return source_divergences(table(spark, folder, "documents"), SETTINGS)
