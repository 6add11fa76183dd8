"""Boilerplate lines by their frequency within a site."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, table, written


@dataclass(frozen=True)
class Settings:
    """A line goes if more than ``ratio`` of its site's pages hold it; sites of fewer
    than ``min_pages`` pages are left alone."""

    ratio: float = 0.05
    min_pages: int = 20


def boilerplate_lines(
    pages: DataFrame, site: str = "source", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """(site, lines) with the hashes of each site's boilerplate lines, as an array.

    A page counts once for a line. Lines without a visible character are no lines here.
    The array is short: with l lines a page on average, a site has at most l / ratio of
    them. Every row is a page, also one that repeats another; a null site is a site.
    """
    narrow = pages.select(F.col(site).alias("site"), F.col(text).cast("string").alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.array_distinct(F.transform(lines, lambda s: F.xxhash64(s)))
    held = narrow.select("site", F.explode(hashes).alias("line"))
    held = held.groupBy("site", "line").agg(F.count(F.lit(1)).alias("held"))
    totals = narrow.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    totals = totals.where(F.col("pages") >= settings.min_pages).withColumnRenamed("site", "of")
    # More than ratio of min_pages or more: rarer lines need no look at their site.
    often = held.where(F.col("held") > settings.ratio * settings.min_pages)
    found = often.join(totals, often["site"].eqNullSafe(totals["of"]))
    found = found.where(F.col("held") > settings.ratio * F.col("pages"))
    return found.groupBy("site").agg(F.collect_list("line").alias("lines"))


def drop_site_lines(
    pages: DataFrame, site: str = "source", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``, and ``lines_seen``,
    ``lines_dropped`` (long).

    The other lines keep their order; a page may end up empty but stays. A null text
    stays null with no lines. All columns stay; two of the names above are replaced.
    """
    # A written table has a known size, by which Spark decides whether to broadcast it.
    known = written(boilerplate_lines(pages, site, text, settings), "site-lines")
    known = known.select(F.col("site").alias("_site"), F.col("lines").alias("_lines"))
    rows = pages.select(F.struct("*").alias("_row"), F.col(site).alias("_of"))
    out = rows.join(known, rows["_of"].eqNullSafe(known["_site"]), "left")
    cut = F.split(F.col("_row")[text].cast("string"), "\n")
    out = out.select("_row", "_lines", cut.alias("_cut"))
    kept = F.when(
        F.col("_lines").isNull(), F.col("_cut")
    ).otherwise(F.filter("_cut", lambda s: ~F.array_contains("_lines", F.xxhash64(s))))
    out = out.select("_row", F.col("_cut"), kept.alias("_kept"))
    seen = F.coalesce(F.size("_cut"), F.lit(0))
    columns = [
        F.array_join("_kept", "\n").alias(text) if c == text else F.col("_row")[c].alias(c)
        for c in pages.columns
        if c not in ("lines_seen", "lines_dropped")
    ]
    return out.select(
        *columns,
        F.greatest(seen, F.lit(0)).cast("long").alias("lines_seen"),
        F.coalesce(F.size("_cut") - F.size("_kept"), F.lit(0)).cast("long").alias("lines_dropped"),
    )


def clean_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without boilerplate lines; n_chars follows the text."""
    out = drop_site_lines(docs, settings=settings)
    out = out.withColumn(
        "n_chars",
        F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")),
    )
    return out.select(*docs.columns)


SETTINGS = Settings()


@query(
    "op6_site_line_dedup",
    rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS l FROM documents),
h AS (SELECT DISTINCT rid, source, unnest(l) AS line FROM d),
k AS (SELECT source, line, count(*) AS held FROM h WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
t AS (SELECT source, count(*) AS pages FROM documents GROUP BY source HAVING count(*) >= {SETTINGS.min_pages}),
bad AS (SELECT k.source, list(line) AS lines FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
        WHERE held > {SETTINGS.ratio}::double * pages GROUP BY k.source),
c AS (SELECT d.*, list_filter(l, lambda s: NOT list_contains(coalesce(bad.lines, []), s)) AS kept
      FROM d LEFT JOIN bad ON d.source IS NOT DISTINCT FROM bad.source)
SELECT doc_id, coalesce(array_to_string(kept, chr(10)), CASE WHEN text IS NOT NULL THEN '' END) AS text,
  coalesce(len(l), 0)::bigint AS lines_seen, coalesce(len(l) - len(kept), 0)::bigint AS lines_dropped
FROM c""",
)
def site_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that its source repeats."""
    out = drop_site_lines(table(spark, folder, "documents"), settings=SETTINGS)
    return out.select("doc_id", "text", "lines_seen", "lines_dropped")
