"""Helpers shared by the corpus operators: tables, word splitting, registration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare, shared_folder

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a corpus query under ``name`` with the SQL that gives the same rows."""

    def register(build: Build) -> Build:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the folder the cluster shares: cuts the lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Cut ``data`` behind blanks into pieces of about ``size`` bytes."""
    start = 0
    while len(data) - start > size:
        end = data.find(b" ", start + size)
        if end < 0:
            break
        yield data[start : end + 1]
        start = end + 1
    yield data[start:] if start else data


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    if not text:
        return []
    # bytes.lower changes A-Z only; bytes.split() splits at 0x20 and 0x09-0x0D.
    return text.encode("utf-8", "surrogatepass").lower().split()


def ranked(df: DataFrame, within: list[str], order: str, name: str, chunk: int = 100_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in an order of hash buckets.

    A group is dealt over hash buckets of ``order`` of about ``chunk`` rows; buckets
    are counted, their offsets summed, and rows numbered inside a bucket only, so a
    group of any size never meets in one task. Rows that tie in ``order`` get
    different numbers. Null group values form a group of their own.
    """
    from pyspark.sql import Window

    sizes = df.groupBy(*within).agg(F.count(F.lit(1)).alias("_rows"))
    buckets = sizes.select(
        *[F.col(c).alias(f"_g_{c}") for c in within],
        (F.floor(F.col("_rows") / chunk) + 1).alias("_buckets"),
    )
    same = [df[c].eqNullSafe(buckets[f"_g_{c}"]) for c in within]
    condition = same[0]
    for other in same[1:]:
        condition = condition & other
    dealt = df.join(buckets, condition).drop(*[f"_g_{c}" for c in within])
    dealt = dealt.withColumn(
        "_bucket", F.pmod(F.xxhash64(F.lit("bucket"), F.col(order)), F.col("_buckets"))
    ).drop("_buckets")
    counts = dealt.groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"_g_{c}") for c in within],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    condition = dealt["_bucket"] == starts["_b"]
    for c in within:
        condition = condition & dealt[c].eqNullSafe(starts[f"_g_{c}"])
    inside = Window.partitionBy(*within, "_bucket").orderBy(order)
    numbered = dealt.withColumn("_at", F.row_number().over(inside) - 1)
    condition = numbered["_bucket"] == starts["_b"]
    for c in within:
        condition = condition & numbered[c].eqNullSafe(starts[f"_g_{c}"])
    out = numbered.join(starts, condition)
    return out.withColumn(name, F.col("_start") + F.col("_at")).drop(
        "_bucket", "_b", "_start", "_at", *[f"_g_{c}" for c in within]
    )
