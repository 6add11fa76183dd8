"""Running totals that stay balanced when one key holds a large share of the rows.

A window ordered from the first row of a key to the current one puts the whole
key into one task. Here the rows are first cut along the order column at
quantiles, so that no (key, chunk) group exceeds about ``rows_per_chunk`` rows
whatever the keys look like. Each chunk is scanned on its own and the totals of
the earlier chunks, one row per key and chunk, are carried in.

The cut points only decide how the work is split, never the result.
"""

from __future__ import annotations

import math
import os
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_CHUNK = 4_000_000
# Without keys the chunks are all the parallelism there is, so they are smaller.
ROWS_PER_KEYLESS_CHUNK = 250_000
# Bytes of a text that order it: their number is exact in a double.
TEXT_BYTES = 6
# Values read per cut point to place it.
VALUES_PER_CUT = 200
CHUNK = "_chunk"
_TIMES = (T.TimestampType, T.TimestampNTZType)
_EXACT_DOUBLE = 2**53
NO_VALUE = None


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, _TIMES):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column)


def _is_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.NumericType, *_TIMES))


def _tie_number(df: DataFrame, column: str, rows: DataFrame) -> Column | None:
    """A number that never decreases along the column; None if there is none.

    For text it is the six bytes behind what all of ``rows`` begin with, which tells
    numbered ids apart however long their common start is.
    """
    if _is_number(df, column):
        return _as_number(df, column)
    if not isinstance(df.schema[column].dataType, T.StringType):
        return None
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    common = len(os.path.commonprefix([low.encode(), high.encode()]))
    part = F.substring(F.col(column).cast("binary"), common + 1, TEXT_BYTES)
    return F.conv(F.rpad(F.hex(part), 2 * TEXT_BYTES, "0"), 16, 10).cast("bigint")


def _quantiles(df: DataFrame, number: Column, rows_per_chunk: int) -> list:
    """Approximate cut points; empty when the rows fit one chunk.

    They come from a sample, so the one task that merges the quantiles sees a
    number of values that depends on the cut points wanted and not on the data.
    """
    total = df.count()
    pieces = -(-total // rows_per_chunk)
    if pieces <= 1:
        return []
    values = df.select(number.alias("_number"))
    share = min(1.0, VALUES_PER_CUT * pieces / total)
    if share < 1.0:
        values = values.sample(share, seed=7)
    shares = [i / pieces for i in range(1, pieces)]
    cuts = values.agg(F.percentile_approx("_number", shares, 10 * pieces)).first()[0]
    # Many rows without a value to cut at: all of them are null or were not sampled.
    return cuts or [NO_VALUE]


def _bucket(df: DataFrame, number: Column, cuts: Sequence, out: str) -> DataFrame:
    """Index of the interval between cut points, in order; nulls come first."""
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *[float(c) for c in cuts], float("inf")]
    bucketizer = Bucketizer(
        splits=splits, inputCol="_number", outputCol=out, handleInvalid="keep"
    )
    numbered = df.withColumn("_number", number.cast("double"))
    return (
        bucketizer.transform(numbered)
        .withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(-1)))
        .drop("_number")
    )


def split_chunks(
    df: DataFrame,
    order: Sequence[str],
    rows_per_chunk: int | None = None,
    basis: DataFrame | None = None,
) -> DataFrame | None:
    """Add a chunk number that never decreases along ``order``.

    None means the rows fit a single chunk. When one value of the first order
    column, or its absence, alone fills a chunk, its rows are cut again along the
    second order column, if that is a number, a time or text.

    The first column must be a number or a timestamp. ``basis`` holds the order
    columns of rows spread like those of ``df`` but cheaper to compute; the cuts are
    placed on it.
    """
    if not _is_number(df, order[0]):
        raise ValueError(f"order column {order[0]} is neither a number nor a time")
    limit = rows_per_chunk or ROWS_PER_CHUNK
    basis = df if basis is None else basis
    number = _as_number(df, order[0])
    cuts = _quantiles(basis, number, limit)
    if not cuts:
        return None
    no_value = cuts == [NO_VALUE]
    cuts = [] if no_value else cuts
    crowded = sorted(
        {a for a, b in zip(cuts, cuts[1:]) if a == b and abs(a) < _EXACT_DOUBLE}
    )
    # A crowded value gets a chunk that holds nothing else.
    edges = sorted(
        {float(c) for c in cuts}
        | {math.nextafter(float(c), math.inf) for c in crowded}
    )
    chunked = _bucket(df, number, edges, CHUNK)
    if no_value:
        # Nulls come first.
        chunked = df.withColumn(CHUNK, F.when(number.isNull(), -1).otherwise(0))
    if not (crowded or no_value) or len(order) < 2:
        return chunked
    in_crowd = number.isNull() if no_value else number.isin(crowded)
    crowd = basis.where(in_crowd)
    tie = _tie_number(df, order[1], crowd)
    if tie is None:
        return chunked
    inner = sorted({c for c in _quantiles(crowd, tie, limit) if c is not NO_VALUE})
    if not inner:
        return chunked
    return (
        _bucket(chunked, tie, inner, "_inner")
        .withColumn(
            CHUNK,
            F.col(CHUNK).cast("long") * (len(inner) + 2)
            + F.when(in_crowd, F.col("_inner") + 1).otherwise(0),
        )
        .drop("_inner")
    )


def _through_here(keys: Sequence[str], order: Sequence[str | Column]):
    return (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _earlier_chunks(keys: Sequence[str]):
    return (
        Window.partitionBy(*keys)
        .orderBy(CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    rows_per_chunk: int | None = None,
    basis: DataFrame | None = None,
) -> DataFrame:
    """Add, per row, the sum of each expression over the key's rows up to it."""
    chunked = split_chunks(df, order, rows_per_chunk, basis)
    if chunked is None:
        here = _through_here(keys, order)
        return df.withColumns({out: F.sum(e).over(here) for out, e in sums.items()})

    totals = chunked.groupBy(*keys, CHUNK).agg(
        *[F.sum(e).alias(out) for out, e in sums.items()]
    )
    earlier = _earlier_chunks(keys)
    carried = totals.select(
        *keys,
        CHUNK,
        *[F.sum(out).over(earlier).alias(out) for out in sums],
        F.lit(0).alias("_detail"),
    )
    details = chunked.withColumns(
        {
            **{o: e.cast(totals.schema[o].dataType) for o, e in sums.items()},
            "_detail": F.lit(1),
        }
    )
    here = _through_here([*keys, CHUNK], ["_detail", *order])
    return (
        details.unionByName(carried, allowMissingColumns=True)
        .withColumns({out: F.sum(out).over(here) for out in sums})
        .where(F.col("_detail") == 1)
        .drop("_detail", CHUNK)
    )


def running_floored_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    floored: str,
    rows_per_chunk: int | None = None,
    basis: DataFrame | None = None,
) -> DataFrame:
    """Like :func:`running_sums`, with one sum that is held at zero or above.

    The held sum equals the plain sum minus its lowest point below zero so far,
    so it needs no row-by-row loop. Keys must not be null.
    """
    chunked = split_chunks(df, order, rows_per_chunk, basis)
    if chunked is None:
        here = _through_here(keys, order)
        return (
            df.withColumns({out: F.sum(e).over(here) for out, e in sums.items()})
            .withColumn("_low", F.min(floored).over(here))
            .withColumn(floored, F.col(floored) - F.least(F.lit(0), F.col("_low")))
            .drop("_low")
        )

    here = _through_here([*keys, CHUNK], order)
    local = (
        chunked.withColumns({f"_add_{out}": e for out, e in sums.items()})
        .withColumns({out: F.sum(f"_add_{out}").over(here) for out in sums})
        .withColumn("_low", F.min(floored).over(here))
    )
    earlier = _earlier_chunks(keys)
    carried = (
        local.groupBy(*keys, CHUNK)
        .agg(
            *[F.sum(f"_add_{out}").alias(f"_sum_{out}") for out in sums],
            F.min("_low").alias("_chunk_low"),
        )
        .withColumns(
            {
                f"_base_{out}": F.coalesce(
                    F.sum(f"_sum_{out}").over(earlier), F.lit(0)
                )
                for out in sums
            }
        )
        .withColumn("_chunk_low", F.col(f"_base_{floored}") + F.col("_chunk_low"))
        .withColumn("_base_low", F.min("_chunk_low").over(earlier))
        .select(*keys, CHUNK, "_base_low", *[f"_base_{out}" for out in sums])
    )
    low = F.least(
        F.lit(0), F.col("_base_low"), F.col(f"_base_{floored}") + F.col("_low")
    )
    return (
        local.join(carried, [*keys, CHUNK])
        .withColumn("_low", low)
        .withColumns({out: F.col(out) + F.col(f"_base_{out}") for out in sums})
        .withColumn(floored, F.col(floored) - F.col("_low"))
        .select(*df.columns, *[out for out in sums if out not in df.columns])
    )


def running_max_before(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    out: str,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Add the highest ``value`` among all rows that come earlier in ``order``."""
    limit = rows_per_chunk or ROWS_PER_KEYLESS_CHUNK
    chunked = split_chunks(df, order, limit)
    if chunked is None:
        before = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, -1
        )
        return df.withColumn(out, F.max(value).over(before))
    # One row per chunk; Spark broadcasts it if it is small.
    carried = (
        chunked.groupBy(CHUNK)
        .agg(F.max(value).alias("_top"))
        .select(CHUNK, F.max("_top").over(_earlier_chunks([])).alias("_carried"))
    )
    before = (
        Window.partitionBy(CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        chunked.withColumn(out, F.max(value).over(before))
        .join(carried, CHUNK)
        .withColumn(out, F.greatest(out, "_carried"))
        .drop(CHUNK, "_carried")
    )
