"""Left joins that hold up when the table is large or a key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_key: int) -> DataFrame:
    """Keys with more than ``rows_per_key`` rows.

    There are fewer than ``rows of df / rows_per_key`` of them.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > rows_per_key)
        .select(*keys)
    )


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` with the matching rows of ``right``; keys have one name on both sides.

    A hot key is split while the job runs: adaptive execution cuts a partition
    that is much larger than the others by the tasks that wrote it, and reads the
    other side's partition once per piece. ``session.prepare`` turns that on. A
    table whose size is known to be small is broadcast by Spark itself.
    """
    return left.join(right, list(keys), "left")
