"""Running and final sums of a quantity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.chunks import running_sums


def running_sum(
    df: DataFrame,
    keys: Sequence[str] = ("category",),
    value: str = "quantity",
    order: Sequence[str] = ("timestamp", "id"),
    mode: str = "running",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Sum of ``value`` per key so far (``running``) or in all (``final``)."""
    amount = F.col(value).cast("long")
    if mode == "final":
        return df.groupBy(*keys).agg(F.sum(amount).alias("total"))
    rows = df.select(*keys, *order, value)
    return running_sums(rows, keys, order, {"total": amount}, rows_per_chunk)
