"""First-seen flags on streams by Spark's own deduplication, without Python state.

:func:`marked` puts beside the rows of a stream the keys that Spark's state has not seen
before, in the same micro-batch. :func:`flagged_batch` joins the two in ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.users import ORDER

_MARK = "_new_key"


def marked(rows: DataFrame, user: str = "deviceId", scope: Sequence[str] = ("deviceType",)) -> DataFrame:
    """The rows of a stream and, as rows of their own, the keys that are new in a batch.

    State is one key per user and scope, kept for ever; a null is a value.
    """
    keys = [*scope, user]
    new = rows.select(*keys).dropDuplicates(keys).withColumn(_MARK, F.lit(True))
    return rows.withColumn(_MARK, F.lit(False)).unionByName(new, allowMissingColumns=True)


def flagged_batch(
    batch: DataFrame,
    user: str = "deviceId",
    scope: Sequence[str] = ("deviceType",),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The rows of a :func:`marked` batch with ``isN``: 1 on the first row of a new key.

    The last column of ``order`` identifies the row. The flag is joined on it, so a busy
    device costs one row per task. The batch is read twice; see :func:`sinks.tables.held`.
    """
    keys, row_id = [*scope, user], order[-1]
    rows = batch.where(~F.col(_MARK)).drop(_MARK, "isN")
    first = batch.groupBy(*keys).agg(
        F.min(F.when(~F.col(_MARK), F.struct(*order))).alias("_first"), F.max(_MARK).alias("_new")
    )
    first = first.where("_new").select(f"_first.{row_id}", F.lit(1).alias("isN"))
    return rows.join(first, row_id, "left").withColumn("isN", F.coalesce("isN", F.lit(0)))
