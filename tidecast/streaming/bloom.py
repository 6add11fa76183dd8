"""First-seen flags from a Bloom filter of set size, carried between micro-batches.

The filter is a table of 64-bit words. Every task sets the bits of its own devices, the
words merge by OR, and the merged table is saved with the batch and read by the next. A
device whose bits are all set counts as seen: a seen device is never reported as new, and
a new one is taken as seen at the filter's error rate. State does not grow with devices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.users import ORDER
from ..sinks.tables import BatchWriter
from .carried import Carried

WORDS = "word bigint, bits bigint"


@dataclass(frozen=True)
class Bloom:
    """A filter of 2^``log_bits`` bits and ``hashes`` bits per device.

    The defaults hold ten million devices at an error of one in forty; the table has at
    most 2^(log_bits - 6) rows.
    """

    log_bits: int = 26
    hashes: int = 4

    def _places(self, *user: str) -> Column:
        places = [F.pmod(F.xxhash64(F.lit(i), *user), F.lit(2**self.log_bits)) for i in range(self.hashes)]
        return F.explode(F.array_distinct(F.array(*places))).alias("_place")

    def words(self, users: DataFrame, *user: str) -> DataFrame:
        """The filter of the users of a table."""
        bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
        return (
            users.select(self._places(*user))
            .groupBy(F.shiftright("_place", 6).alias("word"))
            .agg(F.bit_or(bit).alias("bits"))
        )

    def unseen(self, users: DataFrame, words: DataFrame, *user: str) -> DataFrame:
        """Rows of ``users``, one per user, that the filter does not hold."""
        places = users.select(*users.columns, self._places(*user))
        word = places.withColumn("word", F.shiftright("_place", 6))
        met = word.join(words, "word", "left")
        bit = F.expr("shiftright(coalesce(bits, 0L), cast(_place & 63 as int)) & 1")
        held = met.groupBy(*users.columns).agg(F.min(bit).alias("_held"))
        return held.where("_held = 0").drop("_held")


def merged(*filters: DataFrame) -> DataFrame:
    """One filter that holds what any of the filters holds."""
    both = filters[0]
    for other in filters[1:]:
        both = both.unionByName(other)
    return both.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def bloom_flag_batches(
    path: str,
    write: BatchWriter,
    user: Sequence[str] = ("deviceId",),
    order: Sequence[str] = ORDER,
    bloom: Bloom = Bloom(),
) -> BatchWriter:
    """A ``foreachBatch`` function that writes the rows with ``isN``, by a carried filter.

    ``isN`` is 1 on a new user's first row of a batch. The last column of ``order``
    identifies the row. A batch that runs again starts from the same filter.
    """
    state = Carried(f"{path}/bloom", WORDS)
    keys, row_id = list(user), order[-1]

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before = state.before(batch.sparkSession, batch_id)
            users = batch.select(*keys).distinct()
            new = bloom.unseen(users, before, *keys).select(*[F.col(k).alias(f"_{k}") for k in keys])
            first = batch.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            first = first.join(new, same, "left_semi").select(f"_first.{row_id}", F.lit(1).alias("isN"))
            flagged = batch.drop("isN").join(first, row_id, "left")
            write(flagged.withColumn("isN", F.coalesce("isN", F.lit(0))), batch_id)
            state.leave(merged(before, bloom.words(users, *keys)), batch_id)
        finally:
            batch.unpersist()

    return each
