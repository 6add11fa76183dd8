"""Spent state leaves the state store, and the rows stay the same."""

from __future__ import annotations

import random

from conftest import rows
from models import VISIT_SCHEMA
from test_streams import stream, write_files
from tidecast.streaming import processors
from tidecast.streaming.runs import finish

HOUR = 3_600_000
COLUMNS = "id timestamp anchor_id uv pv online".split()


def run(spark, visits, path, **options):
    counted = processors.audience_stream(visits, False, ttl_hours=1, **options)
    writer = counted.writeStream.format("parquet").option("path", f"{path}/rows")
    finish(writer, f"{path}/checkpoint")
    return rows(spark.read.schema(counted.schema).parquet(f"{path}/rows"), *COLUMNS)


def lives(spark, path, operator, name):
    state = (
        spark.read.format("statestore").option("operatorId", operator).option("stateVarName", name)
        .load(f"{path}/checkpoint")
    )
    return [r[0] for r in state.select("value.until").collect()]


def test_spent_state_is_deleted(spark, tmp_path):
    """Rooms and devices that come and go; within a batch and a little across, out of order."""
    rng, events = random.Random(8), []
    for i in range(600):
        hour = i // 50
        at = hour * HOUR + rng.randrange(HOUR)
        room = rng.choice(["always", f"room{hour // 3}"])
        events.append((i, room, f"d{rng.randrange(6)}-{hour // 2}", at, rng.randint(0, 1)))
    df = spark.createDataFrame(events, VISIT_SCHEMA)
    path = write_files(df, f"{tmp_path}/in", ("timestamp", "id"), 6)
    plain = run(spark, stream(spark, path, df.schema), f"{tmp_path}/plain")
    evicting = run(spark, stream(spark, path, df.schema), f"{tmp_path}/evicting", evict_delay="10 minutes")
    assert plain == evicting and len(plain) == 600
    watermark = max(e[3] for e in events) - 10 * 60_000
    for operator, name in ((0, "counts"), (1, "seen")):
        kept = lives(spark, f"{tmp_path}/evicting", operator, name)
        assert kept and min(kept) > watermark
        everything = lives(spark, f"{tmp_path}/plain", operator, name)
        assert sum(u > watermark for u in everything) == len(kept) < len(everything)
