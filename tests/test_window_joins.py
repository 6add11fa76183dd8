"""Window joins over carried tables, against Spark's stream-stream join."""

from __future__ import annotations

import glob
import random

import pytest

from __spark_entry__ import queries
from conftest import rows
from test_streams import stream, write_files
from tidecast.operators import orders
from tidecast.session import shared_folder
from tidecast.streaming.runs import append_to_table
from tidecast.streaming.window_joins import arrived, window_join_batches, window_joined

DETAILS = "order_id bigint, line bigint, update_ms bigint"
MAINS = "oid bigint, total double, main_update_ms bigint"


def both_ways(spark, tmp_path, details, mains):
    """Rows of the carried join and of the stream-stream join over the same files."""
    sides = []
    for name, data, schema, arrival in (("d", details, DETAILS, "line"), ("m", mains, MAINS, "total")):
        df = spark.createDataFrame(data, schema)
        path = write_files(df, str(tmp_path / name), (arrival,), 8)
        sides.append((path, df.schema))

    def read():
        return [stream(spark, path, schema, 1) for path, schema in sides]

    def join(d, m):
        return orders.windowed_left_join(d, m, "order_id", "oid", right_ts="main_update_ms")

    times = {"details": "update_ms", "mains": "main_update_ms"}
    got = window_joined(dict(zip(times, read())), times, "t", join)
    want = append_to_table(join(*read()), "t")
    columns = "order_id line update_ms windowStart oid total main_update_ms".split()
    return rows(got, *columns), rows(want, *columns), got


def test_as_the_stream_stream_join(spark, tmp_path):
    """Repeated and null keys, lone and late rows, no time, rows before and after their match."""
    dice = random.Random(5)
    key = lambda: dice.choice([None, *range(25)])
    # In order of time but for 25 seconds, more than the 20 of two batches.
    time = lambda share: int(share * 80_000) + dice.randrange(25_000) if dice.random() < 0.95 else None
    details = [(key(), n, time(n / 400)) for n in range(400)]
    mains = [(key(), float(n), time(n / 200)) for n in range(200)]
    got, want, table = both_ways(spark, tmp_path, details, mains)
    assert got == want
    assert any(r[4] is None for r in got) and any(r[4] is not None for r in got)
    timed = [r for r in details if r[2] is not None and r[2] < 70_000]
    assert len({r[1] for r in got if r[2] < 70_000}) < len(timed)
    # No row is kept in a state store by itself.
    assert "Symmetric" not in table._jdf.queryExecution().toString()


def collected(found):
    columns = "order_id line update_ms windowStart oid total main_update_ms".split()
    return lambda df, batch_id: found.append((batch_id, rows(df.select(*columns))))


def test_batch_that_runs_again_and_late_rows(spark, tmp_path):
    """Pairs come once, lone rows at the close, late rows never; a repeated batch repeats."""
    schemas = {"d": spark.createDataFrame([], DETAILS).schema, "m": spark.createDataFrame([], MAINS).schema}
    found = []
    each = window_join_batches(
        str(tmp_path), collected(found), schemas, {"d": "update_ms", "m": "main_update_ms"},
        lambda d, m: orders.windowed_left_join(d, m, "order_id", "oid", right_ts="main_update_ms"),
    )
    schema = f"d struct<{DETAILS.replace(' bigint', ':bigint')}>, m struct<oid:bigint,total:double,main_update_ms:bigint>"
    batches = [
        [((1, 1, 1000), None), ((2, 1, 1500), None)],
        [(None, (1, 9.0, 2000)), (None, (5, 0.0, 30_000)), ((6, 1, 30_000), None)],
        # The previous batch ran under no watermark yet, so this one is on time.
        [((1, 2, 1200), None)],
        # Now the window of the first rows has closed.
        [((1, 3, 1300), None)],
    ]
    pair = lambda line, at: (1, line, at, 0, 1, 9.0, 2000)
    want = [[], [pair(1, 1000)], [pair(2, 1200), (2, 1, 1500, 0, None, None, None)], []]
    for number, batch in enumerate(batches):
        for _ in range(2):
            each(spark.createDataFrame(batch, schema), number)
        assert found[-2:] == [(number, want[number])] * 2


def test_group_buy_carries_three_sides(spark, tmp_path):
    """As the chained stream-stream joins; a detail needs both partners to come out early."""
    flush = 600_000
    tables = {
        "details": (
            [(1000, "u1", "p1", "o1"), (1500, "u2", "p1", "o9"), (5001, "u3", "p9", "o2"), (flush, "x", "x", "x")],
            "ts bigint, user_id string, group_id string, order_id string",
        ),
        "orders": (
            [(1001, "o1", "102", 200.0), (1002, "o1", "103", 7.0), (5002, "o2", "101", 3000.0), (flush, "x", "0", 1.0)],
            "ts bigint, order_id string, status string, amount double",
        ),
        "groups": (
            [(1000, "p1", "1", "c"), (flush, "x", "0", "c")],
            "ts bigint, group_id string, status string, category string",
        ),
    }
    sides = {}
    for name, (data, schema) in tables.items():
        df = spark.createDataFrame(data, schema)
        sides[name] = stream(spark, write_files(df, str(tmp_path / name), ("ts",), 2), df.schema, 1)
    got = window_joined(
        sides, dict.fromkeys(sides, "ts"), "t",
        lambda d, o, g: orders.group_buy(d, o, g, along=(arrived("orders"), arrived("groups"))),
        delay="0 seconds",
    )
    assert not [c for c in got.columns if c.startswith("_")]
    assert rows(got, "user_id", "order_amount", "group_category") == [
        ("u1", 7.0, "c"), ("u1", 200.0, "c"), ("u2", None, "c"), ("u3", 3000.0, None), ("x", 1.0, "c"),
    ]


@pytest.mark.parametrize(
    "name,purpose",
    [("stream_group_buy_join", "stream-groups"), ("stream_order_detail_left_join", "stream-orders")],
)
def test_query_keeps_no_row_in_a_state_store(spark, data, name, purpose):
    queries()[name](spark, data).count()
    folder = shared_folder(spark, purpose).rsplit("/", 1)[0]
    runs = glob.glob(f"{folder}/{purpose}-*/checkpoint")
    assert runs and not glob.glob(f"{folder}/{purpose}-*/checkpoint/state/*")
