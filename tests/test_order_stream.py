"""The order job over carried windows, against the one over state stores."""

from __future__ import annotations

import glob
import random

from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import rows
from test_streams import stream, write_files
from tidecast.operators import orders
from tidecast.session import shared_folder
from tidecast.sinks import tables
from tidecast.streaming.late import mark_late_batch, with_on_time_keys
from tidecast.streaming.orders import order_filler, order_stream
from tidecast.streaming.runs import finish
from tidecast.streaming.window_joins import finish_windows

DETAILS = "order_id bigint, line bigint, update_ms bigint, arrival bigint"
MAINS = (
    "oid bigint, total_money double, status int, uid bigint, province string,"
    " main_update_ms bigint, arrival bigint"
)
IDS = ("order_id", "line", "update_ms")
SHOWN = "order_id line update_ms windowStart oid total_money province main_source".split()


def by_state_stores(details, mains, table, path):
    """The stream-stream join, and the keys of a deduplication that tells late details."""
    joined = orders.windowed_left_join(
        details, mains, "order_id", "oid", right_ts="main_update_ms"
    ).withColumn("joined", F.lit(True))
    arrived = with_on_time_keys(details, IDS, "update_ms").withColumn("joined", F.lit(False))
    columns = [c for c in joined.columns if c != "joined"]

    def each(batch, batch_id):
        batch.persist()
        met = batch.where("joined").select(*columns)
        late = mark_late_batch(
            batch.where("NOT joined").select(*details.columns, "_on_time_key"), IDS, "update_ms"
        ).where("is_late").drop("is_late")
        rows = met.unionByName(orders.late_row_shape(late, met.schema))
        tables.table_writer(f"{path}/rows")(orders.lookup_fill(rows, table), batch_id)
        batch.unpersist()

    both = joined.unionByName(arrived, allowMissingColumns=True)
    finish(both.writeStream.foreachBatch(each), f"{path}/checkpoint")
    return details.sparkSession.read.parquet(f"{path}/rows")


def by_open_windows(details, mains, table, path):
    schemas = {"details": details.schema, "mains": mains.schema}
    filler = order_filler(
        f"{path}/state", lambda: table, tables.table_writer(f"{path}/rows"), schemas, IDS
    )
    finish_windows(order_stream(details, mains), filler, f"{path}/checkpoint")
    assert not glob.glob(f"{path}/checkpoint/state/*")
    return details.sparkSession.read.parquet(f"{path}/rows")


def test_rows_as_by_state_stores(spark, tmp_path):
    """Null, repeated and lone keys, late details, no time; ids that come again in a later batch."""
    dice = random.Random(11)
    key = lambda: dice.choice([None, *range(25)])
    # In order of time but for 25 seconds, more than the 20 of two batches.
    time = lambda share: int(share * 80_000) + dice.randrange(25_000) if dice.random() < 0.95 else None
    details = [(key(), dice.choice([None, *[n] * 20]), time(n / 400), n) for n in range(400)]
    # Again in the same batch, in a later one with the window open, and long after it.
    details += [(*details[n][:3], min(n + later, 399)) for n in range(0, 400, 9) for later in (0, 30, 200)]
    mains = [(k := key(), n / 2, n % 3, k, f"p{n % 5}", time(n / 200), n) for n in range(200)]
    sides = []
    for name, data, schema in (("d", details, DETAILS), ("m", mains, MAINS)):
        df = spark.createDataFrame(data, schema)
        path = write_files(df, str(tmp_path / name), ("arrival",), 8)
        sides.append((path, df.schema))
    table = spark.createDataFrame([(n, 7.0 + n, 1, n, "t") for n in range(0, 30, 2)], MAINS.rsplit(",", 2)[0])

    def read():
        return [stream(spark, path, schema, 1).drop("arrival") for path, schema in sides]

    got = rows(by_open_windows(*read(), table, str(tmp_path / "got")), *SHOWN)
    want = rows(by_state_stores(*read(), table, str(tmp_path / "want")), *SHOWN)
    assert got == want
    late = [r for r in got if r[3] is None]
    assert {r[-1] for r in got} == {"joined", "lookup", "none"}
    assert any(None not in r[:3] for r in late) and any(None in r[:3] for r in late)


def test_batch_that_runs_again(spark, tmp_path):
    """Pairs and late details come in their batch, lone ones at the close; a repeat repeats."""
    found = []
    d, m = DETAILS.rsplit(",", 1)[0], MAINS.rsplit(",", 1)[0]
    table = spark.createDataFrame([(1, 5.0, 1, 1, "t"), (3, 6.0, 1, 3, "t")], MAINS.rsplit(",", 2)[0])
    schemas = {"details": spark.createDataFrame([], d).schema, "mains": spark.createDataFrame([], m).schema}
    each = order_filler(
        str(tmp_path), lambda: table, lambda df, n: found.append((n, rows(df.select(*SHOWN)))), schemas, IDS
    )
    schema = f"details struct<{d.replace(' ', ':').replace(',:', ', ')}>, mains struct<{m.replace(' ', ':').replace(',:', ', ')}>"
    main = lambda oid, at: (None, (oid, 9.0, 0, oid, "p", at))
    batches = [
        [((1, 1, 1000), None), ((2, 1, 1500), None), ((None, 1, 1600), None)],
        [main(1, 2000), main(7, 30_000), ((7, 1, 30_000), None)],
        [((1, 2, 1200), None), ((1, 1, 1000), None)],
        # The window of the first rows has closed.
        [((3, 1, 1300), None), ((4, 1, 1300), None)],
    ]
    pair = lambda line, at: (1, line, at, 0, 1, 9.0, "p", "joined")
    late = lambda key, line, at, *rest: (key, line, at, None, None, *rest)
    want = [
        [late(None, 1, 1600, None, None, "none")],
        [pair(1, 1000), (7, 1, 30_000, 30_000, 7, 9.0, "p", "joined")],
        [
            (None, 1, 1600, 0, None, None, None, "none"),
            late(1, 1, 1000, 5.0, "t", "lookup"), pair(1, 1000), pair(2, 1200),
            (2, 1, 1500, 0, None, None, None, "none"),
        ],
        [late(3, 1, 1300, 6.0, "t", "lookup"), late(4, 1, 1300, None, None, "none")],
    ]
    for number, batch in enumerate(batches):
        for _ in range(2):
            each(spark.createDataFrame(batch, schema), number)
        assert found[-2:] == [(number, want[number])] * 2


def test_query_keeps_no_row_in_a_state_store(spark, data):
    queries()["stream_order_lookup_fill"](spark, data).count()
    folder = shared_folder(spark, "stream-fill").rsplit("/", 1)[0]
    runs = glob.glob(f"{folder}/stream-fill-*/checkpoint")
    assert runs and not glob.glob(f"{folder}/stream-fill-*/checkpoint/state/*")
