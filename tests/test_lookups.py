"""Calls to a service that is slow, fails, or never answers."""

from __future__ import annotations

import threading
import time

from pyspark.sql import types as T

from conftest import rows
from tidecast.operators.lookups import answers, look_up

PLACE = T.StructType([T.StructField("city", T.StringType()), T.StructField("code", T.IntegerType())])


def test_few_calls_at_a_time_and_all_answers():
    lock, now, most = threading.Lock(), 0, 0

    def call(x):
        nonlocal now, most
        with lock:
            now += 1
            most = max(most, now)
        time.sleep(0.01)
        with lock:
            now -= 1
        if x % 7 == 0:
            raise OSError("no route")
        return x * x

    got = answers([(i,) for i in range(60)], call, 4, 5.0)
    assert got == [None if i % 7 == 0 else i * i for i in range(60)]
    assert 2 <= most <= 4


def test_hanging_calls_do_not_stop_the_others():
    forever = threading.Event()

    def call(x):
        if x in (0, 5):
            forever.wait(20)
        return x

    start = time.monotonic()
    got = answers([(i,) for i in range(12)], call, 3, 0.3)
    assert got == [None if i in (0, 5) else i for i in range(12)]
    assert time.monotonic() - start < 3
    # All places taken: the rest are given up after the timeout each, late answers too.
    assert answers([(0,), (0,), (5,)], call, 2, 0.2) == [None, None, None]
    forever.set()


def test_rows_are_kept(spark):
    def call(lon, lat):
        if lon == 2.0:
            time.sleep(3)
        if lon == 3.0:
            raise ValueError("bad point")
        return None if lon == 4.0 else {"city": f"{lon:.0f}/{lat:.0f}", "code": int(lat)}

    data = [(i, float(i % 6), 1.0) for i in range(30)] + [(30, None, 1.0), (31, 0.0, None)]
    df = spark.createDataFrame(data, "id int, longitude double, latitude double")
    got = look_up(df, ["longitude", "latitude"], call, PLACE, in_flight=2, tasks=2, timeout=1.0)
    assert got.columns == ["id", "longitude", "latitude", "city", "code"]
    want = []
    for i, lon, lat in data:
        answered = None not in (lon, lat) and lon not in (2.0, 3.0, 4.0)
        want.append((i, f"{lon:.0f}/1" if answered else None, 1 if answered else None))
    assert rows(got, "id", "city", "code") == want
    assert look_up(df.limit(0), ["longitude"], lambda x: None, PLACE).count() == 0
