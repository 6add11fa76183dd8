"""Columns from an outside service, asked once per distinct key with few calls at a time."""

from __future__ import annotations

import sys
import threading
import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# The calls run on the executors with this code.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])


def answers(keys: Sequence[tuple], call: Callable, in_flight: int, timeout: float) -> list:
    """``call(*key)`` of every key in order; None where it fails or takes too long.

    At most ``in_flight`` calls run at a time. A call that does not return in ``timeout``
    seconds gives None but keeps its place until it returns; a key that gets no place in
    that time gives None too. So no call can stop the others for good.
    """
    places = threading.Semaphore(in_flight)
    found: list = [None] * len(keys)
    waiting: list[tuple[int, threading.Event, float, list]] = []

    def run(key: tuple, out: list, done: threading.Event) -> None:
        try:
            out.append(call(*key))
        except Exception:
            pass  # a failed call is a missing answer
        finally:
            places.release()
            done.set()

    def collect(wait: bool) -> None:
        while waiting and (wait or waiting[0][1].is_set() or time.monotonic() >= waiting[0][2]):
            i, done, deadline, out = waiting.pop(0)
            if done.wait(max(0.0, deadline - time.monotonic())) and out:
                found[i] = out[0]

    for i, key in enumerate(keys):
        if places.acquire(timeout=timeout):
            done, out = threading.Event(), []
            waiting.append((i, done, time.monotonic() + timeout, out))
            threading.Thread(target=run, args=(key, out, done), daemon=True).start()
        collect(wait=False)
    collect(wait=True)
    return found


def look_up(
    rows: DataFrame,
    keys: Sequence[str],
    call: Callable,
    schema: T.StructType,
    in_flight: int = 8,
    tasks: int = 8,
    timeout: float = 5.0,
) -> DataFrame:
    """``rows`` with the columns of ``schema``, the answers of ``call`` for their keys.

    ``call`` takes the keys' values and returns a dict or None; it runs on the executors,
    ``in_flight`` at a time in each of ``tasks`` tasks, so at most ``in_flight * tasks``
    together. Every distinct key is asked once. Rows whose key has a null, fails or takes
    longer than ``timeout`` seconds keep nulls; none is lost. Batches only: a stream looks
    up its micro-batches.
    """
    names = [f"_{k}" for k in keys]
    asked = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).dropna().distinct().repartition(tasks)
    kinds = T.StructType([*[T.StructField(n, rows.schema[k].dataType) for k, n in zip(keys, names)], *schema.fields])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = list(zip(*(c.to_pylist() for c in batch.columns)))
            got = [a or {} for a in answers(values, call, in_flight, timeout)]
            new = [pa.array([a.get(f.name) for a in got], to_arrow_type(f.dataType)) for f in schema.fields]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], kinds.names)

    told = asked.mapInArrow(ask, kinds)
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(n) for k, n in zip(keys, names)])
    return rows.join(told, same, "left").drop(*names)
