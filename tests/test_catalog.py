"""Every named query gives the rows of its SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidecast.catalog import REGISTRY


@pytest.fixture(scope="module")
def tables(data):
    con = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, data, tables, name):
    got = queries()[name](spark, data)
    columns = sorted(got.columns)
    cursor = tables.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == want
    assert want, "the check has no rows"


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["id", "timestamp", "anchor_id", "uv", "pv", "online"]
    assert df.count() > 0
