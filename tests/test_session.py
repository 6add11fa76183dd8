"""The working folder of a session that names none."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tidecast import session

PROGRAM = """
from pyspark.sql import SparkSession
from tidecast.session import prepare, shared_folder
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
prepare(spark)
assert not spark.conf.get("spark.checkpoint.dir", None)
one, two = shared_folder(spark, "a"), shared_folder(spark, "a")
spark.range(3).write.parquet(one)
assert spark.read.parquet(one).count() == 3 and one != two
print("folder", one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0])
"""


def test_local_session_without_the_setting(tmp_path):
    # An empty configuration folder hides the machine's own defaults.
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}
    run = subprocess.run(
        [sys.executable, "-c", PROGRAM], env=env, cwd=Path(__file__).parents[1],
        capture_output=True, text=True, timeout=300,
    )
    assert "folder True" in run.stdout, run.stderr[-2000:]


class _Cluster:
    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master, applicationId = "yarn", "app-1"


def test_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(_Cluster, "a")


def test_state_stores_share_bounded_memory(spark):
    store = "spark.sql.streaming.stateStore.rocksdb."
    assert spark.conf.get(store + "boundedMemoryUsage") == "true"
    assert spark.conf.get(store + "trackTotalNumberOfRows") == "false"
