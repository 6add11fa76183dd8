"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

DEFAULT_PARTITIONS = "200"

# Settings every operator relies on; all of them can be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Joins leave the splitting of hot keys to adaptive execution.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Stores of one executor share this memory; by default each has its own, and more with
    # its rows. Counting a store's rows would read every key before it is written.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1000",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    # On one machine the default number of shuffle partitions, each with its own
    # state store in a stream, is far above the number of cores.
    context = spark.sparkContext
    if context.master.startswith("local"):
        if spark.conf.get("spark.sql.shuffle.partitions") == DEFAULT_PARTITIONS:
            spark.conf.set(
                "spark.sql.shuffle.partitions", str(context.defaultParallelism)
            )
    return spark


def local_session(cores: str = "8", memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidecast")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        # Small test data still uses every core after a shuffle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


# The temporary folder of each application that runs on one machine without a setting.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster shares between its machines.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a session on one
    machine may go without the setting and gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all machines share")
        # The setting is fixed on a live session, so the folder is kept here.
        application = spark.sparkContext.applicationId
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="tidecast-")
        base = _local_folders[application]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
