"""Dimension and lookup tables that change while streams run."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jdbc(
    spark: SparkSession, options: Mapping[str, str], table: str
) -> DataFrame:
    """A database table; filters and columns chosen later are pushed to it."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def conform(table: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns of a table, in its order and types."""
    return table.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def changed_since(
    table: DataFrame,
    since=None,
    updated: str = "updateTime",
    deleted: str = "deleted",
) -> DataFrame:
    """Rows one poll returns.

    The first poll (``since`` None) takes every row not deleted, later ones take
    the rows changed after ``since``, deleted or not.
    """
    if since is None:
        return table.where(F.col(deleted) == 0)
    return table.where(F.col(updated) > F.lit(since))


def latest_dimension(
    changes: DataFrame,
    key: str = "id",
    order: str = "updateTime",
    deleted: str = "deleted",
) -> DataFrame:
    """The live rows: each key's newest change unless that one deletes it."""
    newest = Window.partitionBy(key).orderBy(F.desc(order), F.asc(deleted))
    return (
        changes.withColumn("_rank", F.row_number().over(newest))
        .where((F.col("_rank") == 1))
        .where(F.col(deleted) == 0)
        .drop("_rank")
    )


class PolledDimension:
    """A dimension folded from polls that each read only what changed since the last.

    The newest row per key, deleted or not, is kept as a table below ``path``; its
    highest change time is where the next poll goes on, also after a restart.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str = "id",
        updated: str = "updateTime",
        deleted: str = "deleted",
    ) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.key, self.updated, self.deleted = key, updated, deleted

    def _versions(self) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        # A version counts once its writer has finished.
        done = [
            s.getPath().getName()
            for s in files.listStatus(folder)
            if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        ]
        return sorted(int(n[8:]) for n in done if n.startswith("version="))

    def _kept(self, versions: list[int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={versions[-1]}")

    def poll(self, read: Callable[[], DataFrame]) -> DataFrame:
        """Fold in the changes of ``read()`` since the last poll; the live rows."""
        versions = self._versions()
        kept = self._kept(versions)
        since = kept.agg(F.max(self.updated)).first()[0]
        changes = conform(read(), self.schema)
        if since is not None:
            changes = changes.where(F.col(self.updated) > F.lit(since))
        newest = Window.partitionBy(self.key).orderBy(F.desc(self.updated), F.asc(self.deleted))
        merged = kept.unionByName(changes).withColumn("_rank", F.row_number().over(newest))
        number = versions[-1] + 1 if versions else 0
        merged.where("_rank = 1").drop("_rank").write.mode("overwrite").parquet(
            f"{self.path}/version={number}"
        )
        return self.live()

    def live(self) -> DataFrame:
        return self._kept(self._versions()).where(F.col(self.deleted) == 0)


def with_fresh_dimension(
    read: Callable[[], DataFrame],
    work: Callable[[DataFrame, DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that reads the dimension anew for every batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        work(batch, read(), batch_id)

    return each
