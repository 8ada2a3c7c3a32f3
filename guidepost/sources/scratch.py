from __future__ import annotations

import uuid
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from guidepost.sources.tables import write_table


def scratch_folder(spark: SparkSession, folder: str | None = None) -> str:
    """The folder of this application's intermediate tables, below one that all executors share.

    That is ``folder`` or else the session's ``spark.checkpoint.dir`` or else its
    warehouse. It is never a temporary folder of one machine: on a cluster, a warehouse that
    nobody set, which lies below the driver's current folder, is refused.
    """
    for shared in (folder, spark.conf.get("spark.checkpoint.dir", None)):
        if shared:
            return _application_folder(spark, shared)
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse or not (_is_local(spark) or _is_shared(spark, warehouse)):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _application_folder(spark, warehouse)


def _application_folder(spark: SparkSession, shared: str) -> str:
    return f"{shared.rstrip('/')}/guidepost-{spark.sparkContext.applicationId}"


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] in ("local", "local-cluster")


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether a folder's store is another than the machine's own disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.getUri().getScheme() != "file"


def new_scratch_path(spark: SparkSession, purpose: str, folder: str | None = None) -> str:
    """A fresh path for an intermediate table in ``scratch_folder``."""
    return f"{scratch_folder(spark, folder)}/{purpose}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, folder: str | None = None) -> None:
    """Delete all intermediate tables of this application. Results that still read them fail
    afterwards, so write those first."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_folder(spark, folder))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(table: DataFrame) -> None:
    """Delete a table that ``snapshot`` returned. Whatever still reads it fails afterwards."""
    path = _SNAPSHOTS.pop(table, None)
    if path is None:
        raise ValueError("only tables that snapshot returned can be dropped, and once")
    spark = table.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_SNAPSHOTS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def snapshot(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` computed once, kept as a table in the shared folder.

    For results that several jobs read: they must all see the same rows even if a control
    table changes meanwhile or an executor is lost.
    """
    path = new_scratch_path(df.sparkSession, purpose)
    write_table(df, path, partition_by)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _SNAPSHOTS[stored] = path
    return stored
