"""The shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
FALLBACK = "spark.sql.warehouse.dir"
#: Begin of the names of folders in which rows wait to be moved into a table; readers skip them.
STAGING = "_preparo-"


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors share: the one in ``spark.checkpoint.dir``, else the warehouse's.

    Both are configuration. Where executors may run on other machines, a warehouse on a local disk
    is refused: each would write to its own.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get(FALLBACK).rstrip("/")
    one_machine = spark.sparkContext.master.startswith(("local[", "local-cluster[")) or (
        spark.sparkContext.master == "local"
    )
    if not one_machine and urlsplit(warehouse).scheme in ("", "file"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return f"{warehouse}/_intermediate"


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and stops several consumers from computing
    the same thing again. Rows are dealt by the partition columns first, so that each partition is
    a few files rather than one for each task; adaptive execution splits the large ones.
    """
    path = new_table_path(df.sparkSession, name)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; empty where there is none."""
    target, files = _folder(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a partition or staging folder, as its name says; one that is not there is passed over."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if "=" not in name and not name.startswith(STAGING):
        raise ValueError(f"{path} is neither a partition nor a staging folder")
    target, files = _folder(spark, path)
    files.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within one file system; the folder above the target is made."""
    old, files = _folder(spark, source)
    new, _ = _folder(spark, target)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def changed_at(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed, from its metadata; tells a table from its successor."""
    target, files = _folder(spark, path)
    return files.getFileStatus(target).getModificationTime()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table that this library wrote below the shared folder; nothing else is touched."""
    if not path.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"{path} is not below the shared folder")
    target, files = _folder(spark, path)
    files.delete(target, True)
