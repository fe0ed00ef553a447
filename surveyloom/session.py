"""Session settings that suit wide survey projections and rows that pack well."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # The JVM never compiles a method of more than 8000 bytes of bytecode. A wide projection of
    # text rules fused into one stage exceeds that and would run interpreted; below the limit Spark
    # splits the expressions into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Survey rows shrink to a fortieth in shuffles and files, so a task of the usual size unpacks to
    # gigabytes of hash tables. Tasks are kept small and their number follows the data.
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.shuffle.partitions": "600",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Give the settings to a running session, for frames that are computed later.

    What the caller has set stays as it is.
    """
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


@contextmanager
def configured(spark: SparkSession) -> Iterator[SparkSession]:
    """The settings while a job runs; afterwards the session is as it was."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    try:
        yield configure(spark)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
