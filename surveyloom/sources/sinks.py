"""Writing and publishing tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyloom.sources import workspace


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("ano",), rebalance: bool = False
) -> int:
    """Overwrite a Parquet table and return the number of rows written.

    The count is observed while writing, so the plan runs once. Only partitions present in the
    frame are replaced: one edition can be loaded again without touching the others. Sorted and
    aggregated frames end in a shuffle whose partitions adaptive execution merges, so small tables
    come out as one file and large ones stay spread; ``rebalance`` adds such a shuffle to others.
    """
    seen = Observation()
    out = df.hint("rebalance") if rebalance else df
    writer = out.observe(seen, F.count(F.lit(1)).alias("linhas")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return seen.get["linhas"]


def editions_in(spark: SparkSession, path: str, column: str = "ano") -> list[int]:
    """Editions that a written table has a partition of, from the names of its folders."""
    names = workspace.children(spark, path)
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))


def remove_editions(
    spark: SparkSession, path: str, years: Iterable[int], column: str = "ano"
) -> None:
    """Delete the partitions of some editions; those that do not exist are passed over."""
    for year in years:
        workspace.remove_folder(spark, f"{path}/{column}={int(year)}")
    spark.catalog.refreshByPath(path)


def replace_editions(
    df: DataFrame, path: str, years: Iterable[int], column: str = "ano"
) -> int:
    """Put the rows of some editions in the place of those stored; returns the rows written.

    Rows are first written in full to a staging folder inside the table's, which readers skip, so a
    job that fails leaves the table as it was, and a table may be replaced by rows read from it.
    Then each edition's folder is swapped by a rename. An edition without rows is removed; rows of
    other editions than the given ones are refused.
    """
    spark, years = df.sparkSession, sorted(set(map(int, years)))
    staged = f"{path}/{workspace.STAGING}{uuid.uuid4().hex}"
    try:
        rows = write_table(df, staged, (column,))
        found = editions_in(spark, staged, column)
        if set(found) - set(years):
            raise ValueError(f"rows of editions {found}, expected only {years}")
        remove_editions(spark, path, years, column)
        for year in found:
            name = f"{column}={year}"
            workspace.move(spark, f"{staged}/{name}", f"{path}/{name}")
    finally:
        workspace.remove_folder(spark, staged)
    spark.catalog.refreshByPath(path)
    return rows


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``write_table``; the edition comes back as a typed partition column."""
    return spark.read.parquet(path)


def buckets_for(people: int, people_a_bucket: int = 200_000, least: int = 16) -> int:
    """Number of buckets that follows the number of people, so that no bucket grows with the table."""
    return max(least, -(-people // people_a_bucket))


def store_in_buckets(
    df: DataFrame, table: str, key: str = "id_respondente", buckets: int = 200,
    partition_by: Sequence[str] = ("ano",), dealt: bool = False,
) -> DataFrame:
    """Store a catalog table in buckets by a key, sorted, and return it.

    Tables with equal buckets join on the key without a shuffle, as often as they are read. The rows
    of a bucket meet in one task before they are written, so a bucket is one file in each partition.
    ``dealt`` says that they have met: ``df`` was derived row by row from
    ``repartition(buckets, key)``, which spreads the derivation too.
    """
    rows = df if dealt else df.repartition(buckets, key)
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.partitionBy(*partition_by).saveAsTable(table)
    return df.sparkSession.table(table)


def sorted_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sort by several keys; a leading minus means descending."""
    return df.orderBy(*[F.col(k[1:]).desc() if k.startswith("-") else F.col(k).asc() for k in keys])


def export_csv(
    df: DataFrame, path: str, separator: str = ",", order: Sequence[str] = ()
) -> None:
    """CSV with a header, in the order of the frame or sorted by ``order``.

    A sort ends in a shuffle whose partitions adaptive execution merges, so a small table such as a
    gold one comes out as one file and a large one as several, in order.
    """
    writer = (sorted_by(df, order) if order else df).write.mode("overwrite")
    writer.option("header", True).option("sep", separator).csv(path)


def export_all(
    tables: Mapping[str, DataFrame], base: str, order: Mapping[str, Sequence[str]],
    separator: str = ",",
) -> None:
    """Every table as CSV in a folder of its name, sorted as ``order`` says."""
    for name, df in tables.items():
        export_csv(df, f"{base}/{name}", separator, order.get(name, ()))


def publish(
    spark: SparkSession, database: str, name: str, schema_of: DataFrame, location: str,
    partition_by: Sequence[str] = ("ano",),
) -> None:
    """Register a written folder as an external table and pick up its partitions."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    fields = schema_of.schema.fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spread = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet "
        f"{spread} LOCATION '{location}'"
    )
    if partition_by:
        register_partitions(spark, f"`{database}`.`{name}`")


def publish_all(
    spark: SparkSession, database: str, tables: Mapping[str, DataFrame], base: str,
    prefix: str = "", partition_by: Sequence[str] = ("ano",),
) -> None:
    """Register every table, written below ``base`` in a folder of its name."""
    for name, df in tables.items():
        publish(spark, database, f"{prefix}{name}", df, f"{base}/{name}", partition_by)


def register_partitions(spark: SparkSession, table: str) -> None:
    """Bring the catalog's partitions in line with the folder: late ones come in, removed ones go."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def register_views(
    spark: SparkSession, silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame],
    plain_gold_names: bool = False,
) -> None:
    """Temporary views for SQL.

    Silver tables appear as ``respondentes`` and ``tecnologias`` and as ``silver_*``, gold tables
    as ``gold_*``. With ``plain_gold_names`` gold tables also get their bare name, and
    ``tecnologias`` then means the gold table.
    """
    for name, df in silver.items():
        df.createOrReplaceTempView(name)
        df.createOrReplaceTempView(f"silver_{name}")
    for name, df in gold.items():
        df.createOrReplaceTempView(f"gold_{name}")
        if plain_gold_names:
            df.createOrReplaceTempView(name)
