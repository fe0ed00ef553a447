"""Ranks within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.sources.workspace import written


def rank_in_groups(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "posicao"
) -> DataFrame:
    """``row_number`` of each group, without a task that holds a group.

    Rows are sorted by range over all tasks and stored with their place. Places of a task follow
    each other, so the rank of a row is its distance from its group's first place in that task, plus
    the rows of the group in earlier tasks: counts of (task, group) pairs are all that is added up.
    ``order`` decides between any two rows of a group, otherwise equal rows may change places.
    """
    by = [F.col(g).asc_nulls_first() for g in groups] + list(order)
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).select(
        "*", F.spark_partition_id().alias("tarefa_"), F.monotonically_increasing_id().alias("lugar_")
    )
    stored = written(placed, "ordenadas")
    # Groups under other names, and compared null-safely: a null group is a group.
    names = {g: f"{g}_do_grupo" for g in groups}
    counts = stored.groupBy(*[F.col(g).alias(n) for g, n in names.items()], "tarefa_").agg(
        F.min("lugar_").alias("primeiro_"), F.count(F.lit(1)).alias("linhas_")
    ).withColumnRenamed("tarefa_", "tarefa_do_grupo")
    earlier = Window.partitionBy(*names.values()).orderBy("tarefa_do_grupo").rowsBetween(
        Window.unboundedPreceding, Window.currentRow - 1
    )
    offsets = counts.withColumn("antes_", F.coalesce(F.sum("linhas_").over(earlier), F.lit(0)))
    same = F.col("tarefa_") == F.col("tarefa_do_grupo")
    for group, other in names.items():
        same = same & F.col(group).eqNullSafe(F.col(other))
    rank = F.col("antes_") + F.col("lugar_") - F.col("primeiro_") + 1
    return stored.join(offsets, same).select(*df.columns, rank.cast("int").alias(name))
