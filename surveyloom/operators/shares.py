"""Small building blocks shared by the gold tables and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.fixed_values import MIN_RESPONDENTS


def share_of(
    df: DataFrame, group: Sequence[str], value: str = "respondentes", name: str = "percentual"
) -> DataFrame:
    """Add the percentage (2 decimals) of each row in the total of its group.

    Meant for aggregated rows: the window sees one row per cell, not one per respondent.
    """
    total = F.sum(value).over(Window.partitionBy(*group))
    return df.withColumn(name, F.round(100 * F.col(value) / total, 2))


def rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of a count in another count; NULL when the base is zero."""
    return F.round(100 * part / F.nullif(whole, F.lit(0)), digits)


def rounded(value: Column, digits: int | None) -> Column:
    """Round, or leave the value alone when ``digits`` is None."""
    return value if digits is None else F.round(value, digits)


def sample_flag(df: DataFrame, minimum: int = MIN_RESPONDENTS) -> DataFrame:
    """Mark groups that have enough respondents for their figures to be read."""
    return df.withColumn("amostra_suficiente", F.col("respondentes") >= F.lit(minimum))


def sufficient_or_all(df: DataFrame, within: Sequence[str] = ("recorte",)) -> DataFrame:
    """Keep rows with a sufficient sample; where a cut has none at all, keep all of its rows.

    Whether a cut has one comes from a small aggregate that is joined back: no task has to hold the
    rows of a cut together.
    """
    names = {c: f"_{c}_do_corte" for c in within}
    any_of = df.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(
        F.bool_or("amostra_suficiente").alias("_algum_suficiente")
    )
    same = reduce(and_, [df[c].eqNullSafe(any_of[n]) for c, n in names.items()])
    return (
        df.join(any_of, same)
        .where(F.col("amostra_suficiente") | ~F.col("_algum_suficiente"))
        .drop("_algum_suficiente", *names.values())
    )


def latest_edition(df: DataFrame, edition: str = "ano") -> DataFrame:
    """Rows of the most recent edition.

    The maximum is an uncorrelated scalar subquery, so on a table partitioned by edition it turns
    into a partition filter.
    """
    return df.where(F.col(edition) == df.select(F.max(edition)).scalar())


def per_edition(
    value: Column, editions: Sequence[int], prefix: str, aggregate=F.max, edition: str = "ano"
) -> list[Column]:
    """One conditional aggregate per edition: a pivot with a fixed, known set of columns."""
    return [
        aggregate(F.when(F.col(edition) == year, value)).alias(f"{prefix}_{year}")
        for year in editions
    ]


def in_order(name: str, labels: Sequence[str]) -> Column:
    """Position of a label in a custom order, for ``orderBy``; NULL for labels outside of it."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(name))
    return F.nullif(position, F.lit(0))
