"""Statistics of banded values.

Pay is collected in bands, so the statistics of any group follow from a histogram: how many of its
respondents chose each band. That histogram is one hash aggregate with map-side combine, and what
it shuffles is (groups x bands) rows per task, whatever the number of respondents. A group that
holds a third of all respondents is no heavier than any other one. The rest works on the
histogram: cumulative counts over a window, and one last aggregate that reuses the window's
partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.operators.shares import rounded

LOWER, UPPER, VALUE = "faixa_inferior", "faixa_superior", "salario_mensal_estimado"
COUNT = "na_faixa"


def band_histogram(
    df: DataFrame, keys: Sequence[str], lower: str = LOWER, upper: str = UPPER, *extra: str,
    counted: Column | None = None,
) -> DataFrame:
    """Respondents per group and band. NULL is a group of its own in every key.

    ``counted`` restricts the respondents. The condition sits inside the count and not in a filter
    before it: the optimizer would push such a filter below the projection that derives its
    columns, and derive them twice.
    """
    cells = df.groupBy(*keys, lower, upper, *extra)
    if counted is None:
        return cells.agg(F.count(F.lit(1)).alias(COUNT))
    return cells.agg(F.count_if(counted).alias(COUNT)).where(F.col(COUNT) > 0)


def with_band_position(
    histogram: DataFrame, keys: Sequence[str], lower: str = LOWER, upper: str = UPPER,
    count: str = COUNT,
) -> DataFrame:
    """Add the running count of each band and the total of its group.

    Bands are ordered by lower limit, then upper limit with the open one last. Bands without a
    lower limit, or with no respondent, take no part.
    """
    valid = F.when(F.col(lower).isNotNull() & (F.col(count) > 0), F.col(count))
    group = Window.partitionBy(*keys)
    ordered = group.orderBy(F.col(lower).asc_nulls_last(), F.col(upper).asc_nulls_last())
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        histogram.withColumn("valido", valid)
        .withColumn("acumulado", F.sum("valido").over(running))
        .withColumn("total_valido", F.sum("valido").over(group))
    )


def interpolated_median_agg(lower: str = LOWER, upper: str = UPPER) -> Column:
    """Aggregate giving L + ((N/2 - F) / f) * w from the rows of ``with_band_position``."""
    reached = F.col("valido").isNotNull() & (2 * F.col("acumulado") >= F.col("total_valido"))
    band = F.min(
        F.when(
            reached,
            F.struct(
                F.col("acumulado"), F.col(lower).alias("l"), F.col(upper).alias("u"),
                F.col("valido").alias("f"), F.col("total_valido").alias("n"),
            ),
        )
    )
    before = band["acumulado"] - band["f"]
    inside = band["l"] + ((band["n"] / 2 - before) / band["f"]) * (band["u"] - band["l"])
    # An open band, or one without width, cannot be interpolated: its lower limit is the answer.
    return F.when(band["u"] > band["l"], inside).otherwise(band["l"])


def grouped_median(
    df: DataFrame, keys: Sequence[str], lower: str = LOWER, upper: str = UPPER,
    name: str = "salario_mediano_interpolado", digits: int | None = None,
) -> DataFrame:
    """Interpolated median of each group of respondents, with the group's number of answers."""
    placed = with_band_position(band_histogram(df, keys, lower, upper), keys, lower, upper)
    return placed.groupBy(*keys).agg(
        F.coalesce(F.sum("valido"), F.lit(0)).alias("respondentes"),
        rounded(interpolated_median_agg(lower, upper), digits).alias(name),
    )


def quantile_positions(
    histogram: DataFrame, keys: Sequence[str], value: str = VALUE, count: str = COUNT
) -> DataFrame:
    """Add the running count by value (``ate_valor``) and the total (``total_valor``)."""
    group = Window.partitionBy(*keys)
    running = group.orderBy(F.col(value)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = F.when(F.col(value).isNotNull(), F.col(count))
    return histogram.withColumn("ate_valor", F.sum(counted).over(running)).withColumn(
        "total_valor", F.sum(counted).over(group)
    )


def quantile_agg(p: float, value: str = VALUE) -> Column:
    """Smallest value that at least a share ``p`` of the group does not exceed."""
    return F.min(F.when(F.col("ate_valor") >= p * F.col("total_valor"), F.col(value)))


def interpolated_quantile_agg(p: float, value: str = VALUE) -> Column:
    """Quantile with linear interpolation between the two neighbouring values."""
    place = p * (F.col("total_valor") - 1)
    below = F.min(F.when(F.col("ate_valor") > F.floor(place), F.col(value)))
    above = F.min(F.when(F.col("ate_valor") > F.ceil(place), F.col(value)))
    rest = F.max(place - F.floor(place))
    return below + (above - below) * rest


def banded_statistics(
    df: DataFrame, keys: Sequence[str], digits: int | None = None, value: str = VALUE,
    lower: str = LOWER, upper: str = UPPER, counted: Column | None = None,
) -> DataFrame:
    """Count, mean, quartiles and interpolated median of every group, from one histogram.

    One pass over the respondents and no join, so a group whose key is NULL keeps its median. The
    quartiles are exact, because the histogram holds every value with its frequency.
    """
    answered = F.col(value).isNotNull()
    histogram = band_histogram(
        df, keys, lower, upper, value,
        counted=answered if counted is None else answered & counted,
    )
    return statistics_of_histogram(histogram, keys, digits, value, lower, upper)


def statistics_of_histogram(
    histogram: DataFrame, keys: Sequence[str], digits: int | None = None, value: str = VALUE,
    lower: str = LOWER, upper: str = UPPER, exact_interpolation: bool = False,
) -> DataFrame:
    """``banded_statistics`` from a histogram that already exists."""
    quantile = interpolated_quantile_agg if exact_interpolation else quantile_agg
    placed = quantile_positions(
        with_band_position(histogram, keys, lower, upper), keys, value
    )
    total = F.sum(F.col(COUNT))
    return placed.groupBy(*keys).agg(
        total.alias("respondentes"),
        rounded(interpolated_median_agg(lower, upper), digits).alias(
            "salario_mediano_interpolado"
        ),
        rounded(quantile(0.5, value), digits).alias("salario_mediano"),
        rounded(F.sum(F.col(value) * F.col(COUNT)) / total, digits).alias("salario_medio"),
        rounded(quantile(0.25, value), digits).alias("p25"),
        rounded(quantile(0.75, value), digits).alias("p75"),
    )


def approximate_quartiles(
    df: DataFrame, keys: Sequence[str], value: str = VALUE, accuracy: int = 10000
) -> DataFrame:
    """Quartiles of values that need not be banded, from mergeable sketches of bounded size."""

    def quantile(p: float) -> Column:
        return F.percentile_approx(value, p, accuracy)

    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        quantile(0.5).alias("salario_mediano"),
        quantile(0.25).alias("p25"),
        quantile(0.75).alias("p75"),
    )


def counts_and_statistics(
    df: DataFrame, keys: Sequence[str], digits: int | None = None, value: str = VALUE,
    lower: str = LOWER, upper: str = UPPER,
) -> DataFrame:
    """All respondents of a group beside the pay of those who answered, in one pass.

    Respondents without pay sit in a histogram row whose value is NULL: they count, and they take
    no part in mean and median.
    """
    histogram = band_histogram(df, keys, lower, upper, value)
    placed = with_band_position(histogram, keys, lower, upper)
    paid = F.when(F.col(value).isNotNull(), F.col(COUNT))
    return placed.groupBy(*keys).agg(
        F.sum(COUNT).alias("respondentes"),
        rounded(F.sum(F.col(value) * paid) / F.sum(paid), digits).alias("salario_medio"),
        rounded(interpolated_median_agg(lower, upper), digits).alias(
            "salario_mediano_interpolado"
        ),
    )


def median_of_bands(bands: Column) -> Column:
    """Interpolated median of an ``array<struct<lower, upper, count>>`` value.

    For histograms that are already one row per group. The array holds the answer options of one
    question, so folding over it is cheap.
    """
    items = F.filter(
        F.transform(
            bands,
            lambda b: F.struct(
                b[LOWER].cast("double").alias("l"),
                # Open bands sort after closed ones with the same lower limit.
                b[UPPER].isNull().alias("open"),
                b[UPPER].cast("double").alias("u"),
                b[COUNT].cast("bigint").alias("f"),
            ),
        ),
        lambda b: b["l"].isNotNull() & (b["f"] > 0),
    )
    ordered = F.array_sort(items)
    total = F.aggregate(ordered, F.lit(0).cast("bigint"), lambda acc, b: acc + b["f"])
    nothing = F.lit(None).cast("double")
    start = F.struct(F.lit(0).cast("bigint").alias("before"), nothing.alias("median"))

    def step(acc: Column, b: Column) -> Column:
        here = acc["median"].isNull() & (2 * (acc["before"] + b["f"]) >= total)
        inside = b["l"] + ((total / 2 - acc["before"]) / b["f"]) * (b["u"] - b["l"])
        found = F.when(b["u"] > b["l"], inside).otherwise(b["l"])
        return F.struct(
            (acc["before"] + b["f"]).alias("before"),
            F.when(here, found).otherwise(acc["median"]).alias("median"),
        )

    return F.aggregate(ordered, start, step, lambda acc: acc["median"])
