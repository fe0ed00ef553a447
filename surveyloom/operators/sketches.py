"""Distinct people over editions from stored sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Two to this many registers: 16 KB a sketch at most, a standard error of 0.8 %.
PRECISION = 14
STANDARD_ERROR = 1.04 / 2 ** (PRECISION / 2)


def people_sketches(
    items: DataFrame, keys: Sequence[str] = ("ano", "categoria", "tecnologia"),
    person: str = "id_respondente",
) -> DataFrame:
    """A sketch of the people of each edition, question and item, to be stored by edition.

    Sketches are built inside each task and merged after the shuffle, so a person or item that fills
    a third of the table weighs no more than another; their size does not grow with it.
    """
    return items.groupBy(*keys).agg(F.hll_sketch_agg(F.col(person), PRECISION).alias("pessoas"))


def united_people(
    sketches: DataFrame, keys: Sequence[str] = ("categoria", "tecnologia")
) -> DataFrame:
    """Distinct people over all editions in the frame, about, without reading answers again.

    A person of several editions counts once. To leave editions out, filter the stored sketches.
    """
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("pessoas")).alias("pessoas_aprox"),
        F.count(F.lit(1)).alias("edicoes"),
    )
