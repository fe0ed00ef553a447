"""Arrow batches in, Arrow batches out: the frame of every operator with numpy work in its tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Rows handed to a batch function at once; texts of this many documents fit a worker's memory.
ROWS = 256


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
    schema: str | StructType,
) -> DataFrame:
    """Apply a batch function to slices of at most ``ROWS`` rows of every partition.

    ``make`` runs once in each task and returns the function, so that tables and caches are built
    where they are used and nothing but its closure travels. A lost task starts again from its
    partition; no state outlives it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                out = function(batch.slice(start, ROWS))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null becomes empty."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def place_of(df: DataFrame, column: str) -> int:
    """Place of a column, which is found as Spark finds it: by its name, else whatever its case."""
    names = df.columns
    if column not in names and df.sparkSession.conf.get("spark.sql.caseSensitive") == "false":
        names = [name.lower() for name in names]
    return names.index(column)
