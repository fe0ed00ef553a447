import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
# Python workers look for the package here.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Results of a Column function over a list of values (or tuples of values)."""

    def run(function, values, types="v string"):
        data = [v if isinstance(v, tuple) else (v,) for v in values]
        names = [part.split()[0] for part in types.split(",")]
        # Numbered, so that the results come back in the order of the values.
        numbered = spark.createDataFrame(
            [(i, *row) for i, row in enumerate(data)], f"i int, {types}"
        )
        from pyspark.sql import functions as F

        out = numbered.select("i", function(*[F.col(n) for n in names]).alias("r"))
        return [row["r"] for row in sorted(out.collect(), key=lambda row: row["i"])]

    return run
