import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))

from gladwire.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)


@pytest.fixture
def one(spark):
    """Value of a column expression for some input values, as a list."""

    def run(values, kind, expression):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r["out"] for r in frame.select("i", expression.alias("out")).orderBy("i").collect()]

    return run
