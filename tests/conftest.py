import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate an expression for each value of a string column ``x``."""

    def run(values, expression):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, x STRING")
        return [row["r"] for row in df.select("i", expression.alias("r")).orderBy("i").collect()]

    return run
