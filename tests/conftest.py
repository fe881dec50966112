import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("accrete-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def rows(spark):
    """Values of one expression over hand-made rows, in row order."""

    def run(values, schema, expression):
        data = [(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(data, f"i int, {schema}")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]

    return run


@pytest.fixture
def plan():
    """Physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
