import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """DataFrame from rows and a schema; clock texts become timestamps of one day."""
    from pyspark.sql import functions as F

    def make(schema, rows):
        wanted = [part.strip().split() for part in schema.split(",")]
        raw = ", ".join(f"{n} {'string' if k == 'time' else k}" for n, k in wanted)
        df = spark.createDataFrame(rows, raw)
        for name, kind in wanted:
            if kind == "time":
                df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
        return df

    return make


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.01"
