import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.legacy.parquet.nanosAsLong", "true")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.debug.maxToStringFields", "2000")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def values(df):
    """Values of a one-column DataFrame, in order of the first column if there are two."""
    return [r[-1] for r in sorted(df.collect(), key=lambda r: r[0])]


def evaluate(spark, expr, data, schema):
    """An expression over numbered rows, as a list in row order."""
    numbered = [(i, *(d if isinstance(d, tuple) else (d,))) for i, d in enumerate(data)]
    df = spark.createDataFrame(numbered, f"i int, {schema}").coalesce(1)
    return values(df.select("i", expr.alias("out")))
