import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows given as dicts, to a frame of the given schema; absent columns are null."""

    def make(ddl, rows):
        names = spark.createDataFrame([], ddl).columns
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)

    return make


@pytest.fixture
def evaluate(spark):
    """A column expression applied to each of some values."""
    from pyspark.sql import functions as F

    def run(expression, values, ddl="STRING"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {ddl}")
        return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]

    return run


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
