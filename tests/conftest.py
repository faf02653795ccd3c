import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from glean.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[4]").appName("glean-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("glean"))


def one(spark, col, value, dtype="string"):
    """Evaluate a Column expression on a single input value."""
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col.alias("y")).first()["y"]
