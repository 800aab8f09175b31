import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ":".join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    conf = {
        "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.local.dir": scratch,
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/checkpoints",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """one(make, value...) evaluates a column made from string values."""
    from pyspark.sql import functions as F

    def run(make, *values):
        df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
        return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]

    return run
