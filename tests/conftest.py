import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def records(spark):
    """Records (`record_id, ts, tag, fields`) from a list of dicts."""
    import json

    from logloom.operators.parse import json_records

    def make(*rows, tag=None):
        data = [(str(i), tag, json.dumps(r)) for i, r in enumerate(rows)]
        df = spark.createDataFrame(data, "record_id string, tag string, line string")
        return json_records(df.selectExpr("record_id", "timestamp_ntz'2024-01-01' as ts", "tag", "line"))

    return make
