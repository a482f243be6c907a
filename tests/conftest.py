import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidegate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from tidegate import configure

    return configure(session)


@pytest.fixture
def envelope(spark):
    """Build an envelope from (topic, partition, offset, value) rows."""
    from tidegate import ENVELOPE

    def build(rows):
        full = [(t, p, o, None, None, v if v is None or isinstance(v, bytes) else bytearray(v, "utf-8")) for t, p, o, v in rows]
        return spark.createDataFrame(full, ENVELOPE)

    return build
