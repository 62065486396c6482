import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    at = tmp_path_factory.mktemp("spark")
    conf = {"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.local.dir": str(at / "local"), "spark.sql.warehouse.dir": str(at / "warehouse"), "spark.checkpoint.dir": str(at / "shared"), "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
