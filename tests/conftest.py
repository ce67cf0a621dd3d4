import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    made = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[8]")).appName("tests").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
