import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    builder = SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
    builder = builder.config("spark.local.dir", folder).config("spark.sql.warehouse.dir", f"{folder}/warehouse").config("spark.checkpoint.dir", f"{folder}/checkpoint")
    session = builder.config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
