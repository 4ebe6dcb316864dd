import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

# Started here because test modules build columns while they are imported.
SESSION = (
    SparkSession.builder.master("local[8]").appName("relstream-tests")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "8g")
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def split_hard(spark):
    """Treats every frequent key as hot and nothing as small, so that the splitting paths run."""
    forced = {"min_bytes": 0, "min_rows": 3, "broadcast_bytes": -1}
    for name, value in forced.items():
        spark.conf.set(f"relstream.split.{name}", str(value))
    yield
    for name in forced:
        spark.conf.unset(f"relstream.split.{name}")
