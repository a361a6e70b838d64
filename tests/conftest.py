import os
import sys
import time
from pathlib import Path

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pytest  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import __spark_entry__  # noqa: F401  the package travels by value

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("cut"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Sorted plain tuples of a DataFrame's columns."""

    def run(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)

    return run
