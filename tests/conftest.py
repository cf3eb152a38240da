import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df):
        return sorted(map(tuple, df.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def executed_plan():
    """Run a DataFrame and return its final plan, without the initial one."""

    def run(df):
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        return re.split(r"^\+- == Initial Plan ==", text, flags=re.MULTILINE)[0]

    return run
