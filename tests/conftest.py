import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("glossmill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """Records from bodies, optionally (body, headings) pairs."""

    def make(*bodies):
        rows = [b if isinstance(b, tuple) else (b, ["No_Headings"]) for b in bodies]
        return spark.createDataFrame(rows, "body string, headings array<string>")

    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
