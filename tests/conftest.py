from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tillstream.session import DEFAULTS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF


@pytest.fixture
def path(tmp_path):
    """``path("raw")`` → a folder of this test that does not exist yet."""
    return lambda name: str(tmp_path / name)
