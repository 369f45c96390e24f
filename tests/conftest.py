from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("ampertide-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ampertide-tests-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = make_session()
    yield session
    session.stop()
