from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="skyledger-tests-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("skyledger-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .config("spark.sql.legacy.javaCharsets", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def dynamic_overwrite(spark):
    name = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    yield
    spark.conf.set(name, old)
