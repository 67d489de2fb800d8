import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsatlas import Feed, schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("newsatlas-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ansi_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


@pytest.fixture
def make(spark):
    """Build a feed table from partial rows; what a row leaves out is NULL."""

    def build(table, *rows):
        schema = schemas.TABLES[table]
        return spark.createDataFrame(
            [tuple(row.get(f.name) for f in schema.fields) for row in rows], schema
        )

    return build


@pytest.fixture
def feed(make):
    def build(events=(), mentions=(), gkg=()):
        return Feed(make("events", *events), make("mentions", *mentions), make("gkg", *gkg))

    return build


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, in the frame's own order."""
    return lambda df: [tuple(r) for r in df.collect()]
