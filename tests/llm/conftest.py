import glob
import os

import duckdb
import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="session")
def documents(duck):
    """(doc_id, text, lang, source) of the whole test table."""
    return duck.execute("SELECT doc_id, text, lang, source FROM documents").fetchall()


@pytest.fixture(scope="session")
def result(spark, sf_dir):
    """The rows of a registered query as dictionaries, run once."""
    from newsatlas.llm import queries

    done = {}

    def run(name):
        if name not in done:
            done[name] = [r.asDict(recursive=True) for r in queries.QUERIES[name](spark, sf_dir).collect()]
        return done[name]

    return run


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source), with columns of clashing names beside them."""

    def build(rows, empty_columns=False):
        rows = [(*r, None)[:3] for r in rows]
        schema = (
            "doc_id long, text string, source string, size long, key string, share int, bin long, "
            "members array<long>, digest string, node long, component long, block long, score double"
        )
        return spark.createDataFrame([(*r, 1, "k", 1, 1, [1], "d", 1, 1, 1, 0.5) for r in rows], schema)

    return build
