import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for f in sorted(os.listdir(sf_dir)):
        con.sql(f"create view {f.split('.')[0]} as select * from read_parquet('{sf_dir}/{f}')")
    return con


def canonical(columns, rows):
    """Rows with columns sorted by name and values as comparable text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if v is None or v != v:
            return "~"
        if isinstance(v, float):
            return f"{v:.9g}"
        s = str(v)
        return s.removesuffix(" 00:00:00")

    return sorted(columns), sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def same():
    return canonical
