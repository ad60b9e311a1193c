"""One Spark session for all tests, and the driver's small tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    """Rows of a DuckDB query over the small tables."""
    import duckdb

    def run(sql, sf_dir=SF):
        con = duckdb.connect()
        for f in os.listdir(sf_dir):
            con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
        return con.sql(sql).df()

    return run


def rows_of(frame):
    """Rows of a pandas frame as sorted tuples of texts, columns by name."""
    cols = sorted(frame.columns)
    return cols, sorted(tuple(str(x) for x in r) for r in frame[cols].itertuples(index=False))


@pytest.fixture(scope="session")
def same():
    def check(a, b):
        assert rows_of(a) == rows_of(b)

    return check
