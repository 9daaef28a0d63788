import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return c


def rows_of(frame):
    """Rows of a pandas frame, columns by name, in a fixed order and comparable across engines."""

    def plain(v):
        if v is None or str(v) == "<NA>" or v != v:
            return "null"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if hasattr(v, "dtype") and v.dtype.kind in "iu" or isinstance(v, int):
            return str(float(v))
        return repr(round(float(v), 8)) if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False, name=None))
