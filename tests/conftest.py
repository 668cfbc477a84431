import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spanlake-tests-")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(value):
    """A value that compares alike from either engine."""
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return round(value, 9)
    if hasattr(value, "__len__") and not isinstance(value, str):
        return tuple(plain(v) for v in value)
    return value


def same_rows(frame, relation) -> bool:
    names = sorted(frame.columns)
    assert names == sorted(relation.columns)
    ours = sorted((repr(tuple(plain(r[n]) for n in names)) for r in frame.collect()))
    place = [list(relation.columns).index(n) for n in names]
    theirs = sorted(repr(tuple(plain(r[i]) for i in place)) for r in relation.fetchall())
    return ours == theirs
