import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from litloom.runtime import session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = session("tests", cores="8", shuffle=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    return c


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return round(v, 6) if isinstance(v, float) else str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else v

    return sorted(([plain(r[i]) for i in order] for r in rows), key=str)


@pytest.fixture(scope="session")
def agree(spark, duck):
    """Run a query and its SQL and compare names and rows."""

    def check(query, sql):
        df, want = query(spark, DATA), duck.sql(sql)
        assert sorted(df.columns) == sorted(want.columns)
        assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want.fetchall(), want.columns)

    return check
