import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quire.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck():
    def connect(sf):
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
        return con
    return connect
