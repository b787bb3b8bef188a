import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sentimart.session import build_session
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="sentimart-test-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sentimart-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("events", "pages", "documents", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con
