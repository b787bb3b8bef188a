"""Every registered query with an oracle agrees with DuckDB on sf0.001."""

import math

import pytest

import __spark_entry__ as E
from conftest import SMALL

STREAMING = {"stream_tick_silver", "stream_batch_counts", "stream_market_mood_stateful"}  # left to scripts/oracle_check.py


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in recs]
    return sorted(out, key=lambda t: tuple(("0", "") if v is None else ("1", v) for v in t))


from sentimart.oracle import oracle_sql as core_oracle  # noqa: E402
from sentimart.queries import queries as core_queries  # noqa: E402

NAMES = sorted(n for n in core_oracle() if n not in STREAMING)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_every_query_has_an_oracle():
    assert set(core_queries()) == set(core_oracle())
    assert set(core_queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "composite_signal" in df.columns and "hour" in df.columns


def test_jvm_double_rendering_matches_spark_json(spark):
    import duckdb
    from sentimart.oracle_ext import jvm_double
    values = [0.0, 1.0, -2.5, 69.0, 0.001, 0.000999, -0.0009000000000000015, 9.99999999999994e-05,
              1e-10, 123456789.0, 1e7, 9999999.0, 1.5e300, -3.3e-8, 0.1 + 0.2]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    spark_txt = [r[0][5:-1] for r in df.selectExpr("to_json(struct(x))").collect()]   # {"x":<num>}
    con = duckdb.connect()
    duck_txt = [con.execute(f"SELECT {jvm_double('x')} FROM (SELECT CAST(? AS DOUBLE) AS x)", [v]).fetchall()[0][0]
                for v in values]
    assert duck_txt == spark_txt
