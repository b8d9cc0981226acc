"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ubeat.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return "" if v is None else str(v)


def _canon(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_id", "window_end", "cnt", "row_num"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(rel.fetchall(), rel.columns)


def test_every_query_runs(spark):
    for name, fn in entry.queries().items():
        if name not in entry.oracle_sql():
            assert fn(spark, SF).count() >= 0


def test_results_do_not_depend_on_session_time_zone(spark):
    names = ["hot_items", "page_counts", "login_fail_sequence", "late_split", "order_pay_pattern"]

    def run():
        return {n: sorted(tuple(str(x) for x in r) for r in entry.queries()[n](spark, SF).collect()) for n in names}
    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other


def test_approx_visitors_close_to_exact(spark):
    exact = dict(entry.queries()["unique_visitors"](spark, SF).collect())
    got = {r.window_end: (r.uv, r.near) for r in entry.queries()["unique_visitors_approx"](spark, SF).collect()}
    assert got == {k: (v, True) for k, v in exact.items()}
