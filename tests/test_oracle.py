"""Every query with an oracle matches DuckDB on the smallest scale factor."""
import pytest

import __spark_entry__ as entry
from fundscope.plans import catalog
from tools.check_oracle import norm
from collections import Counter

# whole grids; tests/test_search.py runs small ones
SLOW = set(catalog.SEARCHES) | {"dt_search", "rf_search", "svc_searched_predict"}
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}
ORACLE = catalog.ORACLE


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb
    from fundscope.sources.tables import TABLE_NAMES
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_matches_duckdb(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    rows, cols = df.collect(), df.columns
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    duck_types = {d[0]: str(d[1]) for d in res.description}
    for c, t in df.dtypes:
        assert SPARK_TO_DUCK.get(t, t) == duck_types[c], (c, t, duck_types[c])
    order = sorted(cols)
    a = Counter(tuple(norm(r[cols.index(c)]) for c in order) for r in rows)
    b = Counter(tuple(norm(r[ocols.index(c)]) for c in order) for r in orows)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(ORACLE) - SLOW))
def test_rows_only_queries_run(spark, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    assert df.count() >= 0
    assert df.columns


def test_every_query_has_stable_schema(spark, sf):
    df = entry.entry(spark)
    assert df.columns == ["goalBin", "campaigns", "successes", "success_rate", "share"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["epoch_to_date", "flatten_struct", "json_round_trip",
                                  "month_counts", "per_year", "filter_since", "csv_round_trip"])
def test_dates_do_not_depend_on_session_time_zone(spark, sf, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = catalog.QUERIES[name](spark, sf)
        rows, cols = df.collect(), df.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    order = sorted(cols)
    a = Counter(tuple(norm(r[cols.index(c)]) for c in order) for r in rows)
    b = Counter(tuple(norm(r[ocols.index(c)]) for c in order) for r in res.fetchall())
    assert a == b
