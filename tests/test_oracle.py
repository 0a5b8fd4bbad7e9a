"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.helpers import duck_rows, rows

TABLES = "region nation customer supplier part orders lineitem".split()
QUERIES = dict(entry._load())          # the training-data queries have tests of their own
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    names, expected = duck_rows(con, ORACLE[name])
    assert sorted(df.columns) == names
    assert rows(df) == expected


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "as_of_date" in df.columns


def test_bucket_query_is_deterministic(spark):
    a = QUERIES["r4_invoice_buckets"](spark, SF_SMALL)
    assert rows(a) == rows(QUERIES["r4_invoice_buckets"](spark, SF_SMALL))
    assert a.where("bucket < 0 or bucket >= 100").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data missing")
def test_smoke_data_present():
    assert os.path.exists(f"{SF_SMALL}/orders.parquet")


SPARK_TO_DUCK = {"BIGINT": "BIGINT", "INT": "INTEGER", "STRING": "VARCHAR", "DATE": "DATE", "BOOLEAN": "BOOLEAN",
                 "DOUBLE": "DOUBLE", "TIMESTAMP": "TIMESTAMP", "TIMESTAMP_NTZ": "TIMESTAMP",
                 "ARRAY<STRING>": "VARCHAR[]"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString().upper(), f.dataType.simpleString().upper())
                   for f in df.schema.fields}
    rel = con.sql(ORACLE[name])
    duck_types = {c: str(t).upper() for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types


@pytest.mark.parametrize("name", ["io_raw_round_trip_revenue_billings", "q4_monthly_cash_flow"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        _, expected = duck_rows(con, ORACLE[name])
        assert rows(df) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
