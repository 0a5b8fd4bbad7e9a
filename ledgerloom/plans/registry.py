"""Named queries over the fixture lakehouse: one entry per SURVEY id.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
test tables of that directory.  Audit columns stamped at run time
(``created_timestamp``, ``snapshot_timestamp``, ``created_date``) are left
out of the compared outputs; structs are flattened.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.lakehouse import Lakehouse
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources.fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AUDIT = {"created_timestamp", "snapshot_timestamp", "created_date"}
STATEMENT_DATE = dt.date(2001, 7, 31)


def lakehouse(spark: SparkSession, sf_dir: str, **kw) -> Lakehouse:
    params = dict(as_of=fx.AS_OF, tb_start=fx.TB_START, tb_end=fx.TB_END,
                  scenario_start=fx.SCENARIO_START, scenario_end=fx.SCENARIO_END,
                  budget_overrides=((1999, 2, Decimal("0.85")),))
    inputs = kw.pop("inputs", None) or Fixtures(spark, sf_dir, as_of=fx.AS_OF)
    params.update(kw)
    return Lakehouse(spark, inputs, **params)


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def tabular(df: DataFrame) -> DataFrame:
    from ledgerloom.plans.staging import flatten_coa
    df = flatten_coa(df) if "coa_meta" in df.columns else df
    return df.drop(*[c for c in df.columns if c in AUDIT])
