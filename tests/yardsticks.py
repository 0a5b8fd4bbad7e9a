"""Plain, slow forms of two operators: what tests and the benchmark hold the real ones against."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import as_date, month_end_of
from ledgerloom.plans import trial_balance
from ledgerloom.plans.workforce import QUARTER_SHARE, SALARY_SUM


def trial_balances_one_by_one(gl: DataFrame, start, end, run_ts=None) -> DataFrame:
    """A filtered aggregation of the whole ledger for every month end, united."""
    days = [as_date(start) + dt.timedelta(days=k) for k in range((as_date(end) - as_date(start)).days + 1)]
    return reduce(DataFrame.unionByName, (trial_balance.snapshot_at(gl, d, run_ts) for d in days if d == month_end_of(d)))


def quarterly_cost_by_day(employees: DataFrame, as_of) -> DataFrame:
    """A row for every employee and day; an employee counts in each quarter that holds one of the days."""
    until = F.coalesce("termination_date", F.lit(as_of).cast("date"))
    day = F.explode(F.sequence("hire_date", until)).alias("day")
    present = (employees.where(until >= F.col("hire_date")).select("employee_id", "cost_center_id", "legal_entity_id", "salary", day)
               .withColumn("employment_year", F.year("day")).withColumn("employment_quarter", F.quarter("day"))
               .drop("day").distinct())
    return (present.groupBy("employment_year", "employment_quarter", "cost_center_id", "legal_entity_id")
            .agg(F.sum(F.col("salary") * F.lit(QUARTER_SHARE)).cast(SALARY_SUM).alias("agg_qtr_salary")))
