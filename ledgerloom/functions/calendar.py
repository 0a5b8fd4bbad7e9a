"""Calendar spines built on the executors (``sequence`` + ``explode``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def month_end_of(day: dt.date) -> dt.date:
    """The last day of the day's month."""
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def month_ends(spark: SparkSession, start, end, name: str = "as_of_date") -> DataFrame:
    """Every month end d with start <= d <= end (the reference's snapshot list)."""
    start, end = as_date(start), as_date(end)
    first = start.replace(day=1)
    return (spark.range(1)
            .select(F.explode(F.sequence(F.lit(first), F.lit(end), F.expr("interval 1 month"))).alias("m"))
            .select(F.last_day("m").alias(name))
            .where((F.col(name) >= F.lit(start)) & (F.col(name) <= F.lit(end))))


def quarters(spark: SparkSession, start, end) -> DataFrame:
    """Quarter rows from the quarter of ``start`` through the quarter of ``end``.

    Columns: fiscal_year, fiscal_quarter, fiscal_quarter_name ('FY2024Q1'),
    quarter_start_date (date).
    """
    start, end = as_date(start), as_date(end)
    return (spark.range(1)
            .select(F.explode(F.sequence(F.trunc(F.lit(start), "quarter"), F.trunc(F.lit(end), "quarter"),
                                         F.expr("interval 3 months"))).alias("quarter_start_date"))
            .select(F.year("quarter_start_date").alias("fiscal_year"),
                    F.quarter("quarter_start_date").alias("fiscal_quarter"),
                    F.concat(F.lit("FY"), F.year("quarter_start_date").cast("string"), F.lit("Q"),
                             F.quarter("quarter_start_date").cast("string")).alias("fiscal_quarter_name"),
                    F.col("quarter_start_date")))
