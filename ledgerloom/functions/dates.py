"""Date and calendar columns.

Raw inputs carry epoch seconds; they are converted once, at the silver layer,
with the session time zone pinned to UTC (see ``ledgerloom.session``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col


SECONDS_A_DAY = 86_400


def epoch_to_timestamp(col) -> Column:
    """Epoch seconds (long) -> TimestampType."""
    return F.timestamp_seconds(as_col(col))


def epoch_to_date(col) -> Column:
    """Epoch seconds (long) -> the UTC day, by integer arithmetic: no session time zone takes part."""
    days = F.floor(as_col(col) / F.lit(SECONDS_A_DAY)).cast("int")
    return F.date_add(F.lit(dt.date(1970, 1, 1)), days)


def date_to_epoch(col) -> Column:
    """A day -> epoch seconds of its UTC midnight, by integer arithmetic."""
    return F.datediff(F.to_date(as_col(col)), F.lit(dt.date(1970, 1, 1))).cast("long") * F.lit(SECONDS_A_DAY)


def month_start(col) -> Column:
    """First day of the month, as a date (``trunc(date, 'month')``)."""
    return F.trunc(F.to_date(as_col(col)), "month")


def month_end(col) -> Column:
    return F.last_day(F.to_date(as_col(col)))


def quarter_start(col) -> Column:
    return F.trunc(F.to_date(as_col(col)), "quarter")


def day_diff(start, end) -> Column:
    """``DATE_DIFF(DAY, start, end)``: whole days from start to end."""
    return F.datediff(as_col(end), as_col(start))


def months_touched(start, end) -> Column:
    """Number of calendar months from the month of ``start`` to that of ``end``, inclusive."""
    s, e = as_col(start), as_col(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s)) + 1


def elapsed_months(start, end) -> Column:
    """``int(months_between(end, start) + 1)``: the divisor the reference amortises with."""
    return (F.months_between(as_col(end), as_col(start)) + F.lit(1)).cast("int")


def fiscal_year(col, fy_start_month: int = 1) -> Column:
    """Fiscal year of a date.  ``fy_start_month=1`` is the calendar year.

    A fiscal year starting in month m > 1 is named after the calendar year in
    which it ends (Feb 2024 - Jan 2025 is FY2025).
    """
    d = F.to_date(as_col(col))
    if fy_start_month == 1:
        return F.year(d)
    return F.year(F.add_months(d, 13 - fy_start_month))


def fiscal_quarter(col, fy_start_month: int = 1) -> Column:
    d = F.to_date(as_col(col))
    if fy_start_month == 1:
        return F.quarter(d)
    return F.quarter(F.add_months(d, 13 - fy_start_month))


def quarter_name(year, quarter) -> Column:
    """'FY2024Q3' style key part; null when either part is null."""
    return F.concat(F.lit("FY"), as_col(year).cast("string"), F.lit("Q"),
                    as_col(quarter).cast("string"))
