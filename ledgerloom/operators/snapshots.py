"""Cumulative month-end snapshots ("balance as of each month end").

The reference filters the ledger once per month end (24 scans, 24
aggregations, a 24-way union).  Here:

1. entries are aggregated once to (month end of the entry, dims) - partial
   aggregation runs map-side, so the shuffle carries at most one row per key
   per month per task;
2. running totals per dims key are taken over its months with a window (the
   window input has at most one row per key and month, so a hot key cannot
   overload a task);
3. each running row is valid from its month end until the key's next active
   month; a ``sequence`` of the places of those month ends is exploded in place (a narrow
   generate - no join, no broadcast), emitting exactly one output row per
   (as_of, key) with no re-aggregation.

``snapshot_totals`` answers sums over all keys of such balances without one
row per key and month end: a running row's value enters at its month and leaves
at the key's next active month, so the change at each active month is an event;
events add up per (month, group), and one prefix sum over the few months of each
group gives every month end.

Sum, count, min and max compose this way; null dates drop out of every
snapshot, null dims form their own group (as in ``GROUP BY``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cumulative_snapshots(df: DataFrame, date_col: str, dims: list[str], sums: dict[str, str],
                         start, end, as_of_col: str = "as_of_date",
                         count_col: str | None = "entry_count", first_col: str | None = "first_entry_date",
                         last_col: str | None = "last_entry_date", opening: DataFrame | None = None,
                         derived: dict[str, Column] | None = None) -> DataFrame:
    """Balances of ``sums`` (output name -> input column) at every month end in [start, end].

    Entries after ``end`` are filtered out before any aggregation (pushed
    towards the scan).  ``opening`` (rows of an earlier result at one month end)
    stands for all entries up to then; ``df`` then holds only later ones.
    ``derived`` columns are expressions over a balance's row, made once for all the
    month ends that it stands for.
    """
    start = _date(start)
    end = _date(end)
    keep = F.col(date_col).isNotNull() & (F.col(date_col) <= F.lit(end))
    aggs = [F.sum(src).alias(name) for name, src in sums.items()]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    if first_col:
        aggs.append(F.min(date_col).alias(first_col))
    if last_col:
        aggs.append(F.max(date_col).alias(last_col))
    monthly = df.where(keep).groupBy(*dims, F.last_day(F.col(date_col)).alias("_month_end")).agg(*aggs)
    if opening is not None:
        monthly = monthly.unionByName(opening.select(
            *dims, F.col(as_of_col).alias("_month_end"), *sums, *(c for c in (count_col, first_col, last_col) if c)))
    w = Window.partitionBy(*dims).orderBy("_month_end")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.sum(name).over(running).alias(name) for name in sums]
    if count_col:
        cols.append(F.sum(count_col).over(running).alias(count_col))
    if first_col:
        cols.append(F.min(first_col).over(running).alias(first_col))
    if last_col:
        cols.append(F.max(last_col).over(running).alias(last_col))
    cumulative = monthly.select(*dims, "_month_end", F.lead("_month_end").over(w).alias("_next_month_end"), *cols)
    # Places in the calendar (from 1) this running row stands for: from its own month up to
    # the month before the key's next active month.  Numbers, as months are slow to count up.
    calendar = _month_ends(start, end)
    place = lambda c: F.year(c) * 12 + F.month(c) - F.lit(start.year * 12 + start.month - 1)
    first = F.greatest(place("_month_end"), F.lit(1))
    last = F.least(F.coalesce(place("_next_month_end") - 1, F.lit(len(calendar))), F.lit(len(calendar)))
    # Spark puts off an expression to where it is read, here to every month end, unless it depends on where it runs.
    once = lambda c: F.when(F.spark_partition_id() >= 0, c)
    held = cumulative.where(first <= last).withColumns({n: once(c) for n, c in (derived or {}).items()})
    out = held.select("*", F.explode(F.sequence(first, last)).alias("_place"))
    ends = F.array(*(F.lit(d) for d in calendar or [end]))
    return out.withColumn(as_of_col, F.get(ends, F.col("_place") - 1)).drop("_place", "_month_end", "_next_month_end")


def snapshots_at(df: DataFrame, date_col: str, dims: list[str], sums: dict[str, str], dates: list, as_of_col: str = "as_of_date",
                 count_col: str = "entry_count", first_col: str = "first_entry_date", last_col: str = "last_entry_date") -> DataFrame:
    """Balances of ``sums`` at each of ``dates``, which need not be month ends.

    An entry counts from the first of the dates that is not before it, so the
    plan is that of ``cumulative_snapshots`` with the dates as its calendar.
    """
    days = sorted({_date(d) for d in dates})
    if not days:
        raise ValueError("snapshots_at needs at least one date")
    calendar = F.array(*(F.lit(d) for d in days))
    # The place in the calendar, from 1, of the first date that is not before the entry.
    place = F.when(F.col(date_col) <= F.lit(days[0]), 1)
    for i, d in enumerate(days[1:], 2):
        place = place.when(F.col(date_col) <= F.lit(d), i)
    period = place.alias("_from")
    held = df.where(F.col(date_col) <= F.lit(days[-1])).groupBy(*dims, period).agg(
        *(F.sum(src).alias(name) for name, src in sums.items()), F.count(F.lit(1)).alias(count_col),
        F.min(date_col).alias(first_col), F.max(date_col).alias(last_col))
    w = Window.partitionBy(*dims).orderBy("_from")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = held.select(*dims, "_from", F.lead("_from").over(w).alias("_next"), *(F.sum(n).over(running).alias(n) for n in (*sums, count_col)),
                         F.min(first_col).over(running).alias(first_col), F.max(last_col).over(running).alias(last_col))
    stands = F.slice(calendar, F.col("_from"), F.coalesce("_next", F.lit(len(days) + 1)) - F.col("_from"))
    return totals.select(*dims, *sums, count_col, first_col, last_col, F.explode(stands).alias(as_of_col))


def snapshot_totals(df: DataFrame, date_col: str, dims: list[str], sums: dict[str, str], values: dict[str, Column],
                    start, end, group: list[str] = (), count_of: str | None = None, as_of_col: str = "as_of_date") -> DataFrame:
    """Per month end in [start, end] and ``group`` (some of ``dims``): sums of ``values`` over the keys of ``dims``.

    ``values`` are expressions over a key's running ``sums``; with ``count_of``
    (one of ``dims``) the column ``different`` counts its distinct non-null
    values among the keys that have a balance.  Equal to aggregating
    ``cumulative_snapshots``, with one row per key and active month in place of
    one per key and month end.  A group appears from its first entry on.
    """
    start, end, group = _date(start), _date(end), list(group)
    keep = F.col(date_col).isNotNull() & (F.col(date_col) <= F.lit(end))
    first_end = F.last_day(F.lit(start).cast("date"))
    # Entries before the calendar count at its first month end.
    month = F.greatest(F.last_day(F.col(date_col)), first_end).alias("_month")
    monthly = df.where(keep).groupBy(*dims, month).agg(*(F.sum(src).alias(name) for name, src in sums.items()))
    w = Window.partitionBy(*dims).orderBy("_month")
    running = monthly.select(*dims, "_month", *(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n in sums))
    held = running.select(*dims, "_month", *(v.alias(n) for n, v in values.items()))
    change = lambda n: (F.col(n) - F.coalesce(F.lag(n).over(w), F.lit(0))).alias(n)
    events = held.select(*dims, "_month", *(change(n) for n in values))
    counted = [count_of] if count_of and count_of not in group else []
    # Few rows from here on: one per month, group and counted value.
    by_value = events.groupBy(*group, *counted, "_month").agg(*(F.sum(n).alias(n) for n in values))
    if count_of:
        seen = F.row_number().over(Window.partitionBy(*dict.fromkeys([*group, count_of])).orderBy("_month")) == 1
        by_value = by_value.withColumn("different", F.when(F.col(count_of).isNotNull() & seen, 1).otherwise(0).cast("long"))
    names = [*values, *(["different"] if count_of else [])]
    by_month = by_value.groupBy(*group, "_month").agg(*(F.sum(n).alias(n) for n in names))
    months = Window.partitionBy(*group).orderBy("_month")
    totals = by_month.select(*group, "_month", F.lead("_month").over(months).alias("_next"),
                             *(F.sum(n).over(months.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n in names))
    last = F.coalesce(F.add_months(F.trunc("_next", "month"), -1), F.lit(end.replace(day=1)))
    each = F.explode(F.sequence(F.trunc("_month", "month"), last, F.expr("interval 1 month"))).alias("_start")
    out = (totals.where(F.trunc("_month", "month") <= last).select(*group, *names, each)
           .withColumn(as_of_col, F.last_day("_start")))
    return out.where((F.col(as_of_col) >= F.lit(start)) & (F.col(as_of_col) <= F.lit(end))).select(as_of_col, *group, *names)


def _month_ends(start: dt.date, end: dt.date) -> list[dt.date]:
    """The month ends from that of ``start``'s month to the last one not after ``end``."""
    months = range(start.year * 12 + start.month, end.year * 12 + end.month + 1)
    days = [dt.date(m // 12, m % 12 + 1, 1) - dt.timedelta(days=1) for m in months]
    return [d for d in days if d <= end]


def _date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))
