"""As-of join: what held for a key on any date.

``as_of`` answers, for every request (key, date), running sums and last values
of the key's states up to and including that date.  Dates are free; nothing is
expanded to a calendar.

1. Requests and states become rows of one table, dealt once by key and block of
   time, so a key with a third of all rows is spread over as many tasks as it has
   blocks, and a request travels once.  Where both come from one table, ``as_of_rows``
   takes its rows as they are, and what lies upstream is made once.
2. Within a block running values are taken by a window over (key, block).  A block's
   sum and last value are carried on to the later blocks by a window over the
   blocks alone, and meet the block's requests in place.

A request without key or date, or before the first state of its key, gets nulls;
those without key or date are spread by their other columns.  States without key
or date never hold.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(requests: DataFrame, states: DataFrame, keys: list[str], request_date: str, state_date: str,
          sums: dict[str, str] = {}, lasts: dict[str, str] = {}, tie: str | None = None, block: str = "month") -> DataFrame:  # noqa: B006
    """``requests`` with ``sums`` and ``lasts`` (output name -> column of ``states``) as of ``request_date``.

    Of several states of one key and date the one with the greatest ``tie`` is
    last (by default the greatest value).  ``block`` is the unit of
    ``date_trunc``, a day or longer, by which a key's rows are cut.
    """
    own = {n: f"_s_{n}" for n in (*sums, *lasts)}
    held = states.select(*keys, F.col(state_date).alias(request_date), *(F.col(c).alias(own[n]) for n, c in {**sums, **lasts}.items()),
                         *([F.col(tie).alias("_tie")] if tie else []), F.lit(False).alias("_request"))
    rows = requests.withColumn("_request", F.lit(True)).unionByName(held, allowMissingColumns=True)
    found = as_of_rows(rows, F.col("_request"), keys, request_date, {n: own[n] for n in sums}, {n: own[n] for n in lasts}, "_tie" if tie else None, block)
    return found.select(*(F.col(c).cast(requests.schema[c].dataType).alias(c) if c in (*keys, request_date) else c for c in requests.columns), *own)


def as_of_rows(rows: DataFrame, asked: Column, keys: list[str], date: str, sums: dict[str, str] = {}, lasts: dict[str, str] = {},  # noqa: B006
               tie: str | None = None, block: str = "month") -> DataFrame:
    """The ``asked`` rows with ``sums`` and ``lasts`` (output name -> column) of the others, up to and including their ``date``.

    Requests and states in one table, with one date; otherwise as ``as_of``.
    """
    known = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, date]])
    # trunc() stays with days, which date_trunc() turns into instants first.
    cut = F.trunc(date, block) if block in ("year", "quarter", "month", "week") else F.to_date(F.date_trunc(block, date))
    spread = F.date_add(F.lit(dt.date(2000, 1, 1)), F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 16)).cast("int"))
    of_state = lambda c: F.when(~F.col("_asked"), F.col(c))
    dealt = rows.where(asked | known).withColumn("_block", F.when(known, cut).otherwise(spread)).repartition(*keys, "_block")
    # The condition holds for all rows.  It keeps every column of the exchange for both of its readers and cannot move
    # below it, so that Spark makes and deals the rows once.
    dealt = (dealt.where(F.xxhash64(*dealt.columns) % 2 + F.spark_partition_id() > -2)
             .withColumn("_asked", asked).withColumn("_known", known))

    daily = dealt.where("_known").groupBy(*keys, "_block", F.col(date).alias("_day")).agg(
        F.max("_asked").alias("_asked"), *(F.sum(of_state(c)).alias(f"_v_{n}") for n, c in sums.items()),
        *(F.max_by(of_state(c), of_state(tie or c)).alias(f"_v_{n}") for n, c in lasts.items()))
    blocks = daily.groupBy(*keys, "_block").agg(
        F.max("_asked").alias("_asked"), *(F.sum(f"_v_{n}").alias(f"_v_{n}") for n in sums),
        *(F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col("_day"))).alias(f"_v_{n}") for n in lasts))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    last = lambda c, w: F.last(c, ignorenulls=True).over(w)
    carried = blocks.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_block").alias("_of"), "_asked",
                            *(F.sum(f"_v_{n}").over(earlier).alias(f"_c_{n}") for n in sums),
                            *(last(f"_v_{n}", earlier).alias(f"_c_{n}") for n in lasts)).where("_asked").drop("_asked")

    # All rows of a day count for its requests, so the frame goes by the date.
    through = Window.partitionBy(*keys, "_block").orderBy(date).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same_day = Window.partitionBy(*keys, "_block", date)
    local = dealt.select("*", *(F.max_by(of_state(c), of_state(tie or c)).over(same_day).alias(f"_v_{n}") for n, c in lasts.items()))
    local = local.select(*rows.columns, "_block", "_asked", "_known", *(F.sum(of_state(c)).over(through).alias(f"_r_{n}") for n, c in sums.items()),
                         *(last(f"_v_{n}", through).alias(f"_r_{n}") for n in lasts)).where("_asked")
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col("_block") == F.col("_of")]
    # A sum of nothing stays null, so that a request before all states can be told from a zero balance.
    total = lambda n: F.coalesce(F.col(f"_r_{n}") + F.col(f"_c_{n}"), f"_r_{n}", f"_c_{n}")
    return local.join(carried, on, "left").select(
        *rows.columns, *(F.when(F.col("_known"), total(n)).alias(n) for n in sums),
        *(F.when(F.col("_known"), F.coalesce(f"_r_{n}", f"_c_{n}")).alias(n) for n in lasts))
