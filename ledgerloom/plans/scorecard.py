"""G7 fact_supplier_scorecard: lead times and min-max scores per supplier.

Supplier aggregates are computed once (partial aggregation map-side, so a
supplier holding a third of all rows is combined before the shuffle); the
global bounds are one aggregate row over that per-supplier table, attached
by a broadcast join on a constant key - not a second pass over the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import day_diff

LEAD_TIMES = {
    "po_to_gr": ("purchase_order_date", "goods_received_date"),
    "po_to_invoice": ("purchase_order_date", "invoice_date"),
    "invoice_to_payment": ("invoice_date", "payment_date"),
    "due_date_to_payment": ("payment_due_date", "payment_date"),
}
# Scores where a shorter time is better are inverted (1 - x), as in the reference.
INVERTED = {"po_to_gr", "due_date_to_payment"}

KEYS = ["third_party_id", "supplier_id", "supplier_name"]


def supplier_lead_times(fact_spend: DataFrame) -> DataFrame:
    on_time = F.to_date("payment_date") <= F.to_date("payment_due_date")
    aggs = []
    for name, (a, b) in LEAD_TIMES.items():
        d = day_diff(a, b)
        aggs += [F.sum(d).alias(f"{name}_sum"), F.count(d).alias(f"{name}_n"),
                 F.min(d).alias(f"{name}_min"), F.max(d).alias(f"{name}_max")]
    return (fact_spend.groupBy(*KEYS)
            .agg(F.count("purchase_order_id").alias("transaction_count"),
                 F.count(F.when(on_time, F.col("purchase_order_id"))).alias("on_time_count"), *aggs))


def _avg(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_n").cast("double"))


def fact_supplier_scorecard(fact_spend: DataFrame) -> DataFrame:
    per = supplier_lead_times(fact_spend)
    # Global bounds: an aggregate without grouping keys has exactly one row, so
    # broadcasting it is bounded by construction.  ``_all`` keeps every column
    # of ``per`` in this branch too; both branches then have the same shuffle,
    # which Spark runs once: one pass over the facts.
    bounds = (per.agg(*[agg(f"{n}_{s}").alias(f"_{n}_{s}") for n in LEAD_TIMES
                        for s, agg in (("min", F.min), ("max", F.max))],
                      F.max(F.struct(*per.columns)).alias("_all"))
              .where(F.col("_all").isNotNull()).drop("_all").withColumn("_one", F.lit(1)))
    joined = per.withColumn("_one", F.lit(1)).join(F.broadcast(bounds), "_one")
    cols = [*KEYS, "transaction_count"]
    scores = []
    for name in LEAD_TIMES:
        lo, hi = F.col(f"_{name}_min"), F.col(f"_{name}_max")
        avg = _avg(name)
        cols.append(avg.alias(name))
        x = F.try_divide(avg - lo.cast("double"), (hi - lo).cast("double"))
        scores.append((F.lit(1.0) - x if name in INVERTED else x).alias(f"{name}_score"))
    on_time = F.try_divide(F.col("on_time_count").cast("double"), F.col("transaction_count").cast("double"))
    return joined.select(*cols, on_time.alias("on_time_payment"), *scores, on_time.alias("on_time_payment_score"))
