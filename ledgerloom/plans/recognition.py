"""Commit amortisation and revenue / spend recognition.

S2 stg_commit_spend, S5 stg_commit_revenue, G6 fact_spend_recognition,
G8 fact_revenue_recognition.

Recognition joins the monthly commitment (amortised contract value) with the
monthly consumption (transactions aggregated per contract, party, entity and
month) in a full outer join; a month's recognised amount is the consumption
when there is any, else the amortised commitment.  Both sides are aggregated
before the join, so each side is unique on the join key and no key can be
skewed.  Rows with a null key can never match (NULL = NULL is not true) and
come out one-sided; the shuffle hashes all four keys, so they do not gather
in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_start
from ledgerloom.functions.money import MONEY
from ledgerloom.operators.amortize import amortize_monthly

COMMIT_COLS = [
    "contract_id", "contract_number", "amortization_month", "monthly_amortized_value", "third_party_id",
    "third_party_name", "agreement_type", "contract_type", "contract_description", "contract_currency",
    "total_contract_value", "contract_start_date", "estimated_completion_date", "contract_status",
    "legal_entity_id", "legal_entity_name", "payment_terms",
]

JOIN_KEYS = ["contract_id", "month", "third_party_id", "legal_entity_id"]

# Revenue cost categories, in the reference's column order.
REVENUE_CATEGORIES = ["labor", "compute", "materials", "subcontractor", "equipment", "overhead"]


def stg_commit(contracts: DataFrame, agreement_type: str, method: str = "conserving") -> DataFrame:
    """Contracts of one direction amortised per calendar month."""
    c = contracts.where(F.col("agreement_type") == agreement_type)
    return amortize_monthly(c, "contract_start_date", "estimated_completion_date", "total_contract_value",
                            method=method).select(*COMMIT_COLS)


def stg_commit_revenue(contracts: DataFrame, method: str = "conserving") -> DataFrame:
    return stg_commit(contracts, "Outbound", method)


def stg_commit_spend(contracts: DataFrame, method: str = "conserving") -> DataFrame:
    return stg_commit(contracts, "Inbound", method)


def recognize(commit: DataFrame, consumption: DataFrame) -> DataFrame:
    """Full outer join of commitment and consumption on JOIN_KEYS.

    ``commit`` and ``consumption`` each carry a ``month`` column and the other
    JOIN_KEYS; the result has every column of both, prefixed ``c_`` / ``t_``.
    Each input is read once.  A null key never matches; such rows come out
    one-sided.  They do not pile up in one reducer either: the shuffle hashes
    all four keys together, and each side has one row per key combination.
    """
    c = commit.select(*[F.col(x).alias("c_" + x) for x in commit.columns])
    t = consumption.select(*[F.col(x).alias("t_" + x) for x in consumption.columns])
    cond = [F.col("c_" + k) == F.col("t_" + k) for k in JOIN_KEYS]
    return c.join(t, cond, "full_outer")


# How a row of the resolved recognition came about.
MATCH_STEPS = ["exact", "party", "contract"]


def match_in_steps(commit: DataFrame, consumption: DataFrame) -> DataFrame:
    """Commitment and consumption matched in ranked steps, every row used once.

    First rows that agree on all JOIN_KEYS, then what is left on contract, month
    and party, then on contract and month.  Within a step both sides are ranked
    by entity (then party) and equal ranks meet.  The result is that of
    ``recognize`` (``c_`` / ``t_`` columns) with ``match_step``: a step, or
    ``commit`` / ``consumption`` for rows that met none.

    One exchange by (contract, month) serves all steps, since every window and
    the final grouping are partitioned by these two and more.  A group holds the
    few aggregated rows of one contract and month.  Rows without contract or
    month never match and do not take part.
    """
    sides = []
    for prefix, df in (("c", commit), ("t", consumption)):
        sides.append(df.select(*JOIN_KEYS, F.lit(prefix).alias("side"), F.struct(*df.columns).alias(prefix)))
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    named = both.where("contract_id is not null and month is not null").repartition("contract_id", "month")
    keys = {"exact": ["third_party_id", "legal_entity_id"], "party": ["third_party_id"], "contract": []}
    open_rows = named.withColumn("match_step", F.lit(None).cast("string")).withColumn("nth", F.lit(None).cast("int"))
    order = [F.asc_nulls_last("legal_entity_id"), F.asc_nulls_last("third_party_id")]
    for step in MATCH_STEPS:
        free = F.col("match_step").isNull()
        for k in keys[step]:
            free = free & F.col(k).isNotNull()
        group = ["contract_id", "month", *keys[step], "_free"]
        own = F.row_number().over(Window.partitionBy(*group, "side").orderBy(*order))
        count = lambda side: F.count_if(F.col("side") == side).over(Window.partitionBy(*group))  # noqa: E731, B023
        ranked = open_rows.withColumn("_free", free).withColumn("_nth", own)
        met = F.col("_free") & (F.col("_nth") <= F.least(count("c"), count("t")))
        ranked = ranked.withColumn("_met", met)
        open_rows = (ranked.withColumn("match_step", F.when(F.col("_met"), F.lit(step)).otherwise(F.col("match_step")))
                     .withColumn("nth", F.when(F.col("_met"), F.col("_nth")).otherwise(F.col("nth")))
                     .drop("_free", "_nth", "_met"))
    # A row that met none is alone under its side and its own keys.
    alone = F.when(F.col("side") == "c", F.lit("commit")).otherwise(F.lit("consumption"))
    party = F.when(F.col("match_step").isNull() | F.col("match_step").isin("exact", "party"), F.col("third_party_id"))
    entity = F.when(F.col("match_step").isNull() | (F.col("match_step") == "exact"), F.col("legal_entity_id"))
    paired = (open_rows.groupBy("contract_id", "month", F.coalesce("match_step", alone).alias("match_step"), party.alias("_party"),
                                entity.alias("_entity"), F.coalesce("nth", F.lit(0)).alias("_nth"))
              .agg(F.first("c", ignorenulls=True).alias("c"), F.first("t", ignorenulls=True).alias("t"))
              .select("match_step", "c", "t"))
    never = both.where("contract_id is null or month is null").select(alone.alias("match_step"), "c", "t")
    wide = paired.unionByName(never)
    return wide.select(*(F.col("c").getField(x).alias(f"c_{x}") for x in commit.columns),
                       *(F.col("t").getField(x).alias(f"t_{x}") for x in consumption.columns), "match_step")


def _recognition_select(j: DataFrame, name_col: str, amount_col: str, measures: list[str]) -> DataFrame:
    present = F.col("t_period_transaction_count").isNotNull()
    return j.select(
        F.coalesce("t_month", "c_month").alias("period_month"),
        F.coalesce("t_third_party_id", "c_third_party_id").alias("third_party_id"),
        F.coalesce(f"t_{name_col}", "c_third_party_name").alias("customer_name"),
        F.coalesce("t_legal_entity_id", "c_legal_entity_id").alias("legal_entity_id"),
        F.coalesce("t_legal_entity_name", "c_legal_entity_name").alias("legal_entity_name"),
        F.when(present, F.col(f"t_{amount_col}")).otherwise(F.col("c_monthly_amortized_value"))
        .cast(MONEY).alias("rev_recognized_amount"),
        F.when(present, "consumption_revenue").otherwise("commit_revenue").alias("rev_recognition_indicator"),
        F.col("c_contract_id").alias("contract_id"),
        F.col("c_contract_number").alias("contract_number"),
        F.col("c_monthly_amortized_value").alias("contract_amortization_value"),
        F.col("t_period_transaction_count").alias("period_transaction_count"),
        *[F.col("t_" + m).alias(m) for m in measures],
        F.col("t_contract_id").alias("trx_contract_id"),
        *(["match_step"] if "match_step" in j.columns else []),
    )


def _commit_side(commit: DataFrame) -> DataFrame:
    return commit.select("contract_id", F.col("amortization_month").alias("month"), "third_party_id",
                         "third_party_name", "legal_entity_id", "legal_entity_name", "contract_number",
                         "monthly_amortized_value")


def _sum_money(col: Column, name: str) -> Column:
    return F.sum(col).cast(MONEY).alias(name)


REVENUE_MEASURES = (["rev_sku_all"] + [f"rev_sku_{c}" for c in REVENUE_CATEGORIES]
                    + ["rev_billed_amount", "rev_received_amount", "rev_linear_payments",
                       "rev_nonlinear_payments"])


def revenue_consumption(stg_rev: DataFrame) -> DataFrame:
    """Monthly consumption per (contract, party, entity) from staged revenue."""
    trx_month = month_start("transaction_date")
    paid_month = month_start("payment_received_date")
    amount = F.col("amount")
    return (stg_rev.groupBy("contract_id", "third_party_id", "customer_name",
                            F.col("coa_meta.legal_entity_id").alias("legal_entity_id"),
                            F.col("coa_meta.legal_entity_name").alias("legal_entity_name"),
                            trx_month.alias("month"))
            .agg(F.count("rev_trx_id").alias("period_transaction_count"),
                 _sum_money(amount, "rev_sku_all"),
                 *[_sum_money(F.when(F.col("rev_category") == c, amount), f"rev_sku_{c}")
                   for c in REVENUE_CATEGORIES],
                 _sum_money(F.col("billed_amount"), "rev_billed_amount"),
                 _sum_money(F.when(F.col("payment_received_date").isNotNull(), F.col("billed_amount")),
                            "rev_received_amount"),
                 _sum_money(F.when(trx_month == paid_month, amount), "rev_linear_payments"),
                 _sum_money(F.when(trx_month < paid_month, amount), "rev_nonlinear_payments")))


def fact_revenue_recognition(commit_revenue: DataFrame, stg_rev: DataFrame) -> DataFrame:
    """G8 (with the month truncation fixed, D1; ``trx_contract_id`` keeps the
    consumption side's contract, D4)."""
    j = recognize(_commit_side(commit_revenue), revenue_consumption(stg_rev))
    return _recognition_select(j, "customer_name", "rev_sku_all", REVENUE_MEASURES)


def fact_revenue_recognition_resolved(commit_revenue: DataFrame, stg_rev: DataFrame) -> DataFrame:
    """G8 without double recognition (D5): legal entities may differ where nothing agrees on all keys."""
    j = match_in_steps(_commit_side(commit_revenue), revenue_consumption(stg_rev))
    return _recognition_select(j, "customer_name", "rev_sku_all", REVENUE_MEASURES)


SPEND_MEASURES = ["spend_amount", "spend_linear_payments", "spend_nonlinear_payments"]


def spend_consumption(stg_spend: DataFrame) -> DataFrame:
    po_month = month_start("purchase_order_date")
    paid_month = month_start("payment_date")
    amount = F.col("purchase_order_amount")
    return (stg_spend.groupBy("contract_id", "third_party_id", "supplier_name",
                              F.col("coa_meta.legal_entity_id").alias("legal_entity_id"),
                              F.col("coa_meta.legal_entity_name").alias("legal_entity_name"),
                              po_month.alias("month"))
            .agg(F.count("purchase_order_id").alias("period_transaction_count"),
                 _sum_money(amount, "spend_amount"),
                 _sum_money(F.when(po_month == paid_month, amount), "spend_linear_payments"),
                 _sum_money(F.when(po_month < paid_month, amount), "spend_nonlinear_payments")))


def fact_spend_recognition(commit_spend: DataFrame, stg_spend: DataFrame) -> DataFrame:
    """G6 (month truncation and PO date conversion fixed, D1/D2).  Column names
    follow the reference, including its revenue wording (D6)."""
    j = recognize(_commit_side(commit_spend), spend_consumption(stg_spend))
    return _recognition_select(j, "supplier_name", "spend_amount", SPEND_MEASURES)


def fact_spend_recognition_resolved(commit_spend: DataFrame, stg_spend: DataFrame) -> DataFrame:
    """G6 without double recognition."""
    j = match_in_steps(_commit_side(commit_spend), spend_consumption(stg_spend))
    return _recognition_select(j, "supplier_name", "spend_amount", SPEND_MEASURES)
