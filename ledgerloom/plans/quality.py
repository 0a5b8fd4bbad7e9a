"""Data-quality checks (V1-V14 and the extra checks from SURVEY 2.0) and the
re-aimed generator rules R1-R4.  Each check returns a DataFrame of
violations or a small verdict table; none collects to the driver."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import bucket, with_sequence_id
from ledgerloom.functions.money import MONEY, ratio
from ledgerloom.operators.bands import band
from ledgerloom.operators.distinct import as_row, distinct_counts
from ledgerloom.operators.running import running_sum
from ledgerloom.plans import trial_balance
from ledgerloom.plans.registry import lakehouse, query
from ledgerloom.plans.trial_balance import BALANCE
from ledgerloom.sources.fixtures import AS_OF, Fixtures

TOLERANCE = Decimal("0.01")
PCT = dict(places=2, factor=100)


def _b(col):
    return F.sum(col).cast(BALANCE)


# ---------------------------------------------------------------- ledger balance (V1-V3)
def unbalanced_transactions(gl: DataFrame) -> DataFrame:
    """V1: transactions whose debits and credits differ by more than a cent."""
    return (gl.groupBy("transaction_id", "transaction_type")
            .agg(_b("debit_amount").alias("total_debits"), _b("credit_amount").alias("total_credits"))
            .withColumn("variance", (F.col("total_debits") - F.col("total_credits")).cast(BALANCE))
            .where(F.abs("variance") > TOLERANCE))


def ledger_totals(gl: DataFrame) -> DataFrame:
    """V2: one-row verdict, overall debits vs credits."""
    return (gl.agg(_b("debit_amount").alias("total_debits"), _b("credit_amount").alias("total_credits"))
            .withColumn("variance", (F.col("total_debits") - F.col("total_credits")).cast(BALANCE))
            .withColumn("balanced", F.abs("variance") < TOLERANCE))


def month_end_balance(tb: DataFrame) -> DataFrame:
    """V3: per month end, debit balances vs credit balances (flag within a cent), of stored balances or their totals."""
    return (tb.groupBy("as_of_date")
            .agg(_b("debit_balance").alias("total_debits"), _b("credit_balance").alias("total_credits"))
            .withColumn("variance", (F.col("total_debits") - F.col("total_credits")).cast(BALANCE))
            .withColumn("balanced", F.abs("variance") <= TOLERANCE))


@query("v1_unbalanced_transactions")
def v1(spark, sf_dir):
    return unbalanced_transactions(lakehouse(spark, sf_dir).fact_gl_entries)


@query("v2_ledger_totals")
def v2(spark, sf_dir):
    return ledger_totals(lakehouse(spark, sf_dir).fact_gl_entries)


@query("v3_month_end_balance")
def v3(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    return month_end_balance(trial_balance.balance_totals(lh.gl_by_party, lh.tb_start, lh.tb_end))


# ---------------------------------------------------------------- contract coverage and utilisation
def contract_share(df: DataFrame, source: str) -> DataFrame:
    """V4: rows with and without a contract."""
    return (df.agg(F.count(F.lit(1)).alias("total_rows"), F.count("contract_id").alias("with_contract"))
            .select(F.lit(source).alias("source"), "total_rows", "with_contract",
                    (F.col("total_rows") - F.col("with_contract")).alias("without_contract"),
                    ratio("with_contract", "total_rows", places=4, num_places=0, den_places=0)
                    .alias("with_contract_share")))


@query("v4_contract_share")
def v4(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return (contract_share(fx.revenue_transactions, "revenue_transactions")
            .unionByName(contract_share(fx.purchase_orders, "purchase_orders")))


def contract_utilisation(consumption: DataFrame, amount: str, contracts: DataFrame) -> DataFrame:
    """V5: consumption per contract against the contract value."""
    totals = (consumption.where(F.col("contract_id").isNotNull()).groupBy("contract_id")
              .agg(_b(amount).alias("total_consumed")))
    return (totals.join(contracts.select("contract_id", "total_contract_value", "contract_start_date"),
                        "contract_id", "inner")
            .withColumn("utilization_pct", ratio("total_consumed", "total_contract_value", **PCT))
            .withColumn("exceeds_limit", F.col("total_consumed") > F.col("total_contract_value")))


def _revenue_utilisation(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return contract_utilisation(fx.revenue_transactions, "amount", fx.outbound_contracts)


def _spend_utilisation(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return contract_utilisation(fx.purchase_orders, "purchase_order_amount", fx.inbound_contracts)


@query("v5_revenue_contract_utilisation")
def v5r(spark, sf_dir):
    return _revenue_utilisation(spark, sf_dir).drop("contract_start_date")


@query("v5_spend_contract_utilisation")
def v5s(spark, sf_dir):
    return _spend_utilisation(spark, sf_dir).drop("contract_start_date")


@query("v6_top_contracts_by_revenue")
def v6(spark, sf_dir):
    """Top 10 contracts by consumed revenue (a top-k report)."""
    return (_revenue_utilisation(spark, sf_dir).drop("contract_start_date")
            .orderBy(F.col("total_consumed").desc(), "contract_id").limit(10))


# Utilisation bands (percent, upper bound exclusive) and
# contract-age bands (days), with their labels.
UTILISATION_EDGES = [25, 50, 75, 100]
UTILISATION_LABELS = ["0-25%", "25-50%", "50-75%", "75-100%", "Above 100%"]


@query("v7_utilisation_bands")
def v7(spark, sf_dir):
    parts = []
    for name, fn in (("revenue", _revenue_utilisation), ("spend", _spend_utilisation)):
        u = fn(spark, sf_dir)
        parts.append(u.groupBy(F.lit(name).alias("source"),
                               band("utilization_pct", UTILISATION_EDGES, UTILISATION_LABELS).alias("utilization_range"))
                     .agg(F.count(F.lit(1)).alias("contract_count")))
    return parts[0].unionByName(parts[1])


AGE_EDGES = [180, 365, 730]
AGE_LABELS = ["Very New (0-6mo)", "New (6-12mo)", "Older (1-2yr)", "Very Old (2yr+)"]


@query("v8_utilisation_by_contract_age")
def v8(spark, sf_dir):
    u = _spend_utilisation(spark, sf_dir)
    age = F.datediff(F.lit(AS_OF), F.col("contract_start_date"))
    return (u.groupBy(band(age, AGE_EDGES, AGE_LABELS).alias("age_range"))
            .agg(F.count(F.lit(1)).alias("contract_count"), F.min("utilization_pct").alias("min_utilization"),
                 F.sum("utilization_pct").alias("_sum"), F.max("utilization_pct").alias("max_utilization"))
            .withColumn("avg_utilization", ratio("_sum", "contract_count", den_places=0))
            .drop("_sum"))


def _pct_summary(df: DataFrame, pct: str, lo: int, hi: int, name: str) -> DataFrame:
    return (df.agg(F.count(F.lit(1)).alias("checked_rows"), F.min(pct).alias(f"min_{name}"),
                   F.max(pct).alias(f"max_{name}"), F.sum(pct).alias("_sum"),
                   F.count_if((F.col(pct) < lo) | (F.col(pct) > hi)).alias("violations"))
            .withColumn(f"avg_{name}", ratio("_sum", "checked_rows", den_places=0)).drop("_sum"))


def _billing_check(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    trx = fx.revenue_transactions.where(F.col("amount") > 0).select("rev_trx_id", F.col("amount").alias("trx_amount"))
    return (fx.revenue_billings.join(trx, "rev_trx_id", "inner").where(F.col("billed_amount") > 0)
            .withColumn("billed_pct", ratio("billed_amount", "trx_amount", **PCT))
            .withColumn("retention_pct", ratio("retention_amount", "billed_amount", **PCT)))


@query("v9_billed_to_transaction_ratio")
def v9(spark, sf_dir):
    return _pct_summary(_billing_check(spark, sf_dir), "billed_pct", 90, 110, "billed_pct")


@query("v10_retention_ratio")
def v10(spark, sf_dir):
    return _pct_summary(_billing_check(spark, sf_dir), "retention_pct", 0, 10, "retention_pct")


@query("v11_invoice_po_one_to_one")
def v11(spark, sf_dir):
    inv = Fixtures(spark, sf_dir).spend_invoices
    counts = distinct_counts(inv, ["invoice_id", "invoice_number", "purchase_order_id"], dense=["invoice_id", "purchase_order_id"])
    return (as_row(counts, {"invoice_count": ("invoice_id", "n_rows"), "distinct_invoice_ids": ("invoice_id", "different"),
                            "distinct_invoice_numbers": ("invoice_number", "different"),
                            "distinct_purchase_orders": ("purchase_order_id", "different")})
            .withColumn("one_to_one", F.col("invoice_count") == F.col("distinct_purchase_orders")))


@query("v12_invoices_exceeding_po")
def v12(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return (fx.spend_invoices.join(fx.purchase_orders.select("purchase_order_id", "purchase_order_amount"),
                                   "purchase_order_id", "inner")
            .where(F.col("invoice_amount") > F.col("purchase_order_amount"))
            .select("invoice_id", "purchase_order_id", "invoice_amount", "purchase_order_amount"))


@query("v13_key_uniqueness")
def v13(spark, sf_dir):
    """Row count vs distinct keys; a narrow pass per key, bitmaps for numbered ones."""
    fx = Fixtures(spark, sf_dir)
    lh = lakehouse(spark, sf_dir)
    specs = [("raw_coa_hierarchy", fx.coa, ["coa_id"], []), ("dim_all_contracts", lh.dim_all_contracts, ["contract_id"], ["contract_id"]),
             ("raw_spend_invoices", fx.spend_invoices, ["invoice_id", "invoice_number"], ["invoice_id"]),
             ("raw_revenue_transactions", fx.revenue_transactions, ["rev_trx_id"], ["rev_trx_id"]),
             ("raw_purchase_orders", fx.purchase_orders, ["purchase_order_id"], ["purchase_order_id"]),
             ("fact_gl_entries", lh.fact_gl_entries, ["gl_entry_id"], [])]
    out = None
    for t, df, keys, dense in specs:
        part = distinct_counts(df, keys, dense).select(F.lit(t).alias("table_name"), F.col("column").alias("key_column"),
                                                       F.col("n_rows").alias("row_count"), F.col("different").alias("distinct_keys"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("is_unique", F.col("row_count") == F.col("distinct_keys"))


# Yearly contract-value targets per direction (outbound 2 bn, inbound 1 bn).
VALUE_TARGETS = {"Outbound": 2_000_000_000, "Inbound": 1_000_000_000}


@query("v14_contract_value_reconciliation")
def v14(spark, sf_dir):
    c = lakehouse(spark, sf_dir).dim_all_contracts
    target = F.when(F.col("agreement_type") == "Outbound", F.lit(VALUE_TARGETS["Outbound"])) \
        .otherwise(F.lit(VALUE_TARGETS["Inbound"])).cast(BALANCE)
    return (c.groupBy("agreement_type", F.year("contract_start_date").alias("start_year"))
            .agg(_b("total_contract_value").alias("total_value"))
            .withColumn("target_value", target)
            .withColumn("difference", (F.col("total_value") - F.col("target_value")).cast(BALANCE))
            .withColumn("share_of_target", ratio("total_value", "target_value", places=4)))


# ---------------------------------------------------------------- recognition and ledger scope checks
def double_recognised(r: DataFrame) -> DataFrame:
    """Contract-months recognised twice: a commit-only row and an unmatched
    consumption row of the same contract and month (legal entities differ, D5).

    One read of the recognition table: a commit-only row is unique per
    (contract, month), so a window over (contract, month) attaches it to the
    unmatched consumption rows - no self-join; each window partition holds one
    commit row and the few aggregated consumption rows of that month.
    """
    from pyspark.sql import Window

    commit = (F.col("rev_recognition_indicator") == "commit_revenue") & F.col("contract_id").isNotNull()
    unmatched = F.col("contract_id").isNull() & F.col("trx_contract_id").isNotNull()
    tagged = (r.where(commit | unmatched)
              .withColumn("_is_commit", commit)
              .withColumn("_key", F.when(commit, F.col("contract_id")).otherwise(F.col("trx_contract_id"))))
    w = Window.partitionBy("_key", "period_month")
    return (tagged
            .withColumn("commit_amount", F.max(F.when(F.col("_is_commit"), F.col("rev_recognized_amount"))).over(w))
            .withColumn("commit_legal_entity_id", F.max(F.when(F.col("_is_commit"), F.col("legal_entity_id"))).over(w))
            .withColumn("_has_commit", F.max(F.col("_is_commit").cast("int")).over(w))
            .where(~F.col("_is_commit") & (F.col("_has_commit") == 1))
            .select(F.col("_key").alias("contract_id"), "period_month", "commit_amount", "commit_legal_entity_id",
                    F.col("rev_recognized_amount").alias("consumption_amount"),
                    F.col("legal_entity_id").alias("consumption_legal_entity_id")))


@query("v15_double_recognised_contract_months")
def v15(spark, sf_dir):
    return double_recognised(lakehouse(spark, sf_dir).fact_revenue_recognition)


@query("v15_match_steps")
def v15_steps(spark, sf_dir):
    """How the resolved recognition came about: rows and amounts by direction and step, and what is still recognised twice."""
    lh = lakehouse(spark, sf_dir)
    out = None
    for direction, r in (("revenue", lh.fact_revenue_recognition_resolved), ("spend", lh.fact_spend_recognition_resolved)):
        part = r.groupBy(F.lit(direction).alias("direction"), "match_step").agg(
            F.count(F.lit(1)).alias("row_count"), _b("rev_recognized_amount").alias("recognized_amount"),
            _b("contract_amortization_value").alias("amortized_value"))
        out = part if out is None else out.unionByName(part)
    return out


def _unpivot_counts(row: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """One-row aggregate -> one row per named count (narrow explode)."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias(label), F.col(n).alias(value))
                                          for n in names])).alias("_r")).select("_r.*")


@query("v16_ledger_scope_exclusions")
def v16(spark, sf_dir):
    """Rows the ledger's positive-amount and status filters leave out (credit
    notes, refunds, zero payments, cancelled or status-less invoices); one
    scan per staging table."""
    lh = lakehouse(spark, sf_dir)
    rev, spend = lh.stg_revenue_transactions, lh.stg_spend_transactions
    r = rev.agg(F.count_if(F.col("invoice_date").isNotNull() & (F.col("billed_amount") <= 0))
                .alias("revenue_invoice_non_positive"))
    s = spend.agg(
        F.count_if(F.col("invoice_date").isNotNull() & (F.col("total_invoice_amount") <= 0))
        .alias("spend_invoice_non_positive"),
        F.count_if(F.col("invoice_status") == "cancelled").alias("spend_invoice_cancelled"),
        F.count_if(F.col("invoice_id").isNotNull() & F.col("invoice_status").isNull()).alias("spend_invoice_null_status"),
        F.count_if(F.col("payment_date").isNotNull() & (F.col("amount_paid") <= 0)).alias("spend_payment_non_positive"))
    return (_unpivot_counts(r, r.columns, "exclusion", "row_count")
            .unionByName(_unpivot_counts(s, s.columns, "exclusion", "row_count")))


@query("v17_retained_receivables")
def v17(spark, sf_dir):
    """Receivable left open by retention: paid billings credit AR net of retention."""
    rev = lakehouse(spark, sf_dir).stg_revenue_transactions
    paid = rev.where(F.col("payment_received_date").isNotNull() & (F.col("billed_amount") > 0))
    return (paid.groupBy(F.col("coa_meta.legal_entity_id").alias("legal_entity_id"))
            .agg(F.count(F.lit(1)).alias("paid_billings"),
                 _b(F.coalesce("retention_amount", F.lit(Decimal("0")).cast(MONEY))).alias("retained_ar")))


# ---------------------------------------------------------------- re-aimed generator rules
def contract_drawdown(consumption: DataFrame, contracts: DataFrame, amount: str, id_col: str,
                      date_col: str) -> DataFrame:
    """Running consumption per contract in (date, id) order, value remaining
    before each row, the amount that fits under the cap, and the first row that
    crosses it.  Skew-safe two-level prefix sum (``running_sum``)."""
    rows = (consumption.where(F.col("contract_id").isNotNull())
            .select("contract_id", id_col, date_col, F.col(amount).cast(MONEY).alias("amount"))
            .join(contracts.select("contract_id", "total_contract_value"), "contract_id", "inner"))
    run = running_sum(rows, "contract_id", date_col, [id_col], "amount", "cumulative_amount", split_by=id_col)
    before = F.col("cumulative_amount") - F.col("amount")
    remaining = (F.col("total_contract_value") - before)
    return run.select(
        "contract_id", id_col, date_col, "amount", F.col("cumulative_amount").cast(BALANCE).alias("cumulative_amount"),
        remaining.cast(BALANCE).alias("remaining_before"),
        F.greatest(F.least(F.col("amount"), remaining), F.lit(0)).cast(BALANCE).alias("capped_amount"),
        ((F.col("cumulative_amount") > F.col("total_contract_value"))
         & (before <= F.col("total_contract_value"))).alias("first_over_cap"))


@query("r1_revenue_contract_drawdown")
def r1(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return contract_drawdown(fx.revenue_transactions, fx.outbound_contracts, "amount", "rev_trx_id",
                             "transaction_date")


@query("r1_spend_contract_drawdown")
def r1s(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return contract_drawdown(fx.purchase_orders, fx.inbound_contracts, "purchase_order_amount", "purchase_order_id",
                             "purchase_order_date")


INVOICE_AGE_EDGES, INVOICE_AGE_LABELS = [0, 7, 30, 60], ["not yet due", "0-6 days", "7-29 days", "30-59 days",
                                                         "60+ days"]
ORDER_AGE_EDGES, ORDER_AGE_LABELS = [0, 7, 30, 90], ["future", "0-6 days", "7-29 days", "30-89 days", "90+ days"]


@query("r2_payables_ageing")
def r2_ap(spark, sf_dir):
    """R2: open supplier invoices (not paid, not cancelled) by days since invoice."""
    inv = Fixtures(spark, sf_dir).spend_invoices.where(
        ~F.coalesce(F.col("invoice_status").isin("paid", "cancelled"), F.lit(False)))
    age = F.datediff(F.lit(AS_OF), F.col("invoice_date"))
    return (inv.groupBy(band(age, INVOICE_AGE_EDGES, INVOICE_AGE_LABELS).alias("age_band"))
            .agg(F.count(F.lit(1)).alias("invoice_count"),
                 _b(F.col("total_invoice_amount") - F.col("amount_paid")).alias("outstanding_amount")))


@query("r2_receivables_ageing")
def r2_ar(spark, sf_dir):
    """R2: unpaid customer billings by days past the payment due date."""
    b = Fixtures(spark, sf_dir).revenue_billings.where(F.col("payment_received_date").isNull())
    age = F.datediff(F.lit(AS_OF), F.col("payment_due_date"))
    return (b.groupBy(band(age, INVOICE_AGE_EDGES, INVOICE_AGE_LABELS).alias("age_band"))
            .agg(F.count(F.lit(1)).alias("billing_count"), _b("billed_amount").alias("outstanding_amount")))


@query("r2_purchase_order_ageing")
def r2_po(spark, sf_dir):
    """R2: purchase orders by age (7 / 30 / 90 days) and status."""
    po = Fixtures(spark, sf_dir).purchase_orders
    age = F.datediff(F.lit(AS_OF), F.col("purchase_order_date"))
    return (po.groupBy(band(age, ORDER_AGE_EDGES, ORDER_AGE_LABELS).alias("age_band"), "purchase_order_status")
            .agg(F.count(F.lit(1)).alias("po_count"), _b("purchase_order_amount").alias("po_amount")))


@query("r3_invoice_arithmetic_violations")
def r3(spark, sf_dir):
    """Invoices whose total differs from amount + tax - discount."""
    inv = Fixtures(spark, sf_dir).spend_invoices
    expected = (F.col("invoice_amount") + F.coalesce("tax_amount", F.lit(0)) - F.coalesce("discount_amount", F.lit(0)))
    return (inv.select("invoice_id", "invoice_amount", "tax_amount", "discount_amount", "total_invoice_amount",
                       expected.cast(MONEY).alias("expected_total"))
            .where(~F.col("total_invoice_amount").eqNullSafe(F.col("expected_total"))))


@query("r4_invoice_buckets")
def r4(spark, sf_dir):
    """Deterministic 100-way bucket per invoice (sampling / A-B splits)."""
    inv = Fixtures(spark, sf_dir).spend_invoices
    return inv.select("invoice_id", bucket(F.col("invoice_id"), "status", 100).alias("bucket"))


@query("w2_customer_sequence_keys")
def w2(spark, sf_dir):
    """Dense surrogate keys in customer order from a start offset, without a
    one-partition global sort."""
    c = Fixtures(spark, sf_dir).customers.select("customer_id", "customer_name")
    block = F.floor(F.col("customer_id") / 100_000)
    return with_sequence_id(c, ["customer_id"], block, start=20000001, name="customer_key")


@query("so3_supplier_only_parties")
def so3(spark, sf_dir):
    """SO3: parties that supply but are not customers (set difference)."""
    fx = Fixtures(spark, sf_dir)
    return fx.suppliers.select("third_party_id").subtract(fx.customers.select("third_party_id"))


@query("a13_billing_amount_statistics")
def a13(spark, sf_dir):
    """Count / min / max / mean / stddev of billed and retention amounts in
    one scan.  Mean is exact (half-up to the cent); stddev is reported to the cent."""
    b = Fixtures(spark, sf_dir).revenue_billings
    measures = ("billed_amount", "retention_amount")
    stats = []
    for col in measures:
        stats += [F.count(col).alias(f"{col}__n"), F.min(col).alias(f"{col}__min"), F.max(col).alias(f"{col}__max"),
                  ratio(F.sum(col), F.count(col), den_places=0).cast(MONEY).alias(f"{col}__mean"),
                  F.stddev_samp(F.col(col).cast("double")).cast(MONEY).alias(f"{col}__sd")]
    row = b.agg(*stats)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(f"{c}__n").alias("row_count"), F.col(f"{c}__min").alias("min_value"),
                 F.col(f"{c}__max").alias("max_value"), F.col(f"{c}__mean").alias("mean_value"),
                 F.col(f"{c}__sd").alias("stddev_value")) for c in measures])).alias("_r")).select("_r.*")


@query("v18_amounts_repeated_by_documents")
def v18(spark, sf_dir):
    """Transactions with several billings and orders with several invoices, and
    the amount that sums over staging would count again (D23)."""
    fx = Fixtures(spark, sf_dir)

    def repeated(source, base, amount, documents, key):
        extra = documents.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("extra")).where("extra > 0")
        found = base.select(key, F.col(amount).alias("amount")).join(extra, key)
        return found.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("row_count"),
                         F.coalesce(F.sum(F.col("amount") * F.col("extra").cast("decimal(10,0)")), F.lit(0)).cast(BALANCE)
                         .alias("repeated_amount"))

    return repeated("revenue", fx.revenue_transactions, "amount", fx.revenue_billings, "rev_trx_id").unionByName(
        repeated("spend", fx.purchase_orders, "purchase_order_amount", fx.spend_invoices, "purchase_order_id"))
