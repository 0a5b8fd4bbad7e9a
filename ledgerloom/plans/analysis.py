"""Analytical queries Q1-Q36 of the reference's notebooks, over the gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import MONEY, ratio
from ledgerloom.operators.asof import as_of_rows
from ledgerloom.operators.distinct import as_row, distinct_counts
from ledgerloom.plans import ledger, recognition, statements, trial_balance, workforce
from ledgerloom.plans.registry import STATEMENT_DATE, lakehouse, query, tabular
from ledgerloom.plans.trial_balance import BALANCE
from ledgerloom.sources.fixtures import AS_OF, Fixtures


def _b(col) -> F.Column:
    return F.sum(col).cast(BALANCE)


def _gl(spark, sf_dir) -> DataFrame:
    return lakehouse(spark, sf_dir).fact_gl_entries


def _gl_accounts(spark, sf_dir, *accounts) -> DataFrame:
    """Ledger rows of the given accounts only (legs chosen up front)."""
    lh = lakehouse(spark, sf_dir)
    return ledger.gl_for_accounts(lh.stg_revenue_transactions, lh.stg_spend_transactions, list(accounts), lh.run_ts)


def _latest_tb(spark, sf_dir) -> DataFrame:
    """Rows of the latest trial-balance snapshot, computed as one aggregation."""
    lh = lakehouse(spark, sf_dir)
    return trial_balance.latest_snapshot(lh.gl_by_party, lh.tb_start, lh.tb_end, lh.run_ts)


def _tb_at(spark, sf_dir, as_of) -> DataFrame:
    lh = lakehouse(spark, sf_dir)
    return trial_balance.trial_balance_at(lh.gl_by_party, as_of, lh.tb_start, lh.tb_end, lh.run_ts)


# ---------------------------------------------------------------- ledger (Q1-Q7)
@query("q1_gl_date_range_by_account")
def q1(spark, sf_dir):
    return (_gl(spark, sf_dir).groupBy("account_name", "account_number")
            .agg(F.min("gl_date").alias("first_gl_date"), F.max("gl_date").alias("last_gl_date"),
                 F.count_if(F.col("gl_date").isNull()).alias("null_gl_dates")))


@query("q2_account_summary")
def q2(spark, sf_dir):
    return (_gl(spark, sf_dir).groupBy("account_number", "account_name")
            .agg(F.count(F.lit(1)).alias("entry_count"), _b("debit_amount").alias("total_debits"),
                 _b("credit_amount").alias("total_credits"))
            .withColumn("net_balance", (F.col("total_debits") - F.col("total_credits")).cast(BALANCE)))


@query("q3_transaction_type_summary")
def q3(spark, sf_dir):
    return (_gl(spark, sf_dir).groupBy("transaction_type")
            .agg(F.count_distinct("transaction_id").alias("transaction_count"),
                 F.count(F.lit(1)).alias("gl_entry_count"), _b("debit_amount").alias("total_debits"),
                 _b("credit_amount").alias("total_credits")))


@query("q4_monthly_cash_flow")
def q4(spark, sf_dir):
    return (_gl_accounts(spark, sf_dir, 1000)
            .groupBy(F.trunc("gl_date", "month").alias("month"))
            .agg(_b("debit_amount").alias("cash_in"), _b("credit_amount").alias("cash_out"))
            .withColumn("net_cash_flow", (F.col("cash_in") - F.col("cash_out")).cast(BALANCE)))


def _account_flows(spark, sf_dir, account, inc, dec, names):
    gl = _gl_accounts(spark, sf_dir, account)
    return (gl.agg(_b(inc).alias(names[0]), _b(dec).alias(names[1]))
            .withColumn(names[2], (F.col(names[0]) - F.col(names[1])).cast(BALANCE)))


@query("q5_accounts_receivable_summary")
def q5(spark, sf_dir):
    return _account_flows(spark, sf_dir, 1100, "debit_amount", "credit_amount",
                          ("ar_increases", "ar_decreases", "outstanding_ar"))


@query("q6_accounts_payable_summary")
def q6(spark, sf_dir):
    return _account_flows(spark, sf_dir, 2000, "credit_amount", "debit_amount",
                          ("ap_increases", "ap_decreases", "outstanding_ap"))


@query("q7_revenue_by_category")
def q7(spark, sf_dir):
    return (_gl_accounts(spark, sf_dir, 4000)
            .groupBy("category").agg(_b("credit_amount").alias("total_revenue")))


# ---------------------------------------------------------------- trial balance (Q8-Q16)
@query("q8_account_balances_by_month_end")
def q8(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    payables = ledger.gl_by_party(lh.stg_revenue_transactions, lh.stg_spend_transactions, lh.run_ts, [2000])
    tb = trial_balance.fact_gl_trial_balances(payables, spark, lh.tb_start, lh.tb_end, lh.run_ts)
    return (tb
            .groupBy("as_of_date", "account_name", "account_number")
            .agg(*[_b(c).alias(c) for c in ("total_credits", "total_debits", "net_balance", "debit_balance",
                                             "credit_balance")]))


def _totals(spark, sf_dir, group, count_of=None) -> DataFrame:
    lh = lakehouse(spark, sf_dir)
    found = trial_balance.balance_totals(lh.gl_by_party, lh.tb_start, lh.tb_end, group, count_of)
    return (found.drop("net_balance").withColumnRenamed("debit_balance", "total_debit_balance")
            .withColumnRenamed("credit_balance", "total_credit_balance"))


@query("q9_monthly_balance_summary")
def q9(spark, sf_dir):
    return _totals(spark, sf_dir, [], "account_number").withColumnRenamed("different", "account_count")


@query("q10_latest_by_account_type")
def q10(spark, sf_dir):
    return (_latest_tb(spark, sf_dir).groupBy("account_type")
            .agg(F.count_distinct("account_number").alias("account_count"),
                 _b("debit_balance").alias("total_debit_balance"), _b("credit_balance").alias("total_credit_balance"),
                 F.sum("entry_count").alias("total_entries")))


@query("q11_top_balances_latest")
def q11(spark, sf_dir):
    """Top 10 balances of the latest snapshot (a top-k report; ties broken by key)."""
    t = _latest_tb(spark, sf_dir).withColumn(
        "total_balance", (F.col("debit_balance") + F.col("credit_balance")).cast(BALANCE))
    return (t.orderBy(F.col("total_balance").desc(), F.col("account_number").asc_nulls_last(),
                      F.col("legal_entity_id").asc_nulls_last(), F.col("cost_center_id").asc_nulls_last(),
                      F.col("category").asc_nulls_last(), F.col("third_party_id").asc_nulls_last())
            .limit(10)
            .select("account_number", "account_name", "account_type", "total_balance", "legal_entity_name",
                    "cost_center_name"))


def _latest_by(spark, sf_dir, key, extra_filter=None):
    t = _latest_tb(spark, sf_dir)
    if extra_filter is not None:
        t = t.where(extra_filter)
    return (t.groupBy(key, "account_type")
            .agg(_b("debit_balance").alias("total_debit_balance"), _b("credit_balance").alias("total_credit_balance")))


@query("q12_latest_by_entity_and_type")
def q12(spark, sf_dir):
    return _latest_by(spark, sf_dir, "legal_entity_name")


@query("q13_trend_by_month_end_and_type")
def q13(spark, sf_dir):
    return _totals(spark, sf_dir, ["account_type"])


@query("q14_latest_by_cost_center")
def q14(spark, sf_dir):
    return _latest_by(spark, sf_dir, "cost_center_name", F.col("cost_center_name").isNotNull())


@query("q15_balance_sheet")
def q15(spark, sf_dir):
    return statements.balance_sheet(_tb_at(spark, sf_dir, STATEMENT_DATE), STATEMENT_DATE)


@query("q16_income_statement")
def q16(spark, sf_dir):
    return statements.income_statement(_tb_at(spark, sf_dir, STATEMENT_DATE), STATEMENT_DATE)


# ---------------------------------------------------------------- balances on any date
@query("j19_payables_at_due_date")
def j19(spark, sf_dir):
    """What was owed to each invoice's supplier on the invoice's due date, of the payables account."""
    rows = ledger.invoices_and_payables(lakehouse(spark, sf_dir).stg_spend_transactions, "payment_due_date")
    # A leg is a debit or a credit, so the difference has no more digits than either.
    owed = (F.coalesce("credit_amount", F.lit(0)) - F.coalesce("debit_amount", F.lit(0))).cast(MONEY).alias("owed")
    asked = F.col("transaction_type") == ledger.INVOICE_ITSELF
    # A leg travels without the number of its invoice, which nobody asks for.
    rows = rows.select(F.when(asked, F.col("invoice_id")).alias("invoice_id"), "third_party_id", "gl_date", asked.alias("asked"), owed, F.lit(1).alias("one"))
    found = as_of_rows(rows, F.col("asked"), ["third_party_id"], "gl_date",
                       sums={"payables": "owed", "entry_count": "one"}, lasts={"last_entry_date": "gl_date"})
    return found.select("invoice_id", "third_party_id", F.col("gl_date").alias("payment_due_date"),
                        F.col("payables").cast(BALANCE).alias("payables"), "entry_count", "last_entry_date")


SNAPSHOT_DAYS = [dt.date(1999, 12, 15), dt.date(2000, 2, 29), dt.date(2000, 3, 1), dt.date(2001, 1, 10)]


@query("j19_trial_balances_at_dates")
def j19_dates(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    return tabular(trial_balance.trial_balances_at(lh.gl_by_party, SNAPSHOT_DAYS, lh.run_ts))


# ---------------------------------------------------------------- revenue (Q17-Q22)
@query("q17_revenue_by_month_and_entity")
def q17(spark, sf_dir):
    return (lakehouse(spark, sf_dir).fact_revenue_recognition.groupBy("period_month", "legal_entity_name")
            .agg(_b("rev_recognized_amount").alias("rev_recognized_amount"), _b("rev_sku_all").alias("rev_sku_all"),
                 _b("contract_amortization_value").alias("contract_amortization_value")))


SAMPLE_CUSTOMER, SAMPLE_DAY = 20000005, dt.date(1996, 1, 2)


@query("q18_customer_day_transactions")
def q18(spark, sf_dir):
    s = lakehouse(spark, sf_dir).stg_revenue_transactions
    return tabular(s.where((F.col("customer_id") == SAMPLE_CUSTOMER) & (F.col("transaction_date") == SAMPLE_DAY)))


@query("q19_category_count_frequency")
def q19(spark, sf_dir):
    base = (lakehouse(spark, sf_dir).stg_revenue_transactions.groupBy("customer_id")
            .agg(F.count_distinct("rev_category").alias("rev_count")))
    return base.groupBy("rev_count").agg(F.count("customer_id").alias("freq"))


LISTING_FROM = dt.date(1999, 6, 1)


@query("q20_recognition_listing")
def q20(spark, sf_dir):
    """Recognition rows from a month on, in the reference's order (no row cap)."""
    return (lakehouse(spark, sf_dir).fact_revenue_recognition.where(F.col("period_month") >= LISTING_FROM)
            .orderBy("period_month", F.col("third_party_id").desc(), "contract_id"))


@query("q21_recognition_explorer")
def q21(spark, sf_dir):
    """The explorer's ad-hoc recognition join: elapsed-month commit (as committed) and
    month-truncated consumption, showing both sides' months."""
    lh = lakehouse(spark, sf_dir)
    commit = recognition.stg_commit_revenue(lh.dim_all_contracts, method="elapsed")
    j = recognition.recognize(recognition._commit_side(commit),
                              recognition.revenue_consumption(lh.stg_revenue_transactions))
    return j.select(
        F.coalesce("t_month", "c_month").alias("period_month"),
        F.coalesce("t_third_party_id", "c_third_party_id").alias("third_party_id"),
        F.coalesce("t_customer_name", "c_third_party_name").alias("customer_name"),
        F.coalesce("t_legal_entity_id", "c_legal_entity_id").alias("legal_entity_id"),
        F.coalesce("t_legal_entity_name", "c_legal_entity_name").alias("legal_entity_name"),
        F.col("c_contract_id").alias("contract_id"), F.col("c_contract_number").alias("contract_number"),
        F.col("c_monthly_amortized_value").alias("monthly_amortized_value"),
        F.col("t_month").alias("trx_period_month"),
        F.col("t_period_transaction_count").alias("period_transaction_count"),
        *[F.col("t_" + m).alias(m) for m in recognition.REVENUE_MEASURES])


@query("q22_customer_consumption_trend")
def q22(spark, sf_dir):
    """3-month moving comparison per customer (null history counts as 'decreasing').

    The window holds one row per customer and month, so its partitions stay
    small even for a customer with a third of all transactions.
    """
    s4 = lakehouse(spark, sf_dir).stg_consumption_revenue(base_year=1999)
    base = (s4.groupBy(F.trunc("transaction_date", "month").alias("month"), "customer_id", "customer_name",
                       "platform")
            .agg(F.sum("fab_amount").cast(BALANCE).alias("fab_amount")))
    w = Window.partitionBy("customer_id").orderBy("month")
    lags = F.lag("fab_amount", 1).over(w) + F.lag("fab_amount", 2).over(w) + F.lag("fab_amount", 3).over(w)
    return base.withColumn("trend", F.when(F.col("fab_amount") * 3 > lags, "increasing").otherwise("decreasing"))


# ---------------------------------------------------------------- planning (Q23-Q25)
@query("q23_salary_cost_by_quarter")
def q23(spark, sf_dir):
    q = workforce.employee_quarters(lakehouse(spark, sf_dir).dim_employees, AS_OF)
    return (q.groupBy("employment_year", "employment_quarter")
            .agg(F.sum("quarterly_salary").cast(workforce.SALARY_SUM).alias("salary_cost")))


@query("q24_forecast_vs_actual")
def q24(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    plan = lh.fpa_plan.select("scenario_key", "actual_amount", "forecast_amount")
    return (lh.dim_fpa_scenarios.join(plan, "scenario_key", "left")
            .select("fiscal_year", "fiscal_quarter", "scenario_key", "cost_center_id", "cost_center_name",
                    "legal_entity_id", "legal_entity_name", "forecast_amount", "actual_amount",
                    ratio("actual_amount", "forecast_amount", places=4).alias("forecast_accuracy")))


@query("q25_cost_vs_revenue_by_quarter")
def q25(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    actuals = (lh.fact_fpa_actuals.groupBy("fiscal_year", "fiscal_quarter")
               .agg(_b("actual_amount").alias("actual_amount")))
    rev = (lh.stg_revenue_transactions
           .groupBy(F.year("transaction_date").alias("fiscal_year"), F.quarter("transaction_date").alias("fiscal_quarter"))
           .agg(_b("amount").alias("rev_amount")))
    return actuals.join(rev, ["fiscal_year", "fiscal_quarter"], "inner")


# ---------------------------------------------------------------- parties (Q26-Q28)
@query("q26_party_key_cardinality")
def q26(spark, sf_dir):
    keys = {"third_party_id": ("third_party_count", "distinct_third_parties"), "supplier_id": ("supplier_count", "distinct_suppliers"),
            "customer_id": ("customer_count", "distinct_customers")}
    counts = distinct_counts(lakehouse(spark, sf_dir).dim_third_party, list(keys), dense=list(keys))
    return as_row(counts, {n: (c, kind) for c, names in keys.items() for n, kind in zip(names, ("known", "different"), strict=True)})


def _names_of_several(df, key, one, name, out):
    """Names of the ``one``s of every key that has several: the keys first, then only their names."""
    several = df.groupBy(key).agg(F.count_distinct(one).alias("n")).where("n > 1").select(key)
    return (df.join(several, key, "left_semi").groupBy(key)
            .agg(F.sort_array(F.collect_list(name)).alias(out)))


@query("q27_multi_customer_parties_that_supply")
def q27(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cust = fx.customers.join(fx.suppliers.select("third_party_id"), "third_party_id", "left_semi")
    return _names_of_several(cust, "third_party_id", "customer_id", "customer_name", "customer_names")


@query("q28_multi_supplier_parties")
def q28(spark, sf_dir):
    return _names_of_several(Fixtures(spark, sf_dir).suppliers, "third_party_id", "supplier_id", "supplier_name",
                             "supplier_names")


# ---------------------------------------------------------------- raw data profiles (Q29-Q36)
@query("q29_invoices_by_year_and_po")
def q29(spark, sf_dir):
    inv = Fixtures(spark, sf_dir).spend_invoices
    return (inv.groupBy(F.year("invoice_date").alias("invoice_year"),
                        F.col("purchase_order_id").isNotNull().alias("has_purchase_order"))
            .agg(F.count(F.lit(1)).alias("invoice_count"), _b("total_invoice_amount").alias("inv_amount")))


@query("q30_transactions_by_year")
def q30(spark, sf_dir):
    t = Fixtures(spark, sf_dir).revenue_transactions
    return (t.groupBy(F.year("transaction_date").alias("year"))
            .agg(F.count(F.lit(1)).alias("transaction_count"), _b("amount").alias("total_amount")))


@query("q31_billings_by_year")
def q31(spark, sf_dir):
    b = Fixtures(spark, sf_dir).revenue_billings
    return (b.groupBy(F.year("invoice_date").alias("year"))
            .agg(F.count(F.lit(1)).alias("billing_count"), _b("billed_amount").alias("total_billed")))


@query("q32_distinct_agreement_types")
def q32(spark, sf_dir):
    return lakehouse(spark, sf_dir).stg_commit_revenue.select("agreement_type").distinct()


@query("q33_contract_value_by_start_year")
def q33(spark, sf_dir):
    c = lakehouse(spark, sf_dir).dim_all_contracts
    return (c.groupBy("agreement_type", F.year("contract_start_date").alias("start_year"))
            .agg(F.count(F.lit(1)).alias("contract_count"), _b("total_contract_value").alias("total_value")))


@query("q34_attribute_distributions")
def q34(spark, sf_dir):
    """Row counts per value of the categorical attributes the generators profile.

    One scan per table: each row emits its (attribute, value) pairs through an
    explode (payment method only for paid invoices), then one aggregation.
    """
    fx = Fixtures(spark, sf_dir)
    lh = lakehouse(spark, sf_dir)
    paid = F.col("invoice_status") == "paid"
    specs = [
        (lh.dim_all_contracts, [("contract_status", "contract_status", None),
                                ("contract_type", "contract_type", None)]),
        (fx.revenue_transactions, [("cost_category", "cost_category", None)]),
        (fx.purchase_orders, [("purchase_order_status", "purchase_order_status", None)]),
        (fx.spend_invoices, [("invoice_status", "invoice_status", None),
                             ("invoice_category", "invoice_category", None),
                             ("payment_method", "payment_method", paid),
                             ("three_way_match_status", "three_way_match_status", None),
                             ("receipt_matched", F.col("receipt_matched").cast("string"), None)]),
    ]
    out = None
    for df, attrs in specs:
        pairs = F.array(*[F.struct(F.lit(name).alias("attribute"),
                                   (F.col(col) if isinstance(col, str) else col).cast("string").alias("value"),
                                   (F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(True)).alias("keep"))
                          for name, col, cond in attrs])
        part = (df.select(F.explode(F.filter(pairs, lambda p: p["keep"])).alias("p"))
                .groupBy(F.col("p.attribute").alias("attribute"), F.col("p.value").alias("value"))
                .agg(F.count(F.lit(1)).alias("row_count")))
        out = part if out is None else out.unionByName(part)
    return out


@query("q35_po_value_by_year")
def q35_po(spark, sf_dir):
    po = Fixtures(spark, sf_dir).purchase_orders
    return (po.groupBy(F.year("purchase_order_date").alias("year"))
            .agg(F.count(F.lit(1)).alias("po_count"), _b("purchase_order_amount").alias("total_po_value")))


@query("q35_invoice_value_by_year")
def q35_inv(spark, sf_dir):
    inv = Fixtures(spark, sf_dir).spend_invoices
    return (inv.groupBy(F.year("invoice_date").alias("year"))
            .agg(_b("invoice_amount").alias("total_invoice_amount"), _b("amount_paid").alias("total_paid"),
                 F.count(F.lit(1)).alias("invoice_count")))


@query("q36_invoice_financial_summary")
def q36(spark, sf_dir):
    inv = Fixtures(spark, sf_dir).spend_invoices
    return (inv.agg(_b("invoice_amount").alias("total_invoice_amount"), _b("tax_amount").alias("total_tax"),
                    _b("discount_amount").alias("total_discount"), _b("total_invoice_amount").alias("grand_total"),
                    _b("amount_paid").alias("total_paid"), F.count("invoice_amount").alias("_n"))
            .withColumn("avg_invoice_amount", ratio("total_invoice_amount", "_n", den_places=0).cast(MONEY))
            .withColumn("outstanding_balance", (F.col("grand_total") - F.col("total_paid")).cast(BALANCE))
            .drop("_n"))
