"""Small exact cases on inline rows (FIXTURES.md: 'Small exact cases')."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.accounts import account_type, normal_balance
from ledgerloom.functions.money import avg_money, ratio
from ledgerloom.operators.amortize import amortize_monthly
from ledgerloom.plans import ledger, scorecard, workforce
from ledgerloom.plans.planning import budgeted, forecast

D = dt.date
from tests.yardsticks import quarterly_cost_by_day


def _contracts(spark, rows):
    return spark.createDataFrame(
        [(i, s, e, Decimal(v)) for i, (s, e, v) in enumerate(rows)],
        "contract_id int, start date, end date, value decimal(18,2)")


def _amort(spark, rows, method):
    out = amortize_monthly(_contracts(spark, rows), "start", "end", "value", method=method)
    return {(r.contract_id, r.amortization_month): r.monthly_amortized_value for r in out.collect()}


def test_amortise_month_end_term(spark):
    # 31 Jan - 1 Feb: two calendar months touched, elapsed divisor 1.
    cons = _amort(spark, [(D(2024, 1, 31), D(2024, 2, 1), "1000.00")], "conserving")
    assert cons == {(0, D(2024, 1, 1)): Decimal("500.00"), (0, D(2024, 2, 1)): Decimal("500.00")}
    ela = _amort(spark, [(D(2024, 1, 31), D(2024, 2, 1), "1000.00")], "elapsed")
    assert sum(ela.values()) == Decimal("2000.00")        # the reference's over-allocation


def test_amortise_conserves_total_with_remainder_on_last_month(spark):
    got = _amort(spark, [(D(2024, 1, 15), D(2024, 6, 14), "1000.00")], "conserving")
    assert len(got) == 6
    assert sum(got.values()) == Decimal("1000.00")
    assert got[(0, D(2024, 6, 1))] == Decimal("166.70")
    ela = _amort(spark, [(D(2024, 1, 15), D(2024, 6, 14), "1000.00")], "elapsed")
    # months_between = 4 + 30/31 -> divisor int(5.97) = 5
    assert set(ela.values()) == {Decimal("200.00")}


def test_amortise_leap_day_single_day_and_backwards(spark):
    got = _amort(spark, [(D(2024, 2, 29), D(2024, 3, 31), "100.00"), (D(2024, 5, 5), D(2024, 5, 5), "42.00"),
                         (D(2024, 5, 5), D(2024, 4, 5), "9.00")], "conserving")
    assert got[(0, D(2024, 2, 1))] + got[(0, D(2024, 3, 1))] == Decimal("100.00")
    assert got[(1, D(2024, 5, 1))] == Decimal("42.00")
    assert not [k for k in got if k[0] == 2]              # end before start: no rows


def test_account_classes(spark):
    df = spark.createDataFrame([(1999,), (2000,), (3000,), (3999,), (5000,), (None,)], "n int")
    got = {r.n: (r.t, r.b) for r in df.select("n", account_type("n").alias("t"),
                                              normal_balance(account_type("n")).alias("b")).collect()}
    assert got == {1999: ("Asset", "Debit"), 2000: ("Liability", "Credit"), 3000: ("Equity", "Credit"),
                   3999: ("Equity", "Credit"), 5000: ("Expense", "Debit"), None: ("Other", "Credit")}


def test_ratio_rounding_and_zero_guard(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00")), (Decimal("-1.00"), Decimal("8.00")),
                                (Decimal("5.00"), Decimal("0.00")), (Decimal("2.00"), None)],
                               "n decimal(18,2), d decimal(18,2)")
    got = [r[0] for r in df.select(ratio("n", "d", places=2)).collect()]
    assert got == [Decimal("0.33"), Decimal("-0.13"), None, None]     # -0.125 rounds away from zero
    avg = spark.createDataFrame([(Decimal("3.01"), 2)], "s decimal(18,2), c long").select(avg_money("s", "c"))
    assert avg.first()[0] == Decimal("1.51")


def _stg_rev(spark, rows):
    schema = ("rev_trx_id long, billing_id long, customer_id long, third_party_id long, customer_name string, "
              "contract_id long, rev_category string, invoice_number string, invoice_date date, "
              "payment_received_date date, billed_amount decimal(18,2), retention_amount decimal(18,2)")
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("coa_meta", F.struct(F.lit(1).alias("coa_id"), F.lit(1000).alias("cost_center_id"),
                                              F.lit("CC").alias("cost_center_name"),
                                              F.lit(100001).alias("legal_entity_id"),
                                              F.lit("LE").alias("legal_entity_name")))


def test_two_billings_on_one_transaction_get_distinct_balanced_entries(spark):
    rows = [(1, 11, 5, 9, "c", None, "labor", "INV-a", D(2024, 1, 2), D(2024, 2, 2), Decimal("100.00"),
             Decimal("5.00")),
            (1, 12, 5, 9, "c", None, "labor", "INV-b", D(2024, 1, 3), None, Decimal("50.00"), None)]
    gl = ledger.revenue_entries(_stg_rev(spark, rows))
    ids = [r.gl_entry_id for r in gl.collect()]
    assert len(ids) == len(set(ids)) == 6
    assert "REV-INV-1-11-1" in ids and "REV-PMT-1-11-2" in ids
    tot = gl.groupBy("transaction_type").agg(F.sum("debit_amount").alias("d"), F.sum("credit_amount").alias("c"))
    for r in tot.collect():
        assert r.d == r.c
    pay = {r.account_number: r for r in gl.where("transaction_type = 'REVENUE_PAYMENT'").collect()}
    assert pay[1000].debit_amount == Decimal("95.00")                   # net of retention


def test_spend_invoice_status_filter_drops_cancelled_and_null(spark):
    schema = ("invoice_id long, supplier_id long, third_party_id long, supplier_name string, contract_id long, "
              "invoice_number string, invoice_date date, invoice_status string, invoice_amount decimal(18,2), "
              "tax_amount decimal(18,2), discount_amount decimal(18,2), total_invoice_amount decimal(18,2), "
              "amount_paid decimal(18,2), payment_date date, payment_reference string, invoice_category string")
    vals = (Decimal("100.00"), Decimal("8.00"), Decimal("2.00"), Decimal("106.00"))
    rows = [(1, 3, 9, "s", None, "I1", D(2024, 1, 1), "paid", *vals, Decimal("106.00"), D(2024, 2, 1), "P1", "labor"),
            (2, 3, 9, "s", None, "I2", D(2024, 1, 1), "cancelled", *vals, Decimal("0.00"), None, None, "labor"),
            (3, 3, 9, "s", None, "I3", D(2024, 1, 1), None, *vals, Decimal("0.00"), None, None, "labor")]
    df = spark.createDataFrame(rows, schema).withColumn(
        "coa_meta", F.struct(F.lit(1).alias("coa_id"), F.lit(1000).alias("cost_center_id"),
                             F.lit("CC").alias("cost_center_name"), F.lit(100001).alias("legal_entity_id"),
                             F.lit("LE").alias("legal_entity_name")))
    gl = ledger.spend_entries(df)
    assert {r.transaction_id for r in gl.collect()} == {1}
    legs = {(r.transaction_type, r.account_number): r for r in gl.collect()}
    assert legs[("SPEND_INVOICE", 5000)].debit_amount == Decimal("98.00")
    assert legs[("SPEND_INVOICE", 2000)].credit_amount == Decimal("106.00")
    assert legs[("SPEND_PAYMENT", 1000)].gl_entry_id == "SPEND-PMT-1-1"


def test_termination_before_hire_gets_no_quarters(spark):
    emp = spark.createDataFrame([(1, "a", Decimal("400.00"), "1000", 100001, D(2024, 5, 1), D(2024, 1, 1)),
                                 (2, "b", Decimal("400.00"), "1000", 100001, D(2024, 2, 15), D(2024, 7, 1))],
                                "employee_id long, employee_name string, salary decimal(18,2), cost_center_id string, "
                                "legal_entity_id long, hire_date date, termination_date date")
    q = workforce.fact_emp_quarterly_cost(emp, D(2025, 1, 1))
    got = {(r.employment_year, r.employment_quarter): r.agg_qtr_salary for r in q.collect()}
    assert got == {(2024, 1): Decimal("100"), (2024, 2): Decimal("100"), (2024, 3): Decimal("100")}
    assert sorted(q.collect()) == sorted(quarterly_cost_by_day(emp, D(2025, 1, 1)).collect())


def test_supplier_with_equal_min_max_lead_time_gets_null_score(spark):
    schema = ("purchase_order_id long, third_party_id long, supplier_id long, supplier_name string, "
              "purchase_order_date date, goods_received_date date, invoice_date date, payment_date date, "
              "payment_due_date date")
    rows = [(1, 9, 3, "s", D(2024, 1, 1), D(2024, 1, 6), D(2024, 1, 10), D(2024, 2, 1), D(2024, 2, 5)),
            (2, 9, 3, "s", D(2024, 1, 2), D(2024, 1, 7), D(2024, 1, 11), D(2024, 2, 2), D(2024, 2, 6))]
    r = scorecard.fact_supplier_scorecard(spark.createDataFrame(rows, schema)).first()
    assert r.po_to_gr == 5.0 and r.po_to_gr_score is None
    assert r.on_time_payment == 1.0


def test_zero_budget_gives_null_forecast_variance_percent(spark):
    actuals = spark.createDataFrame(
        [("k1", 1000, "CC", 100001, "LE", 2024, 1, "FY2024Q1", Decimal("0.00"), "USD"),
         ("k2", 1000, "CC", 100001, "LE", 2024, 2, "FY2024Q2", Decimal("100.00"), "USD")],
        "scenario_key string, cost_center_id long, cost_center_name string, legal_entity_id long, "
        "legal_entity_name string, fiscal_year int, fiscal_quarter int, fiscal_quarter_name string, "
        "actual_amount decimal(18,2), currency string")
    b = budgeted(actuals, D(2024, 5, 1), overrides=())
    got = {r.fiscal_quarter: r for r in b.collect()}
    assert got[1].budget_amount == Decimal("0.00") and got[1].variance_percent == Decimal("0.00")
    # Q2 2024 is the open quarter: previous base budget (0) + 8 %
    assert got[2].budget_amount == Decimal("0.00")
    f = {r.fiscal_quarter: r for r in forecast(b).collect()}
    assert f[1].variance_to_budget_percent is None


@pytest.mark.parametrize("method", ["conserving", "elapsed"])
def test_amortise_methods_row_counts_equal(spark, method):
    got = _amort(spark, [(D(2023, 11, 30), D(2024, 2, 29), "300.00")], method)
    assert len(got) == 4


def test_chart_of_accounts(spark):
    coa = {r.account_number: (r.account_name, r.account_type) for r in ledger.dim_gl_accounts(spark).collect()}
    assert coa[1000] == ("Cash", "Asset") and coa[5100] == ("Tax Expense", "Expense") and len(coa) == 6


def test_recognition_unmatched_entity_and_null_contract(spark):
    from ledgerloom.plans import recognition
    commit = spark.createDataFrame(
        [(7, "C-7", D(2024, 3, 1), Decimal("100.00"), 9, "party", 100001, "LE1")],
        "contract_id long, contract_number string, amortization_month date, monthly_amortized_value decimal(18,2), "
        "third_party_id long, third_party_name string, legal_entity_id long, legal_entity_name string")
    trx = spark.createDataFrame(
        [(1, D(2024, 3, 5), 9, "party", 7, "labor", Decimal("40.00"), Decimal("40.00"), None, 100002, "LE2"),
         (2, D(2024, 3, 6), 9, "party", None, "compute", Decimal("5.00"), None, None, 100001, "LE1")],
        "rev_trx_id long, transaction_date date, third_party_id long, customer_name string, contract_id long, "
        "rev_category string, amount decimal(18,2), billed_amount decimal(18,2), payment_received_date date, "
        "le_id long, le_name string")
    trx = trx.withColumn("coa_meta", F.struct(F.col("le_id").alias("legal_entity_id"),
                                              F.col("le_name").alias("legal_entity_name"))).drop("le_id", "le_name")
    out = {(r.rev_recognition_indicator, r.contract_id, r.trx_contract_id, r.legal_entity_id): r
           for r in recognition.fact_revenue_recognition(commit, trx).collect()}
    assert set(out) == {("commit_revenue", 7, None, 100001), ("consumption_revenue", None, 7, 100002),
                        ("consumption_revenue", None, None, 100001)}
    assert out[("commit_revenue", 7, None, 100001)].rev_recognized_amount == Decimal("100.00")
    assert out[("consumption_revenue", None, 7, 100002)].rev_sku_labor == Decimal("40.00")
    assert out[("consumption_revenue", None, None, 100001)].rev_recognized_amount == Decimal("5.00")
