"""Ledger and amortisation invariants on the fixture lakehouse."""

from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.plans import ledger, quality, trial_balance
from ledgerloom.plans.registry import lakehouse
from ledgerloom.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL

Q = entry.queries()


def planted(spark):
    """Ids of the invoices whose total is one unit above their parts (every 103rd order)."""
    inv = Fixtures(spark, SF_SMALL).spend_invoices
    return {r.invoice_id for r in inv.where("pmod(purchase_order_id, 103) = 6").select("invoice_id").collect()}


def test_only_planted_invoices_do_not_balance(spark):
    slips = planted(spark)
    found = Q["v1_unbalanced_transactions"](spark, SF_SMALL).collect()
    # An invoice's total is credited and its parts are debited; cancelled ones have no entries.
    entered = {r[0] for r in ledger.stg_spend_invoice_entries(lakehouse(spark, SF_SMALL).stg_spend_transactions)
               .select("transaction_id").distinct().collect()}
    assert slips & entered and {r.transaction_id for r in found} == slips & entered
    assert {r.variance for r in found} == {Decimal("-1.00")}
    verdict = Q["v2_ledger_totals"](spark, SF_SMALL).first()
    assert not verdict.balanced and verdict.variance == -len(found)


def test_month_ends_balance_without_planted_invoices(spark):
    lh = lakehouse(spark, SF_SMALL)
    slips = sorted(planted(spark))
    v3 = Q["v3_month_end_balance"](spark, SF_SMALL).collect()
    assert len(v3) == 24 and not any(r.balanced for r in v3)
    rest = quality.month_end_balance(trial_balance.balance_totals(
        lh.fact_gl_entries.where(~F.col("transaction_id").isin(slips)), lh.tb_start, lh.tb_end))
    assert rest.count() == 24 and rest.where(~F.col("balanced")).count() == 0


def test_conserving_amortisation_sums_to_contract_value(spark):
    lh = lakehouse(spark, SF_SMALL)
    per = lh.stg_commit_revenue.groupBy("contract_id", "total_contract_value").agg(
        F.sum("monthly_amortized_value").alias("s"))
    assert per.where(F.col("s") != F.col("total_contract_value")).count() == 0
    outbound = lh.dim_all_contracts.where("agreement_type = 'Outbound'").count()
    assert per.count() == outbound


def test_invoice_arithmetic_and_keys(spark):
    wrong = Q["r3_invoice_arithmetic_violations"](spark, SF_SMALL).collect()
    assert {r.invoice_id for r in wrong} == planted(spark) and len(wrong) == len(planted(spark))
    assert all(r.total_invoice_amount - r.expected_total == 1 for r in wrong)
    keys = Q["v13_key_uniqueness"](spark, SF_SMALL)
    assert keys.where(~F.col("is_unique")).count() == 0


def test_recognition_keeps_every_consumed_amount(spark):
    lh = lakehouse(spark, SF_SMALL)
    consumed = lh.fact_revenue_recognition.where("rev_recognition_indicator = 'consumption_revenue'") \
        .agg(F.sum("rev_sku_all")).first()[0]
    total = lh.stg_revenue_transactions.agg(F.sum("amount")).first()[0]
    assert consumed == total
