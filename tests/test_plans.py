"""Plan-shape checks: the physical plans keep the properties the design relies on."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.functions.dates import fiscal_quarter, fiscal_year
from tests.conftest import SF_SMALL

Q = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_trial_balance_is_one_pass(spark):
    p = _plan(Q["g11_fact_gl_trial_balances"](spark, SF_SMALL))
    assert p.count("Window ") == 1                  # one running-total window, not 24 aggregations
    assert "Generate explode(sequence" in p           # month ends generated in place, no calendar join
    assert "NestedLoopJoin" not in p
    assert p.count("FileScan parquet [l_orderkey") <= 2


def test_ledger_legs_have_no_window_or_cartesian(spark):
    p = _plan(Q["g10_fact_gl_entries"](spark, SF_SMALL))
    assert "Generate explode" in p
    assert "Window" not in p and "CartesianProduct" not in p


def test_scans_read_only_needed_columns(spark):
    p = _plan(Q["m5_sample_order_metrics"](spark, SF_SMALL))
    scan = [line for line in p.split("\n") if "FileScan parquet" in line][0]
    assert "o_totalprice" in scan and "o_orderdate" in scan
    assert "o_orderpriority" not in scan and "o_custkey" not in scan


def _jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


PRODUCTS = [k for k in Q if not k.startswith(("op", "pipeline", "io_", "sl2"))]          # those write


def test_building_a_plan_runs_no_job(spark, monkeypatch):
    reader, reads = type(spark.read), []
    parquet = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **kw: reads.append(paths) or parquet(self, *paths, **kw))
    before = _jobs(spark)
    for name in PRODUCTS:
        Q[name](spark, SF_SMALL)
    assert _jobs(spark) - before <= len(reads)          # Spark reads the schema of each table it opens


def test_scorecard_reads_the_facts_once(spark):
    df = Q["g7_fact_supplier_scorecard"](spark, SF_SMALL)
    df.collect()
    plan = _plan(df)
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final or final.count("FileScan parquet [l_orderkey") <= 2


def test_fiscal_year_with_february_start(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2024, 2, 1),)], "d date")
    got = [(r.y, r.q) for r in df.select(fiscal_year("d", 2).alias("y"), fiscal_quarter("d", 2).alias("q")).collect()]
    assert got == [(2024, 4), (2025, 1)]


def test_recognition_reads_each_side_once(spark):
    p = _plan(Q["g8_fact_revenue_recognition"](spark, SF_SMALL))
    assert p.count("FileScan parquet [o_orderkey") == 2      # transactions + billings, once each
    assert F is not None


def test_planning_reads_orders_and_invoices_once(spark):
    p = _plan(Q["m4_metric_planning"](spark, SF_SMALL))
    assert p.count("FileScan parquet [l_orderkey") <= 3
    assert "supplier_id" not in _plan(Q["g12_dim_fpa_scenarios"](spark, SF_SMALL))
    for name in ("m2_metric_cash_obligations", "m2_metric_cash_obligations_by_supplier"):
        p = _plan(Q[name](spark, SF_SMALL))
        assert "Window" not in p and "Expand" not in p


def test_totals_explode_no_keys(spark):
    """Month ends are generated for the few summed rows, above the aggregation by month and group."""
    for name in ("q9_monthly_balance_summary", "q13_trend_by_month_end_and_type", "v3_month_end_balance"):
        lines = _plan(Q[name](spark, SF_SMALL)).splitlines()
        at = [k for k, line in enumerate(lines) if "Generate explode(sequence" in line]
        assert len(at) == 1 and any("HashAggregate" in line for line in lines[at[0]:])
        assert "account_number" not in lines[at[0]] and "third_party" not in lines[at[0]]


def test_distinct_counts_copy_no_rows(spark):
    for name in ("v11_invoice_po_one_to_one", "v13_key_uniqueness", "q26_party_key_cardinality"):
        assert "Expand" not in _plan(Q[name](spark, SF_SMALL))


def test_bucketed_facts_are_joined_in_place(spark):
    from ledgerloom.plans import staging
    from ledgerloom.plans.registry import lakehouse
    from ledgerloom.sources import catalog, sinks
    from ledgerloom.sources.fixtures import Fixtures
    fx = Fixtures(spark, SF_SMALL)
    inputs = catalog.BucketedInputs(spark, fx, buckets=4).build()
    party = sinks.materialize(lakehouse(spark, SF_SMALL).dim_third_party, spark, "party", sinks.new_scratch(spark, "dims"))
    coa = sinks.materialize(fx.coa, spark, "coa", sinks.new_scratch(spark, "dims"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Above the stored dimensions, below the facts.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(24 * 1024))
    try:
        plans = [_plan(staging.stg_spend_transactions(inputs.purchase_orders, party, coa, inputs.spend_invoices)),
                 _plan(staging.stg_revenue_transactions(inputs.revenue_transactions, party, coa, inputs.revenue_billings))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for p in plans:
        assert "SortMergeJoin" in p and "Bucketed: true" in p
        assert "hashpartitioning(purchase_order_id" not in p and "hashpartitioning(rev_trx_id" not in p


BALANCES = ("g11_fact_gl_trial_balances", "j19_trial_balances_at_dates", "v3_month_end_balance", "q8_account_balances_by_month_end",
            "q9_monthly_balance_summary", "q10_latest_by_account_type", "q11_top_balances_latest", "q12_latest_by_entity_and_type",
            "q13_trend_by_month_end_and_type", "q14_latest_by_cost_center", "q15_balance_sheet", "q16_income_statement")


def test_balances_exchange_staged_rows_and_no_legs(spark):
    """The rows travel by party once, below the legs; what is made of a key's legs stays in its task."""
    for name in BALANCES:
        lines = _plan(Q[name](spark, SF_SMALL)).splitlines()
        legs = min(k for k, line in enumerate(lines) if "Generate explode(array_remove" in line)
        above = [line for line in lines[:legs] if "Exchange hashpartitioning" in line and "third_party_id" in line]
        assert not above, name
        assert any("third_party_id" in line and "REPARTITION_BY_NUM" in line for line in lines[legs:]), name


def test_unread_references_are_not_exchanged(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "PAY-" not in _plan(Q["q15_balance_sheet"](spark, SF_SMALL))
        assert "PAY-" in _plan(Q["g10_fact_gl_entries"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_invoices_are_joined_where_they_were_grouped(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(Q["g5_fact_spend_transactions"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert p.count("Exchange hashpartitioning(purchase_order_id") == 1          # the orders, after the supplier join


def test_payables_at_due_date_make_the_staged_rows_once(spark):
    df = Q["j19_payables_at_due_date"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # One reading for the orders and one for the invoices; the requests and the legs come from the rows joined of them.
    assert plan.count("FileScan parquet [l_orderkey") == 2
    assert plan.count("ReusedExchange") >= 1


def test_balances_are_made_before_their_month_ends(spark):
    p = _plan(Q["g11_fact_gl_trial_balances"](spark, SF_SMALL))
    generate = [line for line in p.splitlines() if "Generate explode(sequence" in line]
    assert len(generate) == 1 and "debit_balance" in generate[0] and "interval" not in generate[0]


def test_balances_deal_no_rows_without_a_document(spark):
    p = _plan(Q["g11_fact_gl_trial_balances"](spark, SF_SMALL))
    for key in ("purchase_order_id", "rev_trx_id"):
        join = [line for line in p.splitlines() if f"Join [{key}#" in line]
        assert join and all("Inner" in line for line in join)
