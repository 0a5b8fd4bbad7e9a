"""Operator invariants: one-pass vs reference shape, skew-safe running sums, keys, metric views."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions.keys import with_sequence_id
from ledgerloom.operators.metric_view import Dimension, DrillAcrossView, Fact, Join, Measure, MetricView
from ledgerloom.operators import running
from ledgerloom.operators.asof import as_of
from ledgerloom.operators.distinct import distinct_counts
from ledgerloom.operators.running import running_sum
from ledgerloom.operators.snapshots import cumulative_snapshots, snapshot_totals
from ledgerloom.plans import ledger, quality, recognition, trial_balance
from ledgerloom.plans.registry import lakehouse
from tests.conftest import SF_SMALL
from tests.helpers import rows
from tests.yardsticks import trial_balances_one_by_one


def test_trial_balance_one_pass_equals_24_filters(spark):
    lh = lakehouse(spark, SF_SMALL)
    fast = lh.fact_gl_trial_balances
    slow = trial_balances_one_by_one(lh.fact_gl_entries, lh.tb_start, lh.tb_end, lh.run_ts)
    assert rows(fast) == rows(slow)


def test_snapshot_at_equals_filtered_table(spark):
    lh = lakehouse(spark, SF_SMALL)
    d = dt.date(2000, 6, 30)
    tb = lh.fact_gl_trial_balances.where(F.col("as_of_date") == d)
    snap = trial_balance.snapshot_at(lh.fact_gl_entries, d, lh.run_ts)
    assert rows(tb) == rows(snap)
    latest = lh.fact_gl_trial_balances
    latest = latest.where(F.col("as_of_date") == latest.select(F.max("as_of_date")).scalar())
    assert rows(latest) == rows(trial_balance.latest_snapshot(lh.fact_gl_entries, lh.tb_start, lh.tb_end,
                                                              lh.run_ts))


def test_trial_balance_is_off_by_the_planted_invoices_alone(spark):
    """Per month end, debits less credits of the stored balances are those of the unbalanced transactions so far."""
    lh = lakehouse(spark, SF_SMALL)
    per = lh.fact_gl_trial_balances.groupBy("as_of_date").agg((F.sum("debit_balance") - F.sum("credit_balance")).alias("off"))
    gl = lh.fact_gl_entries
    off = (gl.groupBy("transaction_id", "transaction_type").agg(
        F.sum("debit_amount").alias("d"), F.sum("credit_amount").alias("c"), F.max("gl_date").alias("day")).where("d <> c").collect())
    assert off
    for r in per.collect():
        assert r.off == sum(x.d - x.c for x in off if x.day <= r.as_of_date)


def test_legs_made_from_dealt_entries_equal_those_made_in_place(spark):
    from ledgerloom.operators.legs import Leg, entries, explode_legs, legs_of_entries
    df = spark.createDataFrame(
        [(1, "r1", Decimal("5.00"), Decimal("1.00"), True, True), (2, None, None, Decimal("2.00"), True, None),
         (3, "r3", Decimal("-4.00"), None, False, True), (4, "r4", Decimal("1.00"), None, None, None), (1, "r1", Decimal("5.00"), Decimal("1.00"), True, True)],
        "id long, ref string, a decimal(18,2), b decimal(18,2), one boolean, two boolean")
    a, b, day, late, ref = F.col("a"), F.col("b"), F.lit(dt.date(2000, 1, 2)), F.lit(dt.date(2000, 2, 3)), F.col("ref")
    legs = [Leg("X", "X-", 1, 10, "ten", a - b, None, F.col("one"), day, ref), Leg("X", "X-", 2, 20, "twenty", None, b, F.col("one") & (b > 1), day, ref),
            Leg("X", "X-", 3, 30, "thirty", None, a, F.col("two"), day, ref), Leg("Y", "Y-", 1, 10, "ten", None, a, F.col("two"), late, F.col("id"))]
    whole = explode_legs(df, legs, ["id"])
    dealt = legs_of_entries(entries(df, legs, ["id"]).repartition(3), legs)
    assert dict(dealt.dtypes) == dict(whole.dtypes)
    assert whole.count() == 10
    assert rows(dealt.select(*whole.columns)) == rows(whole)
    with pytest.raises(ValueError):
        entries(df, [legs[0], Leg("Z", "Z-", 1, 1, "one", a, b, F.col("one"), day, ref)], ["id"])


def test_ledger_by_date_deals_entries_and_not_legs(spark):
    lh = lakehouse(spark, SF_SMALL)
    dealt = ledger.gl_by_date(lh.stg_revenue_transactions, lh.stg_spend_transactions, lh.run_ts)
    assert dealt.columns == lh.fact_gl_entries.columns
    assert rows(dealt.drop("created_timestamp")) == rows(lh.fact_gl_entries.drop("created_timestamp"))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    # Below either exchange by date stands the generator of entries, above it that of legs; no leg's text passes it.
    assert plan.count("rangepartitioning(gl_date") == 2
    assert "account_name" not in plan.split("rangepartitioning(gl_date")[1].split("SortMergeJoin")[0]


TOTAL_DIMS = [[], ["account_type"], ["account_number", "legal_entity_id"]]


@pytest.mark.parametrize("group", TOTAL_DIMS, ids=lambda g: "-".join(g) or "all")
def test_totals_by_difference_events_equal_the_snapshots(spark, group):
    lh = lakehouse(spark, SF_SMALL)
    tb = lh.fact_gl_trial_balances
    fast = trial_balance.balance_totals(lh.fact_gl_entries, lh.tb_start, lh.tb_end, group, count_of="cost_center_name")
    money = [F.sum(c).cast("decimal(28,2)").alias(c) for c in ("debit_balance", "credit_balance", "net_balance")]
    slow = tb.groupBy("as_of_date", *group).agg(*money, F.count_distinct("cost_center_name").alias("different"))
    assert rows(fast) == rows(slow)


def test_totals_over_odd_calendars(spark):
    gl = [(dt.date(2024, 1, 31), 1000, 5, 0), (dt.date(2024, 3, 1), 1000, 0, 9), (dt.date(2024, 3, 1), 2000, 9, 0),
          (dt.date(2023, 11, 30), 2000, 0, 4), (None, 1000, 100, 0), (dt.date(2024, 5, 20), 1000, 7, 0)]
    df = spark.createDataFrame([(d, a, Decimal(x), Decimal(y)) for d, a, x, y in gl], "gl_date date, account_number int, dr decimal(18,2), cr decimal(18,2)")
    for start, end in ((dt.date(2024, 1, 1), dt.date(2024, 5, 31)), (dt.date(2024, 2, 10), dt.date(2024, 5, 25)),
                       (dt.date(2023, 12, 1), dt.date(2023, 12, 30)), (dt.date(2020, 1, 1), dt.date(2020, 12, 31))):
        snaps = cumulative_snapshots(df, "gl_date", ["account_number"], {"d": "dr", "c": "cr"}, start, end)
        slow = snaps.groupBy("as_of_date").agg(F.sum(F.greatest(F.col("d") - F.col("c"), F.lit(0))).cast("decimal(28,2)").alias("up"),
                                               F.count_distinct("account_number").alias("different"))
        fast = snapshot_totals(df, "gl_date", ["account_number"], {"d": "dr", "c": "cr"},
                               {"up": F.greatest(F.col("d") - F.col("c"), F.lit(0)).cast("decimal(28,2)")}, start, end,
                               count_of="account_number")
        assert rows(fast.withColumn("up", F.col("up").cast("decimal(28,2)"))) == rows(slow)


def test_running_sum_matches_single_window_with_a_hot_group(spark):
    data = [(0 if i % 3 else i % 7, dt.date(2024, 1, 1 + i % 20), i, Decimal(i % 13)) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, d date, id int, v decimal(18,2)")
    fast = running_sum(df, "g", "d", ["id"], "v", "rt")
    w = Window.partitionBy("g").orderBy("d", "id").rowsBetween(Window.unboundedPreceding, 0)
    slow = df.withColumn("rt", F.sum("v").over(w))
    assert rows(fast) == rows(slow)


def test_sequence_ids_dense_and_ordered(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "k").repartition(5)
    out = with_sequence_id(df, ["k"], F.floor(F.col("k") / 100), start=1, name="sid").collect()
    got = sorted((r.k, r.sid) for r in out)
    assert [s for _, s in got] == list(range(1, len(got) + 1))


def test_metric_view_dependent_and_distinct_measures(spark):
    fact = spark.createDataFrame([(1, "a", 10), (1, "a", 20), (2, "b", 5), (None, "b", 7)],
                                 "contract_id int, region string, amount int")
    dim = spark.createDataFrame([(1, 100), (2, 50)], "contract_id int, value int")
    mv = MetricView("t", fact, joins=[Join("c", dim, lambda: F.col("source.contract_id") == F.col("c.contract_id"))],
                    dimensions=[Dimension("region", "region", comment="Region")],
                    measures=[Measure("total", lambda: F.sum("source.amount")),
                              Measure("n", lambda: F.count(F.lit(1))),
                              Measure("avg", derived=lambda m: m["total"] / m["n"], depends=("total", "n")),
                              Measure("value_per_row", lambda: F.sum("c.value")),
                              Measure("value_once", lambda: F.col("c.value"), distinct_key="c.contract_id")])
    out = {r.region: r for r in mv.query().collect()}
    assert out["a"].total == 30 and out["a"].avg == 15.0
    assert out["a"].value_per_row == 200 and out["a"].value_once == 100
    assert out["b"].value_once == 50
    assert mv.query().schema["region"].metadata["comment"] == "Region"
    assert [(r.total, r.value_once) for r in mv.query([], ["total", "value_once"]).collect()] == [(42, 150)]
    plan = mv.query()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Expand" not in plan


def test_drill_across_view_repeats_what_a_fact_does_not_know(spark):
    cost = spark.createDataFrame([("x", "a", 10), ("x", "b", 20), (None, "a", 5)], "entity string, center string, cost int")
    income = spark.createDataFrame([("x", 100), ("x", 50), (None, 7), ("z", 1)], "entity string, income int")
    view = DrillAcrossView(
        "v", [Fact(cost, {"entity": F.col("entity"), "center": F.col("center")}, ["cost"]),
              Fact(income, {"entity": F.col("entity")}, ["income"])],
        [Dimension("entity", None, "Entity"), Dimension("center", None)],
        [Measure("cost", lambda: F.sum("cost")), Measure("income", lambda: F.sum("income"), comment="Income"),
         Measure("rate", derived=lambda m: m["income"] / m["cost"], depends=("income", "cost"))])
    assert sorted(map(str, view.query(["entity"], ["cost", "income"]).collect())) == sorted(map(str, [
        "Row(entity='x', cost=30, income=150)", "Row(entity=None, cost=5, income=7)"]))
    assert sorted((r.entity or "", r.center, r.income) for r in view.query().collect()) == [
        ("", "a", 7), ("x", "a", 150), ("x", "b", 150)]
    assert [(r.cost, r.rate) for r in view.query([], ["cost", "rate"], {"entity": "x"}).collect()] == [(30, 5.0)]
    assert view.query().schema["income"].metadata["comment"] == "Income"


def test_static_leg_positions_equal_window_numbering(spark):
    from ledgerloom.operators.legs import number_legs_by_window
    gl = lakehouse(spark, SF_SMALL).fact_gl_entries
    pos = gl.withColumn("static_position", F.element_at(F.split("gl_entry_id", "-"), -1).cast("int"))
    numbered = number_legs_by_window(pos, ["transaction_type", "transaction_id", "reference_number"])
    assert numbered.where(F.col("static_position") != F.col("window_position")).count() == 0


def test_gl_for_accounts_equals_filtered_ledger(spark):
    from ledgerloom.plans import ledger
    lh = lakehouse(spark, SF_SMALL)
    full = lh.fact_gl_entries
    for accounts in ([1100], [2000, 5100], [1000], [3000]):
        part = ledger.gl_for_accounts(lh.stg_revenue_transactions, lh.stg_spend_transactions, accounts, lh.run_ts)
        assert rows(part) == rows(full.where(F.col("account_number").isin(accounts)))


# -- as-of join -------------------------------------------------------------------
@pytest.mark.parametrize("block", ["month", "year", "day"])
def test_as_of_by_brute_force(spark, block):
    import random
    rng = random.Random(block)
    day = lambda: dt.date(2023, 11, 20) + dt.timedelta(rng.randint(0, 200))
    states = [(rng.choice([1, 1, 1, 2, None]), rng.choice(["a", "b"]), day() if rng.random() < 0.95 else None, k, rng.randint(-9, 9) if rng.random() < 0.8 else None)
              for k in range(150)]
    asks = [(k, rng.choice([1, 1, 2, 3, None]), rng.choice(["a", "b"]), day() if rng.random() < 0.95 else None) for k in range(120)] + [(0, 1, "a", dt.date(2000, 1, 1))]
    s = spark.createDataFrame(states, "k long, g string, d date, id int, v long").repartition(4)
    r = spark.createDataFrame(asks, "id int, k long, g string, d date").repartition(3)
    got = list(tuple(x) for x in as_of(r.withColumnRenamed("d", "due"), s, ["k", "g"], "due", "d", {"total": "v"}, {"latest": "v"}, "id", block)
                 .select("id", "total", "latest", "k").fillna(-1, ["k"]).collect())
    want = []
    for i, k, g, d in asks:
        own = [x for x in states if None not in (x[0], x[2], k, d) and (x[0], x[1]) == (k, g) and x[2] <= d]
        vals = [x[4] for x in own if x[4] is not None]
        # The last value is that of the greatest id among a day's states; a null one is passed over.
        last = None
        for day_ in sorted({x[2] for x in own}):
            final = max((x for x in own if x[2] == day_), key=lambda x: x[3])
            last = final[4] if final[4] is not None else last
        want.append((i, sum(vals) if vals else None, last, -1 if k is None else k))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_as_of_of_nothing(spark):
    s = spark.createDataFrame([], "k long, d date, v long")
    r = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "k long, due date")
    assert [tuple(x) for x in as_of(r, s, ["k"], "due", "d", {"t": "v"}).collect()] == [(1, dt.date(2024, 1, 1), None)]
    assert as_of(r.where("false"), s, ["k"], "due", "d", {"t": "v"}).count() == 0


def test_as_of_spreads_a_hot_key(spark):
    """No window is partitioned by the key alone but the one over its blocks."""
    s = spark.range(1000).select(F.lit(1).alias("k"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 300).cast("int")).alias("d"), "id")
    p = as_of(s.withColumnRenamed("id", "r"), s, ["k"], "d", "d", {"t": "id"})
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("_block" in w.split("windowspecdefinition")[1].split("_day")[0] for w in windows) == 2


# -- recognition in steps -----------------------------------------------------------
def test_resolved_recognition_counts_no_month_twice(spark):
    lh = lakehouse(spark, SF_SMALL)
    plain, solved = lh.fact_revenue_recognition, lh.fact_revenue_recognition_resolved
    assert quality.double_recognised(plain).count() > 0 and quality.double_recognised(solved).count() == 0
    sums = [F.sum(c) for c in ("contract_amortization_value", "rev_sku_all", "rev_billed_amount", "period_transaction_count")]
    assert plain.agg(*sums).first() == solved.agg(*sums).first()
    steps = {r.match_step: r["count"] for r in solved.groupBy("match_step").count().collect()}
    assert steps["exact"] == plain.where("contract_id is not null and trx_contract_id is not null").count()
    assert steps["party"] + steps.get("contract", 0) > 0
    p = solved._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_matching_in_steps_uses_every_row_once(spark):
    m = dt.date(2024, 1, 1)
    c = spark.createDataFrame([(1, m, 5, 10, "c1"), (1, m, 5, 11, "c2"), (2, m, 6, 10, "c3"), (3, m, 7, 10, "c4"), (None, m, 7, 10, "c5"), (4, m, None, 3, "c6")],
                              "contract_id long, month date, third_party_id long, legal_entity_id long, c string")
    t = spark.createDataFrame([(1, m, 5, 10, "t1"), (1, m, 5, 12, "t2"), (1, m, 5, 13, "t3"), (2, m, 8, 99, "t4"), (None, m, 7, 10, "t5"),
                               (None, m, 7, 10, "t6"), (4, m, None, 3, "t7"), (5, None, 1, 1, "t8")],
                              "contract_id long, month date, third_party_id long, legal_entity_id long, t string")
    got = list((r.match_step, r.c_c, r.t_t) for r in recognition.match_in_steps(c, t).collect())
    assert sorted(got, key=str) == sorted([("exact", "c1", "t1"), ("party", "c2", "t2"), ("consumption", None, "t3"), ("contract", "c3", "t4"),
                                           ("commit", "c4", None), ("commit", "c5", None), ("consumption", None, "t5"), ("consumption", None, "t6"),
                                           ("contract", "c6", "t7"), ("consumption", None, "t8")], key=str)


# -- distinct counts -----------------------------------------------------------------
def test_distinct_counts_of_nulls_negatives_and_repeats(spark):
    data = [(k % 70_000 - 100 if k % 11 else None, f"s{k % 13}" if k % 5 else None, None) for k in range(90_000)]
    df = spark.createDataFrame(data, "a long, b string, c int").repartition(5)
    want = {c: (len(data), sum(r[i] is not None for r in data), len({r[i] for r in data} - {None})) for i, c in enumerate("abc")}
    for dense in (["a", "c"], ["a"], []):
        got = {r.column: (r.n_rows, r.known, r.different) for r in distinct_counts(df, ["a", "b", "c"], dense).collect()}
        assert got == want
    empty = {tuple(r) for r in distinct_counts(df.where("false"), ["a", "b"], ["a"]).collect()}
    assert empty == {("a", 0, 0, 0), ("b", 0, 0, 0)}


# -- running sums over one bulk-load day ------------------------------------------------
def test_running_sum_splits_a_day_with_most_rows(spark):
    day = dt.date(2024, 5, 5)
    data = [(1, day, k * 7 % 20_011, Decimal(k % 17 - 5)) for k in range(20_000)]
    data += [(1, dt.date(2024, 5, 4 + 2 * (k % 2)), 30_000 + k, Decimal(3)) for k in range(40)] + [(2, day, k, Decimal(1)) for k in range(30)]
    df = spark.createDataFrame(data, "g int, d date, id long, v decimal(18,2)").repartition(6)
    split = running_sum(df, "g", "d", ["id"], "v", "rt", split_by="id", split_rows=1000)
    w = Window.partitionBy("g").orderBy("d", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(split) == rows(df.withColumn("rt", F.sum("v").over(w)))
    parts = [r["count"] for r in running._sub_chunks(df, "g", "d", "id", 1000).groupBy("g", "d", "_sub").count().collect()]
    assert max(parts) <= 2 * 20_000 / running.SPLITS


def _staged(spark):
    """Staged rows with null parties, null hierarchy and repeated keys."""
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    coa = lambda i: None if i % 7 == 0 else (i % 3, i % 2, f"CC{i % 2}", i % 3, f"E{i % 3}")
    struct = "coa_meta struct<coa_id bigint, cost_center_id bigint, cost_center_name string, legal_entity_id bigint, legal_entity_name string>"
    spend = [(i // 2, None if i % 5 == 0 else i % 4, f"S{i % 4}", i % 4, i % 3, coa(i), "labor" if i % 2 else None, f"I{i}", None if i % 11 == 0 else day(i % 90),
              "paid" if i % 3 else None, Decimal(i % 9), Decimal(1), None if i % 2 else Decimal("0.50"), Decimal(i % 9 + 1), Decimal(i % 9),
              day(i % 120) if i % 3 else None, f"P{i}") for i in range(200)]
    rev = [(i // 2, i, None if i % 5 == 0 else i % 4, f"C{i % 4}", i % 4, i % 3, coa(i), "labor" if i % 2 else None, f"R{i}", day(i % 90),
            Decimal(i % 9 - 1), day(i % 150) if i % 3 else None, None if i % 2 else Decimal("0.25")) for i in range(200)]
    money = "decimal(18,2)"
    return (spark.createDataFrame(rev, f"rev_trx_id long, billing_id long, third_party_id long, customer_name string, customer_id long, contract_id long, "
                                  f"{struct}, rev_category string, invoice_number string, invoice_date date, billed_amount {money}, "
                                  f"payment_received_date date, retention_amount {money}"),
            spark.createDataFrame(spend, f"invoice_id long, third_party_id long, supplier_name string, supplier_id long, contract_id long, {struct}, "
                                  f"invoice_category string, invoice_number string, invoice_date date, invoice_status string, invoice_amount {money}, "
                                  f"discount_amount {money}, tax_amount {money}, total_invoice_amount {money}, amount_paid {money}, payment_date date, "
                                  "payment_reference string"))


def test_balances_of_rows_dealt_by_party_equal_those_of_the_ledger(spark):
    rev, spend = _staged(spark)
    gl, dealt = ledger.fact_gl_entries(rev, spend), ledger.gl_by_party(rev, spend)
    assert rows(dealt.drop("created_timestamp")) == rows(gl.drop("created_timestamp"))
    start, end = dt.date(2024, 1, 31), dt.date(2024, 4, 30)
    tb = lambda df: trial_balance.fact_gl_trial_balances(df, spark, start, end).drop("snapshot_timestamp")
    assert rows(tb(dealt)) == rows(tb(gl))
    for day in (start, dt.date(2024, 2, 29), end):
        plain = (trial_balance.classify(gl).where(F.col("gl_date") <= day).groupBy(*trial_balance.TB_DIMS)
                 .agg(F.sum("debit_amount").cast("decimal(28,2)").alias("total_debits"), F.count(F.lit(1)).alias("entry_count")))
        cols = [*trial_balance.TB_DIMS, "total_debits", "entry_count"]
        assert rows(tb(dealt).where(F.col("as_of_date") == day), cols) == rows(plain, cols)
        assert rows(trial_balance.trial_balances_at(dealt, [day, dt.date(2030, 1, 1)]).where(F.col("as_of_date") == day), cols) == rows(plain, cols)


def test_source_rows_without_a_join_key_are_spread(spark):
    fact = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 6).alias("k"))
    dim = spark.createDataFrame([(0, 10), (2, 20), (None, 30), (4, None)], "k long, value int")
    view = lambda **kw: MetricView("t", fact, joins=[Join("d", dim, **kw)], dimensions=[Dimension("value", "d.value")],
                                   measures=[Measure("n", lambda: F.count(F.lit(1)))])
    by_key = view(key="k", deal=("id",))
    assert rows(by_key.query()) == rows(view(on=lambda: F.col("source.k") == F.col("d.k")).query())
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = [r["count"] for r in by_key.relation().groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 4000 and max(sizes) < 1600          # 3000 of the rows have no key


def test_as_of_makes_its_rows_once(spark):
    states = spark.range(300).select((F.col("id") % 5).alias("k"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 100).cast("int")).alias("d"),
                                     F.col("id").cast("decimal(18,2)").alias("v"))
    asked = spark.range(100).select("id", (F.col("id") % 7).alias("k"),
                                    F.date_add(F.lit(dt.date(2023, 12, 20)), (F.col("id") % 130).cast("int")).alias("due"))
    found = as_of(asked, states, ["k"], "due", "d", sums={"total": "v"}, lasts={"last": "d"})
    plain = asked.join(states.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & (F.col("d") <= F.col("due")), "left").groupBy("id", "k", "due").agg(
        F.sum("v").alias("total"), F.max("d").alias("last"))
    got = {r.id: (r.total, r.last) for r in found.collect()}
    assert got == {r.id: (r.total, r.last) for r in plain.collect()}
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 1 and plan.count("Range (0, 300") == 1


def test_as_of_rows_takes_requests_and_states_of_one_table(spark):
    from ledgerloom.operators.asof import as_of_rows
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    table = [(1, d(3), True, None, "a"), (1, d(3), False, 5, None), (1, d(1), False, 2, None), (1, d(40), False, 7, None), (1, d(45), True, None, "b"),
             (1, d(0), True, None, "c"), (None, d(50), True, None, "d"), (None, d(1), False, 9, None), (2, None, True, None, "e"), (2, d(2), False, 1, None),
             (2, None, False, 4, None), (2, d(2), True, None, "f"), (2, d(2), True, None, "f")]
    rows_ = spark.createDataFrame(table, "k long, d date, ask boolean, v long, name string")
    for block in ("month", "day"):
        found = as_of_rows(rows_, F.col("ask"), ["k"], "d", {"total": "v"}, {"latest": "v"}, block=block)
        assert sorted((r.name, r.k, r.total, r.latest) for r in found.collect()) == [
            ("a", 1, 7, 5), ("b", 1, 14, 7), ("c", 1, None, None), ("d", None, None, None), ("e", 2, None, None), ("f", 2, 1, 1), ("f", 2, 1, 1)]


def test_invoices_and_payables_are_the_legs_beside_the_invoices(spark):
    lh = lakehouse(spark, SF_SMALL)
    both = ledger.invoices_and_payables(lh.stg_spend_transactions, "payment_due_date")
    columns = ["third_party_id", "gl_date", "transaction_type", "debit_amount", "credit_amount"]
    legs = ledger.gl_for_accounts(lh.stg_revenue_transactions, lh.stg_spend_transactions, [2000], lh.run_ts)
    assert rows(both.where("account_number = 2000").select(*columns)) == rows(legs.select(*columns))
    invoices = lh.stg_spend_transactions.where("invoice_id is not null").select("invoice_id", "third_party_id", F.col("payment_due_date").alias("gl_date"))
    assert rows(both.where(F.col("transaction_type") == ledger.INVOICE_ITSELF).select(*invoices.columns)) == rows(invoices)
