"""Materialised build and idempotent month refresh."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.plans.build import StoredLakehouse
from ledgerloom.plans.registry import lakehouse
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources.fixtures import Fixtures
from ledgerloom.sources import sinks
from ledgerloom.sources.sinks import new_scratch
from ledgerloom.streaming.refresh import read_months, refresh_months
from tests.conftest import SF_SMALL
from tests.helpers import rows


def test_stored_build_matches_lazy_products(spark):
    base = new_scratch(spark, "build")
    st = StoredLakehouse(spark, Fixtures(spark, SF_SMALL), as_of=fx.AS_OF, tb_start=fx.TB_START, tb_end=fx.TB_END,
                         scenario_start=fx.SCENARIO_START, scenario_end=fx.SCENARIO_END, base=base)
    st.build(["dim_third_party", "dim_all_contracts", "stg_revenue_transactions", "stg_spend_transactions",
              "fact_gl_entries", "fact_gl_trial_balances"])
    lazy = lakehouse(spark, SF_SMALL)
    assert rows(st.fact_gl_entries) == rows(lazy.fact_gl_entries)
    assert rows(st.fact_gl_trial_balances) == rows(lazy.fact_gl_trial_balances)


def test_month_refresh_is_idempotent(spark):
    path = new_scratch(spark, "refresh")
    gl = lakehouse(spark, SF_SMALL).fact_gl_entries.drop("created_timestamp")
    refresh_months(gl, path, "gl_date")
    before = rows(spark.read.parquet(path))
    months = [dt.date(1998, 1, 1), dt.date(1998, 2, 1)]
    refresh_months(gl, path, "gl_date", months)
    refresh_months(gl, path, "gl_date", months)
    assert rows(spark.read.parquet(path)) == before
    assert read_months(spark, path, months).select(F.min("gl_date")).first()[0] >= dt.date(1998, 1, 1)


def test_refresh_drops_months_that_became_empty(spark):
    path = new_scratch(spark, "refresh")
    jan, feb, mar = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)
    both = spark.createDataFrame([(jan, 1), (feb, 2), (mar, 3)], "d date, v int")
    refresh_months(both, path, "d")
    out = refresh_months(both.where("v <> 2"), path, "d", [jan, feb])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]
    assert [r.v for r in out.collect()] == [1]


def _folder_files(path):
    import glob
    import os
    import collections
    return collections.Counter(os.path.basename(os.path.dirname(f)) for f in glob.glob(path.removeprefix("file:") + "/*/*.parquet"))


def test_refresh_writes_few_files(spark):
    path = new_scratch(spark, "refresh")
    rows_ = spark.range(4000, numPartitions=16).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"), "id")
    refresh_months(rows_, path, "d")
    assert _folder_files(path) == {f"period_month=2024-0{m}-01": 1 for m in (1, 2, 3)}


def test_files_of_a_folder_follow_its_bytes(spark):
    """A hot folder is written by many tasks, small folders by one each; no row is lost."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = spark.range(300_000, numPartitions=24).select(F.lit("hot").alias("folder"), F.md5(F.col("id").cast("string")).alias("v"))
    small = spark.range(2_000, numPartitions=4).select(F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("folder"),
                                                       F.md5(F.col("id").cast("string")).alias("v"))
    both = hot.unionByName(small)
    spark.conf.set(advisory, "1m")
    try:
        found = {}
        for size in ("1m", "4m"):
            spark.conf.set(advisory, size)
            path = new_scratch(spark, "follow")
            sinks.materialize(both, spark, "t", path, ["folder"])
            found[size] = _folder_files(f"{path}/t")
            assert spark.read.parquet(f"{path}/t").groupBy("folder").count().count() == 6
            assert rows(spark.read.parquet(f"{path}/t").select("folder", "v")) == rows(both)
    finally:
        spark.conf.unset(advisory)
    assert found["1m"]["folder=hot"] >= 8 and 1 < found["4m"]["folder=hot"] < found["1m"]["folder=hot"]
    assert all(n == 1 for counts in found.values() for f, n in counts.items() if f != "folder=hot")


def test_materialize_reuses_one_folder(spark):
    from ledgerloom.session import ensure_checkpoint_dir
    from ledgerloom.sources.sinks import materialize
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)
    one = materialize(spark.range(3), spark, "same_name").inputFiles()
    two = materialize(spark.range(5), spark, "same_name")
    assert two.count() == 5 and two.inputFiles()[0].rsplit("/", 1)[0] == one[0].rsplit("/", 1)[0]


def test_lakehouse_from_raw_files_equals_fixture_run(spark):
    from ledgerloom.plans.lakehouse import Lakehouse
    from ledgerloom.sources import readers, sinks, schemas
    root = new_scratch(spark, "rawlake")
    fxs = Fixtures(spark, SF_SMALL)
    for source in schemas.SCHEMAS:
        sinks.write_raw(getattr(fxs, source), root, source)
    raw = Lakehouse(spark, readers.RawFiles(spark, root), as_of=fx.AS_OF, tb_start=fx.TB_START, tb_end=fx.TB_END,
                    scenario_start=fx.SCENARIO_START, scenario_end=fx.SCENARIO_END)
    ref = lakehouse(spark, SF_SMALL)
    assert rows(raw.fact_gl_entries) == rows(ref.fact_gl_entries)
    assert rows(raw.fact_gl_trial_balances) == rows(ref.fact_gl_trial_balances)
    assert rows(raw.fact_revenue_recognition) == rows(ref.fact_revenue_recognition)


def test_build_cli_from_raw_files(spark):
    import os
    from ledgerloom.plans import build
    from ledgerloom.sources import schemas, sinks
    root = new_scratch(spark, "cliraw")
    fxs = Fixtures(spark, SF_SMALL)
    for source in schemas.SCHEMAS:
        sinks.write_raw(getattr(fxs, source), root, source)
    out = new_scratch(spark, "cliout")
    assert build.main(["--raw", root, "--out", out, "--as-of", "2001-08-01", "--tb-start", "1999-08-31",
                       "--tb-end", "2001-07-31", "--products",
                       "dim_third_party,stg_revenue_transactions,stg_spend_transactions,fact_gl_entries"]) == 0
    assert spark.read.parquet(os.path.join(out, "fact_gl_entries")).count() == \
        lakehouse(spark, SF_SMALL).fact_gl_entries.count()


def test_metric_view_as_sql_view(spark):
    from ledgerloom.plans import metrics
    mv = metrics.sample_orders(Fixtures(spark, SF_SMALL).table("orders"))
    mv.create_view("sample_order_metrics", ["customer_segment"])
    got = spark.sql("SELECT SUM(order_count) FROM sample_order_metrics").first()[0]
    assert got == Fixtures(spark, SF_SMALL).table("orders").count()


def _ledger_rows(rows_):
    """Ledger rows (day, account, entity, debit, credit) with the columns that balances need."""
    from decimal import Decimal
    return [(d, a, f"acc{a}", e, f"ent{e}", 1, "cc", None, 9, "party", Decimal(x) if x is not None else None,
             Decimal(y) if y is not None else None) for d, a, e, x, y in rows_]


LEDGER = ("gl_date date, account_number int, account_name string, legal_entity_id long, legal_entity_name string, cost_center_id long, "
          "cost_center_name string, category string, third_party_id long, third_party_name string, debit_amount decimal(18,2), "
          "credit_amount decimal(18,2)")


def test_late_entries_restate_only_later_balances(spark):
    from ledgerloom.plans import trial_balance
    from ledgerloom.streaming.refresh import refresh_trial_balances
    start, end = dt.date(2024, 1, 31), dt.date(2024, 6, 30)
    first = _ledger_rows([(dt.date(2023, 7, 1), 1000, 1, 5, None), (dt.date(2024, 1, 9), 1000, 1, 7, None),
                          (dt.date(2024, 2, 2), 2000, 1, None, 3), (dt.date(2024, 4, 4), 1000, 2, 1, None), (dt.date(2024, 4, 5), 2000, 1, 8, None)])
    ledger, balances = new_scratch(spark, "ledger"), new_scratch(spark, "balances")
    refresh_months(spark.createDataFrame(first, LEDGER), ledger, "gl_date")

    def full():
        gl = spark.read.parquet(ledger).drop("period_month")
        return trial_balance.fact_gl_trial_balances(gl, spark, start, end, F.lit(0).cast("timestamp"))

    sinks.gathered(full(), ["as_of_date"]).write.partitionBy("as_of_date").parquet(balances)
    old = {f: n for f, n in _files_by_folder(balances).items() if f <= "as_of_date=2024-03-31"}
    # April gets a late entry and a new key, and loses the entry that was the only one of its key.
    april = dt.date(2024, 4, 1)
    late = _ledger_rows([(dt.date(2024, 4, 5), 2000, 1, 8, None), (dt.date(2024, 4, 6), 1000, 1, 2, None), (dt.date(2024, 4, 7), 3000, 5, None, 6)])
    refresh_months(spark.createDataFrame(late, LEDGER), ledger, "gl_date", [april])
    out = refresh_trial_balances(spark, ledger, balances, [april], start, end, F.lit(0).cast("timestamp"))
    assert rows(spark.read.parquet(balances)) == rows(full())
    assert {r[0] for r in out.select("as_of_date").distinct().collect()} == {dt.date(2024, 4, 30), dt.date(2024, 5, 31), end}
    # Earlier snapshots are the same files, and the plan reads one of them and the ledger from April on.
    assert {f: n for f, n in _files_by_folder(balances).items() if f <= "as_of_date=2024-03-31"} == old
    # An entry before the calendar restates everything.
    july = dt.date(2023, 7, 1)
    refresh_months(spark.createDataFrame(_ledger_rows([(july, 1000, 1, 50, None)]), LEDGER), ledger, "gl_date", [july])
    refresh_trial_balances(spark, ledger, balances, [july], start, end, F.lit(0).cast("timestamp"))
    assert rows(spark.read.parquet(balances)) == rows(full())


def _files_by_folder(path):
    import glob
    import os
    out = {}
    for f in glob.glob(path.removeprefix("file:") + "/*/*.parquet"):
        out.setdefault(os.path.basename(os.path.dirname(f)), set()).add(os.path.basename(f))
    return out


def test_refresh_reads_changed_partitions_only(spark, monkeypatch):
    from ledgerloom.plans import trial_balance
    from ledgerloom.streaming import refresh
    ledger, balances = new_scratch(spark, "ledger"), new_scratch(spark, "balances")
    days = [dt.date(2024, m, 3) for m in range(1, 7)]
    refresh_months(spark.createDataFrame(_ledger_rows([(d, 1000, 1, 1, None) for d in days]), LEDGER), ledger, "gl_date")
    start, end = dt.date(2024, 1, 31), dt.date(2024, 6, 30)
    full = trial_balance.fact_gl_trial_balances(spark.read.parquet(ledger).drop("period_month"), spark, start, end, F.lit(0).cast("timestamp"))
    full.write.partitionBy("as_of_date").parquet(balances)
    plans = []
    monkeypatch.setattr(refresh, "gathered", lambda df, by: plans.append(df._jdf.queryExecution().executedPlan().toString()) or sinks.gathered(df, by))
    refresh.refresh_trial_balances(spark, ledger, balances, [dt.date(2024, 5, 1)], start, end, F.lit(0).cast("timestamp"))
    assert "period_month" in plans[0] and "PartitionFilters: [isnotnull(period_month" in plans[0]
    assert "PartitionFilters: [isnotnull(as_of_date" in plans[0] and "2024-04-30" in plans[0]


def test_stored_lakehouse_refreshes_its_ledger(spark):
    base = new_scratch(spark, "ledgers")
    st = StoredLakehouse(spark, Fixtures(spark, SF_SMALL), as_of=fx.AS_OF, tb_start=fx.TB_START, tb_end=fx.TB_END, base=base)
    whole = rows(st.refresh_ledger([]))
    assert whole == rows(lakehouse(spark, SF_SMALL).fact_gl_trial_balances)
    again = st.refresh_ledger([dt.date(2001, 5, 1)])
    assert rows(again) == rows(lakehouse(spark, SF_SMALL).fact_gl_trial_balances.where("as_of_date >= '2001-05-31'"))
