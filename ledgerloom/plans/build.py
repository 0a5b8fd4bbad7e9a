"""Materialise every data product in dependency order.

Each product is written once as parquet (under ``base`` or the shared
checkpoint folder) and later products read the stored copy, the way the
reference's pipelines hand tables to each other.  Stored hand-offs cut the
lineage: a lost executor costs a re-read of the stored input, not a
recomputation of everything upstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.plans import trial_balance
from ledgerloom.plans.lakehouse import Lakehouse
from ledgerloom.sources.sinks import gathered, has_files, materialize, shared_folder

# (product, partition columns) in dependency order.
ORDER = [
    ("dim_third_party", None), ("dim_all_contracts", None), ("dim_gl_accounts", None),
    ("stg_spend_transactions", None), ("fact_spend_transactions", None), ("stg_revenue_transactions", None),
    ("stg_commit_revenue", None), ("stg_commit_spend", None),
    ("fact_revenue_recognition", None), ("fact_spend_recognition", None),
    ("fact_gl_entries", None), ("fact_gl_trial_balances", ["as_of_date"]),
    ("dim_employees", None), ("fact_emp_quarterly_cost", None),
    ("dim_fpa_scenarios", None), ("fpa_plan", None), ("fact_fpa_actuals", None), ("fact_fpa_budgets", None),
    ("fact_fpa_forecasts", None), ("fact_supplier_scorecard", None),
]


class StoredLakehouse(Lakehouse):
    """A Lakehouse whose products are written once and read back."""

    def __init__(self, *args, base: str | None = None, **kw):
        super().__init__(*args, **kw)
        self.base = base
        self._stored: dict[str, DataFrame] = {}

    def __getattribute__(self, name):
        stored = object.__getattribute__(self, "_stored") if name != "_stored" else None
        if stored is not None and name in stored:
            return stored[name]
        return object.__getattribute__(self, name)

    @property
    def gl_by_party(self) -> DataFrame:
        """Balances are those of the stored ledger, once there is one."""
        return self._stored["fact_gl_entries"] if "fact_gl_entries" in self._stored else Lakehouse.gl_by_party.func(self)

    def build(self, names: list[str] | None = None) -> dict[str, DataFrame]:
        for name, parts in ORDER:
            if names is not None and name not in names:
                continue
            df = getattr(self, name)
            self._stored[name] = materialize(df, self.spark, name, self.base, parts)
        return dict(self._stored)

    def refresh_ledger(self, months: list) -> DataFrame:
        """Rebuilds ``months`` of the stored ledger from its upstream and restates the balances they change.

        Products that were built before come from storage.  Ledger and balances
        are kept by month below the base folder; the first call writes all of both.
        """
        from ledgerloom.streaming.refresh import refresh_months, refresh_trial_balances

        base = (self.base or shared_folder(self.spark, "tables")).rstrip("/")
        ledger, balances = f"{base}/ledger_by_month", f"{base}/balances_by_month_end"
        entries = Lakehouse.fact_gl_entries.func(self)
        if not has_files(self.spark, ledger):
            refresh_months(entries, ledger, "gl_date")
            whole = trial_balance.fact_gl_trial_balances(self.spark.read.parquet(ledger).drop("period_month"), self.spark,
                                                         self.tb_start, self.tb_end, self.run_ts)
            gathered(whole, ["as_of_date"]).write.mode("overwrite").partitionBy("as_of_date").parquet(balances)
            return self.spark.read.schema(whole.schema).parquet(balances)
        refresh_months(entries, ledger, "gl_date", months)
        return refresh_trial_balances(self.spark, ledger, balances, months, self.tb_start, self.tb_end, self.run_ts)



def main(argv: list[str] | None = None) -> int:
    """Build every product from the reference's raw folder layout.

    python -m ledgerloom.plans.build --raw ROOT --out BASE --as-of 2025-10-01 [--run-at 2025-10-01T06:00:00]
        [--tb-start 2023-10-01 --tb-end 2025-09-30] [--products a,b,...]
    """
    import argparse
    import datetime as dt

    from ledgerloom.session import DEFAULT_CONF, ensure_checkpoint_dir
    from ledgerloom.sources.readers import RawFiles
    from pyspark.sql import SparkSession

    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", required=True, help="the day that counts as today")
    p.add_argument("--run-at", default="", help="the time stamped on rows; the start of the as-of day unless given")
    p.add_argument("--tb-start", default="2023-10-01")
    p.add_argument("--tb-end", default="2025-09-30")
    p.add_argument("--scenario-start", default="2023-01-01")
    p.add_argument("--scenario-end", default="2025-10-01")
    p.add_argument("--products", default="")
    a = p.parse_args(argv)
    builder = SparkSession.builder.appName("ledgerloom-build")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    d = dt.date.fromisoformat
    lake = StoredLakehouse(spark, RawFiles(spark, a.raw), as_of=d(a.as_of), tb_start=d(a.tb_start),
                           tb_end=d(a.tb_end), scenario_start=d(a.scenario_start), scenario_end=d(a.scenario_end),
                           run_ts=dt.datetime.fromisoformat(a.run_at or a.as_of), base=a.out)
    built = lake.build([n for n in a.products.split(",") if n] or None)
    print(",".join(built))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
