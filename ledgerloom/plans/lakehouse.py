"""The dependency graph of data products.

Each product is a plain function of its upstream DataFrames; this class only
wires arguments (so the graph is exactly the function signatures, D22) and
memoises the lazy DataFrames.  Nothing here runs a job; ``materialize``
writes a product to storage and reads it back, which cuts lineage for
products read by several downstream steps.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans import (contracts, ledger, parties, planning, recognition, scorecard, staging,
                              trial_balance, workforce)

RUN_TS = dt.datetime(2001, 8, 1, 0, 0, 0)


class Lakehouse:
    """Products over an ``inputs`` object exposing the bronze tables.

    ``inputs`` needs: coa, third_parties, customers, suppliers,
    outbound_contracts, inbound_contracts, revenue_transactions,
    revenue_billings, purchase_orders, spend_invoices, employees
    (``sources.fixtures.Fixtures`` or ``sources.readers.RawFiles``).
    """

    def __init__(self, spark: SparkSession, inputs, as_of: dt.date = dt.date(2001, 8, 1),
                 tb_start=trial_balance.DEFAULT_START, tb_end=trial_balance.DEFAULT_END,
                 scenario_start=dt.date(2023, 1, 1), scenario_end=dt.date(2025, 10, 1),
                 amortization: str = "conserving", run_ts=RUN_TS, budget_overrides=None,
                 fy_start_month: int = 1):
        self.spark = spark
        self.inputs = inputs
        self.as_of = as_of
        self.tb_start, self.tb_end = tb_start, tb_end
        self.scenario_start, self.scenario_end = scenario_start, scenario_end
        self.amortization = amortization
        # Audit timestamp stamped on every row; a fixed value keeps recomputed
        # partitions identical.  ``None`` means current_timestamp().
        self.run_ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else None
        self.budget_overrides = budget_overrides
        self.fy_start_month = fy_start_month

    # bronze
    @property
    def raw_coa_hierarchy(self) -> DataFrame:
        return self.inputs.coa

    # gold dimensions
    @cached_property
    def dim_third_party(self) -> DataFrame:
        i = self.inputs
        return parties.dim_third_party(i.third_parties, i.suppliers, i.customers)

    @cached_property
    def dim_all_contracts(self) -> DataFrame:
        i = self.inputs
        return contracts.dim_all_contracts(i.outbound_contracts, i.inbound_contracts, self.dim_third_party,
                                           i.coa)

    @cached_property
    def dim_gl_accounts(self) -> DataFrame:
        return ledger.dim_gl_accounts(self.spark)

    # silver
    @cached_property
    def stg_spend_transactions(self) -> DataFrame:
        i = self.inputs
        return staging.stg_spend_transactions(i.purchase_orders, self.dim_third_party, i.coa, i.spend_invoices)

    @cached_property
    def fact_spend_transactions(self) -> DataFrame:
        return staging.fact_spend_transactions(self.stg_spend_transactions)

    @cached_property
    def stg_revenue_transactions(self) -> DataFrame:
        i = self.inputs
        return staging.stg_revenue_transactions(i.revenue_transactions, self.dim_third_party, i.coa,
                                                i.revenue_billings)

    def stg_consumption_revenue(self, base_year: int = 2023) -> DataFrame:
        return staging.stg_consumption_revenue(self.inputs.revenue_transactions, self.dim_third_party,
                                               base_year=base_year)

    @cached_property
    def stg_commit_revenue(self) -> DataFrame:
        return recognition.stg_commit_revenue(self.dim_all_contracts, self.amortization)

    @cached_property
    def stg_commit_spend(self) -> DataFrame:
        return recognition.stg_commit_spend(self.dim_all_contracts, self.amortization)

    # recognition
    @cached_property
    def fact_revenue_recognition(self) -> DataFrame:
        return recognition.fact_revenue_recognition(self.stg_commit_revenue, self.stg_revenue_transactions)

    @cached_property
    def fact_spend_recognition(self) -> DataFrame:
        return recognition.fact_spend_recognition(self.stg_commit_spend, self.stg_spend_transactions)

    @cached_property
    def fact_revenue_recognition_resolved(self) -> DataFrame:
        return recognition.fact_revenue_recognition_resolved(self.stg_commit_revenue, self.stg_revenue_transactions)

    @cached_property
    def fact_spend_recognition_resolved(self) -> DataFrame:
        return recognition.fact_spend_recognition_resolved(self.stg_commit_spend, self.stg_spend_transactions)

    # ledger
    @cached_property
    def fact_gl_entries(self) -> DataFrame:
        return ledger.fact_gl_entries(self.stg_revenue_transactions, self.stg_spend_transactions, self.run_ts)

    @cached_property
    def gl_by_party(self) -> DataFrame:
        """The ledger's rows as balances want them dealt."""
        return ledger.gl_by_party(self.stg_revenue_transactions, self.stg_spend_transactions, self.run_ts)

    @cached_property
    def fact_gl_trial_balances(self) -> DataFrame:
        return trial_balance.fact_gl_trial_balances(self.gl_by_party, self.spark, self.tb_start,
                                                    self.tb_end, self.run_ts)

    # workforce
    @cached_property
    def dim_employees(self) -> DataFrame:
        return workforce.dim_employees(self.inputs.employees)

    @cached_property
    def fact_emp_quarterly_cost(self) -> DataFrame:
        return workforce.fact_emp_quarterly_cost(self.dim_employees, self.as_of)

    # planning
    @cached_property
    def dim_fpa_scenarios(self) -> DataFrame:
        pairs = planning.fpa_pairs(self.inputs.purchase_orders, self.inputs.coa)
        return planning.dim_fpa_scenarios(pairs, self.scenario_start, self.scenario_end)

    @cached_property
    def fpa_plan(self) -> DataFrame:
        i = self.inputs
        kw = {} if self.budget_overrides is None else {"overrides": self.budget_overrides}
        return planning.fpa_plan(i.purchase_orders, i.coa, i.spend_invoices, self.fact_emp_quarterly_cost, self.as_of,
                                 run_ts=self.run_ts, fy_start_month=self.fy_start_month, **kw)

    @cached_property
    def fact_fpa_actuals(self) -> DataFrame:
        return planning.fact_fpa_actuals(self.fpa_plan)

    @cached_property
    def fact_fpa_budgets(self) -> DataFrame:
        return planning.fact_fpa_budgets(self.fpa_plan)

    @cached_property
    def fact_fpa_forecasts(self) -> DataFrame:
        return planning.fact_fpa_forecasts(self.fpa_plan)

    # purchasing analytics
    @cached_property
    def fact_supplier_scorecard(self) -> DataFrame:
        return scorecard.fact_supplier_scorecard(self.fact_spend_transactions)
