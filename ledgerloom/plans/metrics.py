"""The metric views M1-M5 over the gold tables.

Fixed values: the view, dimension and measure names, their expressions'
thresholds (price bands 100000 / 10000, sales cost center 1002, per-100K
scaling) and the comments, display names, formats and synonyms follow the
metric definitions being re-expressed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import MONEY, ratio
from ledgerloom.operators.metric_view import Dimension, DrillAcrossView, Fact, Join, Measure, MetricView
from ledgerloom.plans.trial_balance import BALANCE

CURRENCY = {"type": "currency", "currency_code": "USD", "decimal_places": {"type": "exact", "places": 2},
            "abbreviation": "compact"}
NUMBER = {"type": "number", "decimal_places": {"type": "all"}, "hide_group_separator": True}


def _sum(col: str):
    return lambda: F.sum(F.col(col)).cast(BALANCE)


def growth_revenue(recognition: DataFrame, contracts: DataFrame) -> MetricView:
    """M1 metric_growth_revenue."""
    at_risk = ((F.col("contracts.agreement_type") == "Outbound")
               & F.col("contracts.contract_status").isin("Active", "Completed"))
    return MetricView(
        "metric_growth_revenue", recognition,
        joins=[Join("contracts", contracts, key="contract_id", deal=("third_party_id", "period_month"))],
        comment="Revenue growth and performance metrics: ARR, MRR, growth trends and revenue at risk",
        dimensions=[
            Dimension("revenue_year", F.year("source.period_month"), "Revenue recognition year", "Revenue Year"),
            Dimension("revenue_quarter", F.quarter("source.period_month"), "Revenue recognition quarter (1-4)",
                      "Revenue Quarter", ("quarter", "qtr")),
            Dimension("revenue_month", "period_month", "Revenue recognition month", "Revenue Month"),
            Dimension("customer", "customer_name", "Customer name", "Customer Name", ("client",)),
            Dimension("legal_entity", "legal_entity_id", "Legal entity identifier", "Legal Entity ID"),
            Dimension("legal_entity_name", "legal_entity_name", "Legal entity name", "Legal Entity Name"),
            Dimension("contract_status", "contracts.contract_status", "Contract status", "Contract Status"),
            Dimension("agreement_type", "contracts.agreement_type", "Agreement type (Inbound/Outbound)",
                      "Agreement Type"),
        ],
        measures=[
            Measure("recognized_revenue", _sum("source.rev_recognized_amount"), comment="Total recognized revenue",
                    display_name="Recognized Revenue", synonyms=("revenue", "rev", "actuals"), format=CURRENCY),
            Measure("_months", lambda: F.count_distinct(F.col("source.period_month"))),
            Measure("monthly_recurring_revenue",
                    derived=lambda m: ratio(m["recognized_revenue"], m["_months"], den_places=0),
                    depends=("recognized_revenue", "_months"), comment="Monthly Recurring Revenue (MRR)",
                    display_name="Monthly Recurring Revenue (MRR)", synonyms=("mrr",), format=CURRENCY),
            Measure("annual_recurring_revenue",
                    derived=lambda m: ratio(m["recognized_revenue"], m["_months"], den_places=0, factor=12),
                    depends=("recognized_revenue", "_months"), comment="Annual Recurring Revenue (ARR)",
                    display_name="Annual Recurring Revenue (ARR)", synonyms=("arr",), format=CURRENCY),
            Measure("billed_amount", _sum("source.rev_billed_amount"), comment="Total billed amount",
                    display_name="Billed Amount", synonyms=("billings", "invoiced"), format=CURRENCY),
            Measure("received_amount", _sum("source.rev_received_amount"), comment="Total received amount",
                    display_name="Received Amount", synonyms=("collections",), format=CURRENCY),
            Measure("transaction_count", lambda: F.sum("source.period_transaction_count").cast("long"),
                    comment="Total number of revenue transactions", display_name="Transaction Count",
                    format=NUMBER),
            Measure("contract_revenue_at_risk",
                    lambda: F.sum(F.when(at_risk, F.col("source.rev_recognized_amount"))).cast(BALANCE),
                    comment="Revenue from outbound contracts that are active or completed",
                    display_name="Contract Revenue at Risk", synonyms=("revenue at risk",), format=CURRENCY),
        ])


def cash_obligations(stg_spend: DataFrame, contracts: DataFrame) -> MetricView:
    """M2 metric_cash_obligations."""
    return MetricView(
        "metric_cash_obligations", stg_spend,
        joins=[Join("contracts", contracts, key="contract_id", deal=("purchase_order_id",))],
        comment="Cash obligations: payables, payments and contract commitments",
        dimensions=[
            Dimension("invoice_date", F.to_date("source.invoice_date"), "Invoice date", "Invoice Date"),
            Dimension("invoice_year", lambda d: F.year(d["invoice_date"]), "Invoice year", "Invoice Year"),
            Dimension("invoice_month", lambda d: F.month(d["invoice_date"]), "Invoice month", "Invoice Month"),
            Dimension("invoice_status", "invoice_status", "Invoice status", "Invoice Status"),
            Dimension("supplier", "supplier_name", "Supplier name", "Supplier Name"),
            Dimension("legal_entity", F.col("source.coa_meta.legal_entity_id"), "Legal entity identifier",
                      "Legal Entity ID"),
            Dimension("contract_status", "contracts.contract_status", "Contract status", "Contract Status"),
            Dimension("agreement_type", "contracts.agreement_type", "Agreement type", "Agreement Type"),
        ],
        measures=[
            Measure("total_invoice_amount", _sum("source.total_invoice_amount"), comment="Total invoiced",
                    display_name="Total Invoice Amount", format=CURRENCY),
            Measure("amount_paid", _sum("source.amount_paid"), comment="Total paid", display_name="Amount Paid",
                    format=CURRENCY),
            Measure("outstanding_payables",
                    derived=lambda m: (m["total_invoice_amount"] - m["amount_paid"]).cast(BALANCE),
                    depends=("total_invoice_amount", "amount_paid"), comment="Invoiced but not yet paid",
                    display_name="Outstanding Payables", synonyms=("payables",), format=CURRENCY),
            Measure("days_payable_outstanding",
                    derived=lambda m: ratio(m["total_invoice_amount"] - m["amount_paid"], m["total_invoice_amount"],
                                            places=2, factor=365, divisor=12),
                    depends=("total_invoice_amount", "amount_paid"), comment="Days Payable Outstanding",
                    display_name="Days Payable Outstanding (DPO)", synonyms=("dpo",)),
            Measure("total_contracted_value", _sum("contracts.total_contract_value"),
                    comment="Contract value summed per invoice row (as the reference)",
                    display_name="Total Contracted Value", format=CURRENCY),
            Measure("distinct_contracted_value", lambda: F.col("contracts.total_contract_value"),
                    distinct_key="contracts.contract_id",
                    comment="Contract value counted once per contract", display_name="Contracted Value",
                    format=CURRENCY),
            Measure("invoice_count", lambda: F.count_distinct(F.col("source.invoice_id")),
                    comment="Distinct invoices", display_name="Invoice Count", format=NUMBER),
        ])


def headcount(emp_cost: DataFrame, revenue: DataFrame, spend: DataFrame,
              sales_cost_center: str = "1002") -> DrillAcrossView:
    """M3 metric_headcount: cost, revenue and spend, each aggregated before they meet.

    Revenue and spend know no cost center: with that dimension chosen, their
    amounts of the quarter and entity stand beside each cost center's cost.
    """
    per = lambda n, d: lambda m: ratio(m[n], m[d], places=2, factor=100000)
    quarter = {"year": F.year("period_month"), "quarter": F.quarter("period_month"), "legal_entity": F.col("legal_entity_id")}
    sales = F.when(F.col("cost_center_id") == sales_cost_center, F.col("agg_qtr_salary"))
    return DrillAcrossView(
        "metric_headcount",
        comment="Headcount cost against revenue and spend",
        dimensions=[
            Dimension("year", None, "Calendar year of the quarter", "Year", ("fiscal year",)),
            Dimension("quarter", None, "Calendar quarter (1-4)", "Quarter", ("qtr",)),
            Dimension("legal_entity", None, "Legal entity identifier", "Legal Entity ID", ("entity", "company")),
            Dimension("cost_center", None, "Cost center identifier", "Cost Center ID", ("department",)),
        ],
        facts=[
            Fact(emp_cost, {"year": F.col("employment_year"), "quarter": F.col("employment_quarter"),
                            "legal_entity": F.col("legal_entity_id"), "cost_center": F.col("cost_center_id")},
                 ["quarterly_headcount_cost", "_sales_cost"]),
            Fact(revenue, quarter, ["quarterly_revenue"]),
            Fact(spend, quarter, ["quarterly_spend"]),
        ],
        measures=[
            Measure("quarterly_headcount_cost", lambda: F.sum("agg_qtr_salary").cast(BALANCE), comment="Salary cost of the quarter",
                    display_name="Quarterly Headcount Cost", synonyms=("salary cost", "payroll"), format=CURRENCY),
            Measure("_sales_cost", lambda: F.sum(sales).cast(BALANCE)),
            Measure("quarterly_revenue", lambda: F.sum("rev_recognized_amount").cast(BALANCE), comment="Recognised revenue",
                    display_name="Quarterly Revenue", synonyms=("revenue",), format=CURRENCY),
            Measure("revenue_per_employee", derived=per("quarterly_revenue", "quarterly_headcount_cost"),
                    depends=("quarterly_revenue", "quarterly_headcount_cost"), comment="Revenue per 100,000 of salary cost",
                    display_name="Revenue per Employee", format=CURRENCY),
            Measure("revenue_per_sales_employee", derived=per("quarterly_revenue", "_sales_cost"),
                    depends=("quarterly_revenue", "_sales_cost"), comment="Revenue per 100,000 of sales salary cost",
                    display_name="Revenue per Sales Employee", format=CURRENCY),
            Measure("quarterly_spend", lambda: F.sum("spend_amount").cast(BALANCE), comment="Consumed spend",
                    display_name="Quarterly Spend", synonyms=("spend",), format=CURRENCY),
            Measure("spend_per_employee", derived=per("quarterly_spend", "quarterly_headcount_cost"),
                    depends=("quarterly_spend", "quarterly_headcount_cost"), comment="Spend per 100,000 of salary cost",
                    display_name="Spend per Employee", format=CURRENCY),
        ])


def planning(scenarios: DataFrame, plan: DataFrame) -> MetricView:
    """M4 metric_planning (the plan has one row per scenario_key, so the join is 1:1)."""
    return MetricView(
        "metric_planning", scenarios,
        joins=[Join("plan", plan, lambda: F.col("source.scenario_key") == F.col("plan.scenario_key"))],
        comment="Planning: budget, actual and forecast by scenario",
        dimensions=[
            Dimension("fiscal_year", "fiscal_year", "Fiscal year", "Fiscal Year"),
            Dimension("fiscal_quarter", "fiscal_quarter", "Fiscal quarter", "Fiscal Quarter"),
            Dimension("fiscal_quarter_name",
                      F.concat(F.lit("FY"), F.col("source.fiscal_year").cast("string"), F.lit("Q"),
                               F.col("source.fiscal_quarter").cast("string")),
                      "Fiscal quarter name", "Fiscal Quarter Name"),
            Dimension("cost_center_id", "cost_center_id", "Cost center", "Cost Center ID"),
            Dimension("cost_center", "cost_center_name", "Cost center name", "Cost Center Name"),
            Dimension("legal_entity_id", "legal_entity_id", "Legal entity", "Legal Entity ID"),
            Dimension("legal_entity", "legal_entity_name", "Legal entity name", "Legal Entity Name"),
        ],
        measures=[
            Measure("budget_amount", _sum("plan.budget_amount"), display_name="Budget Amount", format=CURRENCY),
            Measure("actual_amount", _sum("plan.actual_amount"), display_name="Actual Amount", format=CURRENCY),
            Measure("forecast_amount", _sum("plan.forecast_amount"), display_name="Forecast Amount",
                    format=CURRENCY),
            Measure("variance_amount", derived=lambda m: (m["budget_amount"] - m["actual_amount"]).cast(BALANCE),
                    depends=("budget_amount", "actual_amount"), display_name="Budget vs Actual Variance",
                    format=CURRENCY),
            Measure("variance_percent",
                    derived=lambda m: ratio(m["budget_amount"] - m["actual_amount"], m["budget_amount"], places=4),
                    depends=("budget_amount", "actual_amount"),
                    comment="(budget - actual) / budget; positive = under budget",
                    display_name="Budget vs Actual Variance %"),
            Measure("forecast_accuracy",
                    derived=lambda m: ratio(m["forecast_amount"], m["actual_amount"], places=4),
                    depends=("forecast_amount", "actual_amount"), comment="forecast / actual",
                    display_name="Forecast Accuracy"),
            Measure("actual_spend", _sum("plan.spend_amount"), display_name="Actual Spend", format=CURRENCY),
            Measure("actual_salary", _sum("plan.salary_amount"), display_name="Actual Salary", format=CURRENCY),
        ])


def sample_orders(orders: DataFrame) -> MetricView:
    """M5: the sample order metrics (runs on the orders table as is; money as decimal)."""
    price = F.col("source.o_totalprice").cast(MONEY)
    return MetricView(
        "sample_order_metrics", orders,
        comment="Sales metrics with semantic metadata",
        dimensions=[
            Dimension("order_date", F.to_date("source.o_orderdate"), "Date when the order was placed", "Order Date",
                      ("order time", "date of order")),
            Dimension("customer_segment",
                      F.when(price > 100000, "Enterprise").when(price > 10000, "Mid-market").otherwise("SMB"),
                      "Customer classification based on order value", "Customer Segment",
                      ("segment", "customer tier")),
        ],
        measures=[
            Measure("total_revenue", lambda: F.sum(price).cast(BALANCE), comment="Total revenue from all orders",
                    display_name="Total Revenue", synonyms=("revenue", "total sales"), format=CURRENCY),
            Measure("order_count", lambda: F.count(F.lit(1)), comment="Total number of orders",
                    display_name="Order Count", format=NUMBER),
            Measure("avg_order_value",
                    derived=lambda m: ratio(m["total_revenue"], m["order_count"], den_places=0),
                    depends=("total_revenue", "order_count"), comment="Average revenue per order",
                    display_name="Average Order Value", synonyms=("aov",)),
        ])

