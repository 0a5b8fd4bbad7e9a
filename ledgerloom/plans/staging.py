"""Silver staging tables: transactions joined to party, account hierarchy and documents.

S1 stg_spend_transactions, S3 stg_revenue_transactions,
S4 stg_consumption_revenue (re-aimed), G5 fact_spend_transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import MONEY
from ledgerloom.plans.parties import party_by_role


def coa_meta(prefix: str = "") -> Column:
    """The struct the reference carries: coa_id, cost center and legal entity."""
    return F.struct(F.col(f"{prefix}coa_id").alias("coa_id"), "cost_center_id", "cost_center_name",
                    "legal_entity_id", "legal_entity_name").alias("coa_meta")


def flatten_coa(df: DataFrame) -> DataFrame:
    """Replace ``coa_meta`` by its five fields (for tabular outputs)."""
    fields = ["coa_id", "cost_center_id", "cost_center_name", "legal_entity_id", "legal_entity_name"]
    cols = []
    for c in df.columns:
        if c == "coa_meta":
            cols += [F.col(f"coa_meta.{f}").alias(f) for f in fields]
        else:
            cols.append(c)
    return df.select(*cols)


SPEND_INVOICE_COLS = [
    "invoice_id", "invoice_number", "invoice_date", "invoice_status", "invoice_amount", "tax_amount",
    "discount_amount", "total_invoice_amount", "amount_paid", "payment_due_date", "invoice_category",
    "payment_date", "payment_method", "payment_reference", "receipt_matched", "three_way_match_status",
    "goods_received_date", "invoice_year", "invoice_month",
]


def stg_spend_transactions(purchase_orders: DataFrame, party: DataFrame, coa: DataFrame,
                           invoices: DataFrame) -> DataFrame:
    """PO LEFT JOIN party (by supplier) LEFT JOIN hierarchy LEFT JOIN invoice.

    The hierarchy is joined as its size asks for (Spark broadcasts it while it is
    small); the PO-invoice join is a large-large equi join on purchase_order_id (sort-merge; AQE splits skewed partitions).
    Invoice year/month are derived from the invoice date (the reference's
    partition columns are lost to recursive file lookup).
    """
    po = purchase_orders.alias("po")
    sup = party_by_role(party, "supplier_id", "supplier_name")
    inv = invoices.drop("invoice_year", "invoice_month")
    joined = (po.join(sup, "supplier_id", "left")
              .join(coa, "coa_id", "left")
              .join(inv, "purchase_order_id", "left"))
    return joined.select(
        "purchase_order_id", "contract_id", "purchase_order_number", "purchase_order_date",
        "purchase_order_status", "third_party_id", "supplier_id", "supplier_name", "purchase_order_currency",
        F.col("purchase_order_amount").cast(MONEY).alias("purchase_order_amount"),
        F.col("total_purchase_order_value").cast(MONEY).alias("total_purchase_order_value"),
        coa_meta(),
        *[c for c in SPEND_INVOICE_COLS if c not in ("invoice_year", "invoice_month")],
        F.year("invoice_date").cast("long").alias("invoice_year"),
        F.month("invoice_date").cast("long").alias("invoice_month"),
    )


def fact_spend_transactions(stg_spend: DataFrame) -> DataFrame:
    """The staged spend rows with every instant as a date."""
    date_cols = {"purchase_order_date", "invoice_date", "payment_due_date", "payment_date",
                 "goods_received_date"}
    return stg_spend.select(*[F.to_date(c).alias(c) if c in date_cols else F.col(c)
                              for c in stg_spend.columns])


def stg_revenue_transactions(transactions: DataFrame, party: DataFrame, coa: DataFrame,
                             billings: DataFrame) -> DataFrame:
    """S3: revenue transaction LEFT JOIN party (by customer) LEFT JOIN hierarchy LEFT JOIN billing."""
    cust = party_by_role(party, "customer_id", "customer_name")
    joined = (transactions.join(cust, "customer_id", "left")
              .join(coa, "coa_id", "left")
              .join(billings, "rev_trx_id", "left"))
    return joined.select(
        "rev_trx_id", F.to_date("transaction_date").alias("transaction_date"), "customer_id",
        "third_party_id", "customer_name", coa_meta(), F.col("cost_category").alias("rev_category"),
        F.col("amount").cast(MONEY).alias("amount"), "contract_id", "billing_id",
        F.to_date("invoice_date").alias("invoice_date"), "invoice_number",
        F.col("billed_amount").cast(MONEY).alias("billed_amount"),
        F.to_date("payment_received_date").alias("payment_received_date"),
        F.to_date("payment_due_date").alias("payment_due_date"),
        F.col("retention_amount").cast(MONEY).alias("retention_amount"),
    )


# Fixed values of the consumption-attribution rule (re-aimed S4): platform
# shares by party id mod 100 and a yearly growth index; parties whose id mod
# 10 is 2, 8 or 9 shrink, all others grow.  Index years are relative to a
# base year (the reference's base year is 2023).
PLATFORM_SHARES = [("Azure", 50), ("AWS", 30), ("GCP", 20)]
SHRINKING_DIGITS = (2, 8, 9)
GROWTH_INDEX = [1.00, 1.15, 1.30]
SHRINK_INDEX = [1.00, 0.95, 0.90]


def stg_consumption_revenue(transactions: DataFrame, party: DataFrame, base_year: int = 2023,
                            shares=PLATFORM_SHARES, growth=GROWTH_INDEX, shrink=SHRINK_INDEX) -> DataFrame:
    """Consumption attribution of revenue to a platform with a growth index.

    The reference also joins the hierarchy and billings without using them
    (the billing join can even fan rows out); both joins are dropped here.
    """
    from decimal import Decimal

    cust = party_by_role(party, "customer_id", "customer_name")
    df = transactions.join(cust, "customer_id", "left")
    bucket = F.pmod(F.col("third_party_id"), F.lit(100))
    platform, edge = None, 0
    for name, share in shares:
        edge += share
        platform = (F.when(bucket < edge, name) if platform is None else platform.when(bucket < edge, name))
    year = F.year("transaction_date")
    grows = ~F.pmod(F.col("third_party_id"), F.lit(10)).isin(*SHRINKING_DIGITS)
    factor = None
    for i, g in enumerate(growth):
        cond = grows & (year == base_year + i)
        factor = F.when(cond, F.lit(Decimal(str(g)))) if factor is None else factor.when(cond, F.lit(Decimal(str(g))))
    for i, s in enumerate(shrink):
        factor = factor.when(year == base_year + i, F.lit(Decimal(str(s))))
    factor = factor.otherwise(F.lit(Decimal("1.00"))).cast("decimal(3,2)")
    return df.select(
        "rev_trx_id", F.to_date("transaction_date").alias("transaction_date"), "customer_id", "third_party_id",
        "customer_name", platform.alias("platform"), F.col("amount").cast(MONEY).alias("amount"),
        (F.col("amount").cast(MONEY) * factor).cast(MONEY).alias("fab_amount"),
    )
