"""General ledger: chart of accounts and double-entry entries.

G9 dim_gl_accounts, S6-S9 entry staging tables, G10 fact_gl_entries.

Each staged revenue row can produce an invoice entry (AR debit / revenue
credit) and a payment entry (cash debit / AR credit, net of retention); each
staged spend row an invoice entry (expense and tax debits / AP credit) and a
payment entry (AP debit / cash credit).  ``explode_legs`` emits all of them
in one scan per staging table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.accounts import ACCOUNT_NAME, CHART_OF_ACCOUNTS
from ledgerloom.functions.money import zero_money
from ledgerloom.functions.keys import gl_entry_id
from ledgerloom.operators.legs import Leg, entries, explode_legs, legs_of_entries

GL_COLS = [
    "gl_entry_id", "transaction_id", "transaction_type", "reference_number", "gl_date", "account_number",
    "account_name", "debit_amount", "credit_amount", "third_party_id", "third_party_name",
    "counterparty_role_id", "contract_id", "legal_entity_id", "legal_entity_name", "cost_center_id",
    "cost_center_name", "category", "created_timestamp",
]

REVENUE_INVOICE, REVENUE_PAYMENT = "REVENUE_INVOICE", "REVENUE_PAYMENT"
SPEND_INVOICE, SPEND_PAYMENT = "SPEND_INVOICE", "SPEND_PAYMENT"

# Parts of the staged rows dealt by party, for each of spark.sql.shuffle.partitions.
PARTS_BY_PARTY = 4


def dim_gl_accounts(spark: SparkSession) -> DataFrame:
    """The six-account chart (inline rows)."""
    return spark.createDataFrame(
        CHART_OF_ACCOUNTS, "account_number int, account_name string, account_type string, description string")


def _leg(ttype: str, prefix: str, pos: int, account: int, debit: Column | None, credit: Column | None,
         include: Column, gl_date: Column, reference: Column) -> Leg:
    return Leg(ttype, prefix, pos, account, ACCOUNT_NAME[account], debit, credit, include, gl_date, reference)


def revenue_legs(stg_rev: DataFrame) -> list[Leg]:
    billed = F.col("billed_amount")
    invoiced = F.col("invoice_date").isNotNull() & (billed > 0)
    received = F.col("payment_received_date").isNotNull() & (billed > 0)
    payment = billed - F.coalesce(F.col("retention_amount"), zero_money())
    inv_date, pay_date, ref = F.col("invoice_date"), F.col("payment_received_date"), F.col("invoice_number")
    return [
        _leg(REVENUE_INVOICE, "REV-INV-", 1, 1100, billed, None, invoiced, inv_date, ref),
        _leg(REVENUE_INVOICE, "REV-INV-", 2, 4000, None, billed, invoiced, inv_date, ref),
        _leg(REVENUE_PAYMENT, "REV-PMT-", 1, 1000, payment, None, received, pay_date, ref),
        _leg(REVENUE_PAYMENT, "REV-PMT-", 2, 1100, None, payment, received, pay_date, ref),
    ]


def spend_legs(stg_spend: DataFrame) -> list[Leg]:
    total = F.col("total_invoice_amount")
    # != drops a null status as well as 'cancelled' (three-valued logic, D9).
    invoiced = F.col("invoice_date").isNotNull() & (total > 0) & (F.col("invoice_status") != "cancelled")
    paid = F.col("payment_date").isNotNull() & (F.col("amount_paid") > 0)
    expense = F.col("invoice_amount") - F.coalesce(F.col("discount_amount"), zero_money())
    tax = F.coalesce(F.col("tax_amount"), zero_money())
    inv_date, pay_date = F.col("invoice_date"), F.col("payment_date")
    inv_ref, pay_ref = F.col("invoice_number"), F.col("payment_reference")
    return [
        _leg(SPEND_INVOICE, "SPEND-INV-", 1, 2000, None, total, invoiced, inv_date, inv_ref),
        _leg(SPEND_INVOICE, "SPEND-INV-", 2, 5000, expense, None, invoiced, inv_date, inv_ref),
        _leg(SPEND_INVOICE, "SPEND-INV-", 3, 5100, tax, None, invoiced, inv_date, inv_ref),
        _leg(SPEND_PAYMENT, "SPEND-PMT-", 1, 1000, None, F.col("amount_paid"), paid, pay_date, pay_ref),
        _leg(SPEND_PAYMENT, "SPEND-PMT-", 2, 2000, F.col("amount_paid"), None, paid, pay_date, pay_ref),
    ]


def _finish(df: DataFrame, id_parts: list[str], run_ts: Column | None) -> DataFrame:
    parts = [F.col(p) for p in id_parts] + [F.col("leg_position")]
    entry_id = F.concat(F.col("entry_prefix"), gl_entry_id("", *parts))
    return df.select(
        entry_id.alias("gl_entry_id"), *[c for c in GL_COLS[1:-1]],
        (run_ts if run_ts is not None else F.current_timestamp()).alias("created_timestamp"))


def revenue_entries(stg_rev: DataFrame, types=(REVENUE_INVOICE, REVENUE_PAYMENT),
                    run_ts: Column | None = None) -> DataFrame:
    """S6 + S7 from one scan of stg_revenue_transactions."""
    legs = [leg for leg in revenue_legs(stg_rev) if leg.transaction_type in types]
    keep = _REVENUE_KEEP()
    # Entry id: type prefix, transaction, billing (a transaction may have several), leg position.
    return _finish(explode_legs(stg_rev, legs, keep), ["transaction_id", "billing_id"], run_ts)


def spend_entries(stg_spend: DataFrame, types=(SPEND_INVOICE, SPEND_PAYMENT),
                  run_ts: Column | None = None) -> DataFrame:
    """S8 + S9 from one scan of stg_spend_transactions."""
    legs = [leg for leg in spend_legs(stg_spend) if leg.transaction_type in types]
    keep = _SPEND_KEEP()
    return _finish(explode_legs(stg_spend, legs, keep), ["transaction_id"], run_ts)


def stg_revenue_invoice_entries(stg_rev: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return revenue_entries(stg_rev, (REVENUE_INVOICE,), run_ts)


def stg_revenue_payment_entries(stg_rev: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return revenue_entries(stg_rev, (REVENUE_PAYMENT,), run_ts)


def stg_spend_invoice_entries(stg_spend: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return spend_entries(stg_spend, (SPEND_INVOICE,), run_ts)


def stg_spend_payment_entries(stg_spend: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return spend_entries(stg_spend, (SPEND_PAYMENT,), run_ts)


def with_documents(stg: DataFrame) -> DataFrame:
    """The staged rows with a date that a leg may have.

    Rows without an invoice make no leg.  The generator of legs drops them as well, but
    this condition moves below exchanges and into the join of the invoices.
    """
    dates = ("invoice_date", "payment_received_date" if "payment_received_date" in stg.columns else "payment_date")
    return stg.where(F.col(dates[0]).isNotNull() | F.col(dates[1]).isNotNull())


def by_party(stg: DataFrame, category: str) -> DataFrame:
    """Staged rows dealt by what all legs of a row share: party, entity, cost center and category.

    Balances are summed per account and these four (with their names).  Dealt
    before the legs are made, a row travels once and not once per leg, and every
    later grouping of the ledger that holds the four needs no exchange.  A row
    makes up to five legs that are grouped and sorted in its task, so there are
    more, smaller parts than for another exchange, and they are not coalesced.
    """
    stg = with_documents(stg)
    parts = PARTS_BY_PARTY * int(stg.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stg.repartition(parts, "third_party_id", F.col("coa_meta.legal_entity_id"), F.col("coa_meta.cost_center_id"), category)


def gl_by_party(stg_rev: DataFrame, stg_spend: DataFrame, run_ts: Column | None = None,
                accounts: list[int] | None = None) -> DataFrame:
    """The rows of ``fact_gl_entries`` (or ``gl_for_accounts``) from staged rows dealt by ``by_party``."""
    rev, spend = by_party(stg_rev, "rev_category"), by_party(stg_spend, "invoice_category")
    return fact_gl_entries(rev, spend, run_ts) if accounts is None else gl_for_accounts(rev, spend, accounts, run_ts)


def fact_gl_entries(stg_rev: DataFrame, stg_spend: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """All four entry types; two scans (one per staging table), no shuffle."""
    return revenue_entries(stg_rev, run_ts=run_ts).unionByName(spend_entries(stg_spend, run_ts=run_ts))


def gl_by_date(stg_rev: DataFrame, stg_spend: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The rows of ``fact_gl_entries``, range-partitioned by date.

    Entries are dealt, and their legs made in place.  The transaction is the second
    column, so a day that holds most rows is spread over many tasks.
    """
    out = None
    for stg, legs_of, keep, ids in ((stg_rev, revenue_legs, _REVENUE_KEEP(), ["transaction_id", "billing_id"]),
                                    (stg_spend, spend_legs, _SPEND_KEEP(), ["transaction_id"])):
        legs = legs_of(stg)
        dealt = entries(with_documents(stg), legs, keep).repartitionByRange("gl_date", "transaction_id")
        part = _finish(legs_of_entries(dealt, legs), ids, run_ts)
        out = part if out is None else out.unionByName(part)
    return out


#: The transaction type of an invoice that stands beside its legs.
INVOICE_ITSELF = "INVOICE"


def invoices_and_payables(stg_spend: DataFrame, date: str) -> DataFrame:
    """The payables legs of the ledger and, as one more row dated by ``date``, each invoice itself, from one pass over the staged rows.

    Equal to the rows of account 2000 beside the staged rows with an invoice, without making those twice.
    """
    legs = [leg for leg in spend_legs(stg_spend) if leg.account_number == 2000]
    itself = Leg(INVOICE_ITSELF, "", 0, 0, "", None, None, F.col("invoice_id").isNotNull(), F.col(date), F.col("invoice_number"))
    held = stg_spend.where(F.col("invoice_id").isNotNull() | F.col("invoice_date").isNotNull() | F.col("payment_date").isNotNull())
    return explode_legs(held, [*legs, itself], ["invoice_id", "third_party_id"])


def gl_for_accounts(stg_rev: DataFrame, stg_spend: DataFrame, accounts: list[int],
                    run_ts: Column | None = None) -> DataFrame:
    """The ledger restricted to ``accounts``, building only those legs.

    Equal to ``fact_gl_entries(...).where(account_number IN accounts)``, but
    an account filter cannot be pushed into the generated leg array, so the
    restriction is applied when the legs are chosen: a staging table without
    any of the accounts is not read at all (AR and revenue touch only the
    revenue side, AP only the spend side).
    """
    wanted = set(accounts)
    parts = []
    for stg, legs_of, keep, ids in (
            (stg_rev, revenue_legs, _REVENUE_KEEP, ["transaction_id", "billing_id"]),
            (stg_spend, spend_legs, _SPEND_KEEP, ["transaction_id"])):
        legs = [leg for leg in legs_of(stg) if leg.account_number in wanted]
        if legs:
            parts.append(_finish(explode_legs(stg, legs, keep()), ids, run_ts))
    if not parts:
        return fact_gl_entries(stg_rev, stg_spend, run_ts).where(F.lit(False))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _REVENUE_KEEP():
    return [F.col("rev_trx_id").alias("transaction_id"), "billing_id", "third_party_id",
            F.col("customer_name").alias("third_party_name"), F.col("customer_id").alias("counterparty_role_id"),
            "contract_id", F.col("coa_meta.legal_entity_id").alias("legal_entity_id"),
            F.col("coa_meta.legal_entity_name").alias("legal_entity_name"),
            F.col("coa_meta.cost_center_id").alias("cost_center_id"),
            F.col("coa_meta.cost_center_name").alias("cost_center_name"),
            F.col("rev_category").alias("category")]


def _SPEND_KEEP():
    return [F.col("invoice_id").alias("transaction_id"), "third_party_id",
            F.col("supplier_name").alias("third_party_name"), F.col("supplier_id").alias("counterparty_role_id"),
            "contract_id", F.col("coa_meta.legal_entity_id").alias("legal_entity_id"),
            F.col("coa_meta.legal_entity_name").alias("legal_entity_name"),
            F.col("coa_meta.cost_center_id").alias("cost_center_id"),
            F.col("coa_meta.cost_center_name").alias("cost_center_name"),
            F.col("invoice_category").alias("category")]
