"""Chart of accounts: account classes and normal balance sides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col

# Fixed values (must equal the reference for identical ledgers):
# the six general-ledger accounts as (number, name, type, description).
CHART_OF_ACCOUNTS = [
    (1000, "Cash", "Asset", "Cash and bank accounts"),
    (1100, "Accounts Receivable", "Asset", "Customer receivables"),
    (2000, "Accounts Payable", "Liability", "Supplier payables"),
    (4000, "Sales Revenue", "Revenue", "Revenue from sales"),
    (5000, "Operating Expenses", "Expense", "General operating expenses"),
    (5100, "Tax Expense", "Expense", "Tax and VAT expenses"),
]
ACCOUNT_NAME = {number: name for number, name, _, _ in CHART_OF_ACCOUNTS}

# Account number ranges per class, lower bound inclusive.
#   below 2000 Asset, 2000-2999 Liability, 3000-3999 Equity,
#   4000-4999 Revenue, 5000 and above Expense, null -> Other.
# Debit-normal classes: Asset, Expense; every other class is credit-normal.
DEBIT_NORMAL = ("Asset", "Expense")


def account_type(account_number) -> Column:
    n = as_col(account_number)
    return (F.when(n < 2000, "Asset")
            .when(n < 3000, "Liability")
            .when(n < 4000, "Equity")
            .when(n < 5000, "Revenue")
            .when(n >= 5000, "Expense")
            .otherwise("Other"))


def normal_balance(account_type_col) -> Column:
    return F.when(as_col(account_type_col).isin(*DEBIT_NORMAL), "Debit").otherwise("Credit")
