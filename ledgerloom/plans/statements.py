"""Financial statements from a trial-balance snapshot (Q15, Q16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.trial_balance import BALANCE

BALANCE_SHEET_TYPES = ("Asset", "Liability", "Equity")
INCOME_TYPES = ("Revenue", "Expense")


def balance_sheet(tb: DataFrame, as_of) -> DataFrame:
    """Asset rows at their debit balance, liability / equity rows at their credit balance."""
    t = F.col("account_type")
    return (tb.where((F.col("as_of_date") == F.lit(as_of).cast("date")) & t.isin(*BALANCE_SHEET_TYPES))
            .select(t.alias("statement_section"), "account_number", "account_name", "debit_balance",
                    "credit_balance",
                    F.when(t == "Asset", F.col("debit_balance"))
                    .when(t.isin("Liability", "Equity"), F.col("credit_balance"))
                    .otherwise(F.lit(0).cast(BALANCE)).alias("balance")))


def income_statement(tb: DataFrame, as_of) -> DataFrame:
    """Revenue rows at their credit balance, expense rows at their debit balance."""
    t = F.col("account_type")
    return (tb.where((F.col("as_of_date") == F.lit(as_of).cast("date")) & t.isin(*INCOME_TYPES))
            .select(t.alias("statement_section"), "account_number", "account_name", "debit_balance",
                    "credit_balance",
                    F.when(t == "Revenue", F.col("credit_balance"))
                    .when(t == "Expense", F.col("debit_balance"))
                    .otherwise(F.lit(0).cast(BALANCE)).alias("balance")))
