"""Double-entry leg generation.

The reference cross-joins each transaction with a 2-3 row account table and
numbers the legs with ``row_number()`` over a window per transaction, i.e. one
Cartesian product and one shuffle + sort per entry type.  Here every source
row emits the numbers of its legs through ``explode(array(...))``: a narrow,
per-row operation with no shuffle.  Several entry types (invoice and payment)
can be emitted from one scan of the staging table; each leg carries a static
position (the account-number order the reference numbers by) and an
``include`` condition.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import MONEY, zero_money


@dataclass(frozen=True)
class Leg:
    transaction_type: str      # e.g. 'REVENUE_INVOICE'
    entry_prefix: str          # e.g. 'REV-INV-'
    position: int              # 1-based, in account-number order within the entry
    account_number: int
    account_name: str
    debit: Column | None       # amount debited, None -> 0
    credit: Column | None      # amount credited, None -> 0
    include: Column            # which source rows emit this leg
    gl_date: Column
    reference_number: Column


def explode_legs(df: DataFrame, legs: list[Leg], keep: list[Column | str]) -> DataFrame:
    """Emit one row per (source row, included leg).

    Output columns: ``keep`` + transaction_type, entry_prefix, leg_position,
    account_number, account_name, debit_amount, credit_amount, gl_date,
    reference_number.

    Only the numbers of the included legs are exploded; a leg's fields are
    picked by its number from the columns of the row.  So a field that nobody
    reads needs none of its columns, in the exchanges below as well.
    """
    numbers = F.array(*(F.when(leg.include, F.lit(i)).otherwise(F.lit(-1)) for i, leg in enumerate(legs)))
    rows = df.select("*", F.explode(F.array_remove(numbers, -1)).alias("_leg"))

    def pick(value) -> Column:
        out = F.when(F.col("_leg") == 0, value(legs[0]))
        for i, leg in enumerate(legs[1:], 1):
            out = out.when(F.col("_leg") == i, value(leg))
        return out

    amount = lambda side: side.cast(MONEY) if side is not None else zero_money()
    return rows.select(
        *keep,
        pick(lambda leg: F.lit(leg.transaction_type)).alias("transaction_type"),
        pick(lambda leg: F.lit(leg.entry_prefix)).alias("entry_prefix"),
        pick(lambda leg: F.lit(leg.position)).alias("leg_position"),
        pick(lambda leg: F.lit(leg.account_number).cast("int")).alias("account_number"),
        pick(lambda leg: F.lit(leg.account_name)).alias("account_name"),
        pick(lambda leg: amount(leg.debit)).alias("debit_amount"),
        pick(lambda leg: amount(leg.credit)).alias("credit_amount"),
        pick(lambda leg: F.to_date(leg.gl_date)).alias("gl_date"),
        pick(lambda leg: leg.reference_number.cast("string")).alias("reference_number"))


def entries(df: DataFrame, legs: list[Leg], keep: list[Column | str]) -> DataFrame:
    """One row per (source row, entry type with an included leg), to be dealt before its legs are made.

    Columns: ``keep``, gl_date, reference_number, and what ``legs_of_entries``
    needs to make the rows of ``explode_legs`` from it: the entry's number, its
    included legs as bits and one amount per leg.  An entry travels once and not once
    per leg, without the texts that its legs get from their numbers.  The legs of an
    entry type share their date and reference, and a leg is a debit or a credit.
    """
    if any((leg.debit is None) == (leg.credit is None) for leg in legs):
        raise ValueError("a leg of an entry needs a debit or a credit, and not both")
    types = _by_type(legs)
    has = F.array(*(F.when(reduce(or_, (leg.include for leg in own)), F.lit(i)).otherwise(F.lit(-1)) for i, own in enumerate(types)))
    rows = df.select("*", F.explode(F.array_remove(has, -1)).alias("_entry"))

    def pick(value) -> Column:
        return F.coalesce(*(F.when(F.col("_entry") == i, value(own)) for i, own in enumerate(types)))

    def bits(own) -> Column:
        return reduce(add, (F.when(leg.include, F.lit(1 << k)).otherwise(F.lit(0)) for k, leg in enumerate(own)))

    def amount(k) -> Column:
        return pick(lambda own: F.lit(None).cast(MONEY) if k >= len(own)
                    else (own[k].debit if own[k].debit is not None else own[k].credit).cast(MONEY))

    return rows.select(
        *keep, "_entry", pick(bits).alias("_legs"),
        pick(lambda own: F.to_date(own[0].gl_date)).alias("gl_date"),
        pick(lambda own: own[0].reference_number.cast("string")).alias("reference_number"),
        *(amount(k).alias(f"_amount_{k}") for k in range(max(map(len, types)))))


def legs_of_entries(rows: DataFrame, legs: list[Leg]) -> DataFrame:
    """The rows of ``explode_legs`` from rows of ``entries``, in place."""
    types = _by_type(legs)
    numbered = [(i, k, leg) for i, own in enumerate(types) for k, leg in enumerate(own)]
    widest = range(max(map(len, types)))
    held = F.array(*(F.when(F.col("_legs").bitwiseAND(F.lit(1 << k)) != 0, F.lit(k)).otherwise(F.lit(-1)) for k in widest))
    rows = rows.select("*", F.explode(F.array_remove(held, -1)).alias("_leg"))

    def pick(value) -> Column:
        return F.coalesce(*(F.when((F.col("_entry") == i) & (F.col("_leg") == k), value(leg)) for i, k, leg in numbered))

    amount = F.coalesce(*(F.when(F.col("_leg") == k, F.col(f"_amount_{k}")) for k in widest))

    def side(of) -> Column:
        mine = reduce(or_, ((F.col("_entry") == i) & (F.col("_leg") == k) for i, k, leg in numbered if of(leg) is not None), F.lit(False))
        return F.when(mine, amount).otherwise(zero_money())

    own_columns = {"_entry", "_legs", "_leg", *(f"_amount_{k}" for k in widest)}
    return rows.select(
        *(c for c in rows.columns if c not in own_columns),
        pick(lambda leg: F.lit(leg.transaction_type)).alias("transaction_type"),
        pick(lambda leg: F.lit(leg.entry_prefix)).alias("entry_prefix"),
        pick(lambda leg: F.lit(leg.position)).alias("leg_position"),
        pick(lambda leg: F.lit(leg.account_number).cast("int")).alias("account_number"),
        pick(lambda leg: F.lit(leg.account_name)).alias("account_name"),
        side(lambda leg: leg.debit).alias("debit_amount"),
        side(lambda leg: leg.credit).alias("credit_amount"))


def _by_type(legs: list[Leg]) -> list[list[Leg]]:
    return [[leg for leg in legs if leg.transaction_type == t] for t in dict.fromkeys(leg.transaction_type for leg in legs)]


def number_legs_by_window(legs: DataFrame, entry_cols: list[str], out: str = "window_position") -> DataFrame:
    """The reference's numbering: ``row_number()`` per entry ordered by account.

    Kept as the tested alternative to the static ``leg_position`` (it costs a
    shuffle and a sort per entry type; the static position costs nothing).
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*entry_cols).orderBy("account_number")
    return legs.withColumn(out, F.row_number().over(w))
