"""Deterministic keys.

Every id is a function of business keys, so a recomputed partition (after an
executor is lost) yields the same ids; nothing uses ``rand`` or
``monotonically_increasing_id`` on a path that feeds a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col


def gl_entry_id(prefix: str, *parts) -> Column:
    """'PREFIX-part1-part2-...' from business keys (null parts render as 'null')."""
    pieces = [F.lit(prefix)]
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(F.coalesce(as_col(p).cast("string"), F.lit("null")))
    return F.concat(*pieces)


def scenario_number(cost_center_id, legal_entity_id, year, quarter) -> Column:
    """Numeric id of a planning scenario: ccccllllllyyyyq for ids below 10**4 / 10**6."""
    return ((as_col(cost_center_id).cast("long") * 1000000 + as_col(legal_entity_id).cast("long"))
            * 100000 + as_col(year).cast("long") * 10 + as_col(quarter).cast("long"))


def bucket(key, salt: str, buckets: int) -> Column:
    """Deterministic bucket in [0, buckets) from a hashed key and a salt.

    Used for reproducible sampling and A/B splits.  The first eight hexadecimal
    digits of an MD5 are the same number in every engine and never negative.
    """
    digits = F.substring(F.md5(F.concat(as_col(key).cast("string"), F.lit(salt))), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % F.lit(buckets)).cast("int")


def with_sequence_id(df: DataFrame, order_cols: list[str], block: Column, start: int = 1,
                     name: str = "seq_id") -> DataFrame:
    """Dense 0-gap numbering of all rows in ``order_cols`` order, plus ``start``.

    The reference numbers rows with ``row_number()`` over the whole table, which
    sorts everything in one task.  Here ``block`` cuts the order into
    consecutive blocks (any non-decreasing function of the order, such as a key
    divided by a block size): rows are numbered inside their block, and a block
    begins where the counts of the earlier ones end (one row per block).
    ``order_cols`` must be a unique key; then a recomputed task gives the same
    numbers, and building the plan runs no job.
    """
    blocks = df.withColumn("_block", block)
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(*order_cols))
    counts = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_block").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (blocks.withColumn("_inside", inside).join(offsets, F.col("_block").eqNullSafe(F.col("_of")))
            .withColumn(name, F.col("_before") + F.col("_inside") + F.lit(start - 1))
            .drop("_block", "_of", "_before", "_inside"))
