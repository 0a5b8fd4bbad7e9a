"""Exact distinct counts of several columns without multiplying rows.

``count(DISTINCT a), count(DISTINCT b)`` makes Spark copy every row once per
column (``Expand``).  Here each column is counted by its own narrow pass, which
reads that column alone:

- Keys numbered densely become bitmaps: one bit per key in buckets of 32,768
  keys, so the shuffle carries 4 KB for up to 32,768 keys, and duplicates
  collapse before it.
- Any other column is grouped twice (the values, then their number), which also
  gives the number of rows.  Partial aggregation collapses hot values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _by_bitmap(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column)
    buckets = df.groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"), F.count(value).alias("known"), F.count("*").alias("n"))
    # Nulls set no bit but make a bucket of their own.
    return buckets.agg(F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits"))), F.lit(0)).alias("different"),
                       *(F.coalesce(F.sum(c), F.lit(0)).alias(o) for c, o in (("known", "known"), ("n", "n_rows"))))


def _by_groups(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n")).agg(
        F.count("v").alias("different"), F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("known"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def distinct_counts(df: DataFrame, columns: list[str], dense: list[str] = ()) -> DataFrame:
    """(column, n_rows, known, different): rows, non-null and distinct non-null values of each of ``columns``.

    ``dense`` names those that are integers numbered without wide gaps; a key
    drawn at random would make a bitmap of 4 KB for each of its values.
    """
    out = None
    for c in columns:
        found = (_by_bitmap if c in dense else _by_groups)(df.select(c), c)
        part = found.select(F.lit(c).alias("column"), *(F.col(n).cast("long").alias(n) for n in ("n_rows", "known", "different")))
        out = part if out is None else out.unionByName(part)
    return out


def as_row(counts: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """One row of ``names``: output name -> (column, one of its counts)."""
    return counts.agg(*(F.max(F.when(F.col("column") == c, F.col(kind))).alias(n) for n, (c, kind) in names.items()))
