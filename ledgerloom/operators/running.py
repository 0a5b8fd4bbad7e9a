"""Running totals that stay balanced when one group is huge.

A running sum over ``Window.partitionBy(group).orderBy(...)`` puts a whole
group in one task; a contract holding a third of all transactions would
then be sorted by a single core.  ``running_sum`` computes the same prefix
sums in two levels:

1. per (group, chunk) totals, where a chunk is a coarse ordering key such as
   the transaction date - aggregated map-side, so the shuffle is small;
2. each chunk's offset = running total of the earlier chunks of its group
   (window over the small per-chunk table);
3. within each (group, chunk) the local running sum (window partitioned by
   group *and* chunk, so the hot group is spread over many tasks), plus the
   chunk's offset.

Where one (group, chunk) itself holds very many rows (a bulk load of one day),
``split_by`` cuts it further: quantiles of that ordering column, from a mergeable
sketch of bounded size, part the chunk's rows into SPLITS sub-chunks, which are
chunks like any other from then on.  The quantiles need not be exact, since any
cut between rows gives the same sums.

Rows are ordered by (chunk, *order); the result equals a single window over
the group ordered the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a (group, chunk) above which it is split, and into how many parts.
SPLIT_ROWS, SPLITS = 1_000_000, 64


def _sub_chunks(df: DataFrame, group: str, chunk: str, split_by: str, limit: int) -> DataFrame:
    """``df`` with ``_sub``: how many of its chunk's bounds a row is above; 0 in chunks that are not split."""
    shares = [k / SPLITS for k in range(1, SPLITS)]
    large = df.groupBy(group, chunk).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(group, chunk)
    # Only the rows of large chunks are sketched; where there are none, adaptive execution drops this branch.
    bounds = (df.select(group, chunk, split_by).join(large, [group, chunk], "left_semi").groupBy(group, chunk)
              .agg(F.array_distinct(F.percentile_approx(split_by, shares, 10_000)).alias("_bounds")))
    above = F.size(F.filter("_bounds", lambda b: b < F.col(split_by)))
    return (df.join(bounds, [group, chunk], "left")
            .withColumn("_sub", F.when(F.col("_bounds").isNull(), 0).otherwise(above)).drop("_bounds"))


def running_sum(df: DataFrame, group: str, chunk: str, order: list[str], value: str, out: str = "running_total",
                split_by: str | None = None, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Adds ``out``; ``split_by`` is the first column of ``order``, a number, where chunks may be large."""
    df = _sub_chunks(df, group, chunk, split_by, split_rows) if split_by else df.withColumn("_sub", F.lit(0))
    chunk_totals = df.groupBy(group, chunk, "_sub").agg(F.sum(value).alias("_chunk_total"))
    w_chunks = Window.partitionBy(group).orderBy(chunk, "_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunk_totals.select(group, chunk, "_sub", F.sum("_chunk_total").over(w_chunks).alias("_offset"))
    w_local = Window.partitionBy(group, chunk, "_sub").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_local", F.sum(value).over(w_local))
    return (local.join(offsets, [group, chunk, "_sub"], "left")
            .withColumn(out, F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_local"))
            .drop("_offset", "_local", "_sub"))
