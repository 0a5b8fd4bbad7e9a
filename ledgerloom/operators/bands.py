"""Banding of a numeric column into labelled ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col


def band(col, edges: list, labels: list[str]) -> Column:
    """labels[i] for values below edges[i] (first match), labels[-1] otherwise.

    ``len(labels) == len(edges) + 1``; a null value gets the last label, as a
    CASE without a null branch does.
    """
    c = as_col(col)
    out = None
    for edge, label in zip(edges, labels):
        out = F.when(c < edge, label) if out is None else out.when(c < edge, label)
    return out.otherwise(labels[-1]) if out is not None else F.lit(labels[-1])
