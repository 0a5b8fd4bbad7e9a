"""Bronze facts as bucketed catalog tables, so that staging joins them in place.

Every product that starts from orders with their invoices, or transactions with
their billings, joins the two large facts on one key.  Stored once by that key,
bucketed and sorted, they are joined bucket by bucket: no exchange of the facts.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources import readers, sinks

# The key on which a bronze fact meets its other half.
BUCKET_KEYS = {"purchase_orders": "purchase_order_id", "spend_invoices": "purchase_order_id",
               "revenue_transactions": "rev_trx_id", "revenue_billings": "rev_trx_id"}


# A bucket is written, sorted and joined by one task: half a million rows of the
# widest fact take some 300 MB there.  Small facts keep a few buckets all the same.
BUCKET_ROWS, FEWEST_BUCKETS = 500_000, 8


def buckets_for(facts: list[DataFrame]) -> int:
    """Buckets for facts that are joined with each other: by the rows of the largest (a counting job each)."""
    return max(FEWEST_BUCKETS, *(math.ceil(f.count() / BUCKET_ROWS) for f in facts))


class BucketedInputs:
    """``inputs`` whose facts are read from bucketed tables of ``database``.

    ``build`` writes them, in ``buckets`` buckets each or, unless that is given,
    as many as the rows ask for.  Other inputs come as they are.
    """

    def __init__(self, spark: SparkSession, inputs, buckets: int | None = None, database: str | None = None, root: str | None = None):
        self.spark, self.inputs, self.buckets = spark, inputs, buckets
        self.database = database or f"bronze_{uuid.uuid4().hex[:12]}"
        self.root = root or sinks.new_scratch(spark, "bucketed")
        self._built: set[str] = set()

    def build(self, names: list[str] | None = None) -> "BucketedInputs":
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        names = list(names or BUCKET_KEYS)
        buckets = {key: self.buckets or buckets_for([getattr(self.inputs, n) for n in names if BUCKET_KEYS[n] == key])
                   for key in {BUCKET_KEYS[n] for n in names}}
        for name in names:
            sinks.write_bucketed(getattr(self.inputs, name), f"{self.database}.{name}", BUCKET_KEYS[name], buckets[BUCKET_KEYS[name]],
                                 f"{self.root}/{name}", f"{name} by {BUCKET_KEYS[name]}")
            self._built.add(name)
        return self

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self._built:
            return readers.read_table(self.spark, f"{self.database}.{name}")
        return getattr(self.inputs, name)
