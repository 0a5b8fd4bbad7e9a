"""Best-fit packing of documents into sequences of a fixed token budget.

Documents become pieces of at most ``budget`` tokens.  Pieces are range-sorted
by length in Spark, which gives every piece its rank among the pieces of equal
length.  There is no distributed sweep in which pieces look for their gaps: the
sweeps are replaced by a plan over length counts.  ``plan_sweeps`` is a
sequential best-fit-decreasing loop on the driver that takes one length at a
time, longest first, puts its pieces into the smallest gaps that hold them and
opens new sequences for the rest.  The result is exactly the packing of
sequential best-fit decreasing.

That works on counts since all pieces of one length are alike, and so are all
sequences with the same gap.  The plan's state is kept as runs: (gap, offset,
first sequence, number of sequences).  Its size depends on the number of
different lengths, which the budget bounds, and not on the number of
documents: one count per length is all that leaves the executors.  The executors
look up the finished moves: each range partition maps its pieces' (length,
rank) to sequences by binary search (``place``).

Null texts count as empty, and an empty text still holds its closing id, so
every row has at least one piece.  Rows that repeat a ``doc_id`` are packed as
separate rows.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.bpe import encoder
from ledgerloom.llm.common import SLICE_BYTES, keep_in_worker, map_frames, stored

BUDGET = 2048
#: Id that closes every document.
END_ID = 0


class Move(NamedTuple):
    """Pieces of ``length`` with ranks from ``rank`` on, ``each`` to a sequence, from sequence ``first`` on."""

    length: int
    rank: int
    first: int
    offset: int
    each: int


def cut(length: int, budget: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than the budget."""
    head = length % budget or budget
    return [(0, min(head, length))] + [(s, budget) for s in range(head, length, budget)]


def pieces(docs: DataFrame, path: str, budget: int = BUDGET, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents as token pieces; ``with_ids`` keeps the ids.

    The ids are those of the tokenizers library with the same vocabulary.
    """
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_in_worker("encoder", encoder.cache_clear)
        enc = encoder(path)
        for pdf in batches:
            rows = []
            texts = enc.encode_all(t or "" for t in pdf["text"])
            for doc_id, ids in zip(pdf["doc_id"].tolist(), texts, strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), budget)):
                    own = ids[start:start + length]
                    row = (doc_id, k, start, length, zlib.crc32(own.tobytes()))
                    rows.append((*row, own.astype(np.int32)) if with_ids else row)
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return map_frames(docs.select("doc_id", "text"), run, T.StructType(fields), SLICE_BYTES)


def plan_sweeps(counts: dict[int, int], budget: int = BUDGET) -> list[Move]:
    """Moves that pack ``counts[length]`` pieces of every length, best fit, longest first."""
    gaps: list[int] = []                              # the different gaps, ascending
    runs: dict[int, list[tuple[int, int, int]]] = {}  # gap -> [(offset, first sequence, sequences)]
    moves: list[Move] = []
    opened = 0

    def free(gap: int, offset: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in runs:
                bisect.insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((offset, first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                offset, first, n = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[at]
            else:
                gap, offset, first = budget, 0, opened
                n = -(-left // (budget // length))
                opened += n
            # Best fit puts the next piece of this length into the sequence it
            # has just made tighter, so each sequence takes as many as it holds.
            each = gap // length
            full = min(n, left // each)
            if full:
                moves.append(Move(length, rank, first, offset, each))
                free(gap - each * length, offset + each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:
                moves.append(Move(length, rank, first + full, offset, left))
                free(gap - left * length, offset + left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            free(gap, offset, first + full, n - full)
    return moves


def ranked(parts: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Pieces with ``rank`` among those of equal length, and the number of pieces of every length.

    The pieces are range-sorted by (length, doc_id, piece), so a length that
    many share is spread over partitions; a rank is the place within the
    partition plus what earlier partitions hold of that length.
    """
    order = ["length", "doc_id", "piece", "start"]
    # Range partitioning reads its input twice, so the pieces are made first.
    parts = stored(parts, "pieces")
    split = stored(parts.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("part", F.spark_partition_id())
                   .withColumn("place", F.monotonically_increasing_id()), "sorted")
    # One row for each length and partition; the lengths are bounded by the budget.
    held = split.groupBy("length", "part").agg(F.count("*").alias("n"), F.min("place").alias("low"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("length", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("base"))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator()}
    with_rank = split.join(base, ["length", "part"]).withColumn("rank", F.col("place") + F.col("base"))
    return with_rank.drop("part", "place", "base"), counts


def place(with_rank: DataFrame, moves: list[Move]) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ranked pieces."""
    table = np.array(moves, np.int64).reshape(-1, 5)
    order = np.lexsort((table[:, 1], table[:, 0]))
    table = table[order]
    # Length and rank in one number, ascending as the moves are.
    keys = table[:, 0].astype(object) * (1 << 50) + table[:, 1].astype(object)
    keys = np.array(keys, np.int64) if len(keys) else np.zeros(0, np.int64)
    shared = with_rank.sparkSession.sparkContext.broadcast((keys, table))
    schema = T.StructType([f for f in with_rank.schema.fields if f.name != "rank"] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, table = shared.value
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(np.int64), pdf["rank"].to_numpy(np.int64)
            move = table[np.searchsorted(keys, (length << 50) + rank, side="right") - 1]
            nth = rank - move[:, 1]
            yield pdf.drop(columns="rank").assign(sequence_id=move[:, 2] + nth // move[:, 4],
                                                  offset=move[:, 3] + nth % move[:, 4] * length)

    return map_frames(with_rank, run, schema)


def pack(docs: DataFrame, path: str, budget: int = BUDGET, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    with_rank, counts = ranked(pieces(docs, path, budget, end_id, with_ids))
    order = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return place(with_rank, plan_sweeps(counts, budget)).select(*order, *["ids"] * with_ids)
