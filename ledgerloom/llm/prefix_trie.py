"""The trie of conversation prefixes, from vertical bitmaps.

A node stands for a sequence of first turns (role and text), its members are the
conversations that begin with it.  The steps:

1. ``numbered`` gives every turn its place in its conversation.  Turns are
   range-sorted by (conversation, turn), so a conversation with a third of all
   rows is spread over partitions; what earlier partitions hold of it is added.
2. A turn becomes two 50-bit hashes of (place, role, text), and a prefix is
   the sum of its turns' hashes: equal prefixes have equal keys, and sums can be
   taken piece by piece (``PIECE`` turns), so long conversations are split.
3. ``vertical`` cuts the range-sorted pieces into shards of ``SHARD``
   pieces.  A shard's index maps (place, turn) to a bitset of its
   conversations.  A depth-first search from the whole shard intersects the
   parent's bitset with the postings of its next turns, which yields the children,
   their members (bits), smallest member and the list of conversations that end.
4. The shards' partial nodes are added up by key.
5. A node belongs to its smallest member.  What a conversation owns is a suffix
   of its path, so sums over a subtree are sums over its members of what they own
   from that depth on: suffix sums per piece, then one aggregate by key.

Rules: null roles and texts are empty; turns of one conversation are ordered by
turn (null first), then role and text, so ties and repeated rows have one order.
Rows without a conversation id are not part of any conversation.  An empty table
has no conversation and gives no node.  Other columns are ignored.  The list of
conversations that end at a node is hashed in one pass over its shards' parts,
in order, without being held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.common import discard, stored

#: Turns that a shard takes of a conversation at once, and such pieces in a shard.
PIECE, SHARD = 2048, 1024
#: Turns in a shard, after which it ends with the piece at hand.
SHARD_TURNS = 1 << 17
#: Longest prefix that a conversation can borrow.
BORROWED = 6
_MASK = (1 << 50) - 1


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, size): turns with their place from 1 on, a digest of role and text, and code points."""
    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    said = F.concat_ws(":", F.char_length("role").cast("string"), "role", "text")
    split = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.md5(said).alias("digest"), F.char_length("text").cast("long").alias("size"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "turns")
    held = split.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("row").alias("low"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low") + 1).alias("base"))
    placed = stored(split.join(base, ["conv_id", "part"]).select(
        "conv_id", (F.col("row") + F.col("base")).alias("place"), "digest", "size"), "places")
    discard(split)
    return placed


def hashed(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, size): every turn as two hashes of its depth and digest, and its code points."""
    depth = F.col("depth").cast("long")
    return rows.select("conv_id", depth.alias("depth"), F.xxhash64(depth, "digest").bitwiseAND(_MASK).alias("a"),
                       F.xxhash64("digest", depth, F.lit("b")).bitwiseAND(_MASK).alias("b"), "size")


def whole(conversations: DataFrame) -> DataFrame:
    """Conversations as they are: hashed turns, and a row of depth 0 for each."""
    rows = numbered(conversations)
    return _rooted(hashed(rows.withColumnRenamed("place", "depth")), rows.select("conv_id").distinct())


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversation c as the first h turns of conversation c - c % 100 and its own turns after its first h.

    h is crc32 of c as text, modulo ``BORROWED``.  Where the other conversation has
    fewer turns all are taken, where it is absent none, and c's own turns follow
    at once.  The remainder of a negative id is that of floored division.
    """
    rows = numbered(conversations)
    convs = rows.groupBy("conv_id").agg(F.max("place").alias("own")).select(
        "conv_id", "own", (F.col("conv_id") - F.pmod("conv_id", F.lit(100))).alias("source"),
        (F.crc32(F.col("conv_id").cast("string")) % BORROWED).alias("h"))
    length = convs.select(F.col("conv_id").alias("source"), F.col("own").alias("there"))
    convs = stored(convs.join(length, "source", "left").select(
        "conv_id", "source", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")), "conversations")
    heads = rows.where(F.col("place") < BORROWED).withColumnRenamed("conv_id", "source")
    # At most 100 conversations share a source and at most five of its turns are taken.
    borrowed = convs.join(heads, "source").where("place <= taken").select("conv_id", F.col("place").alias("depth"), "digest", "size")
    own = rows.join(convs, "conv_id").where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "digest", "size")
    out = stored(_rooted(hashed(borrowed.unionByName(own)), convs.select("conv_id")), "rebuilt")
    discard(rows, convs)
    return out


def _rooted(rows: DataFrame, convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return rows.unionByName(convs.select("conv_id", *(zero.alias(c) for c in ("depth", "a", "b", "size"))))


def _piece() -> Column:
    """Piece of a depth: depths 0 to PIECE are the first."""
    return F.greatest(F.lit(0), F.floor((F.col("depth") - 1) / PIECE)).cast("long")


def _offsets(pieces: DataFrame, values: list[str], order: Column) -> DataFrame:
    """Per (conv_id, piece) the sums of ``values`` over the pieces before it in ``order``; sums exceed no long."""
    before = Window.partitionBy("conv_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select("conv_id", "piece", *(F.coalesce(F.sum(F.col(v).cast("decimal(38,0)")).over(before), F.lit(0)).alias(f"{v}_0")
                                               for v in values))


def with_keys(rows: DataFrame) -> DataFrame:
    """Adds ``piece``, ``last`` (the conversation's depth) and the prefix's key (ka, kb)."""
    rows = rows.withColumn("piece", _piece())
    within = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv_id", "piece")
    keyed = stored(rows.select("*", F.max("depth").over(whole).alias("end"),
                               *(F.sum(c).over(within).bitwiseAND(_MASK).alias(f"k{c}") for c in "ab")), "keyed")
    # Only conversations of several pieces need what earlier pieces hold.
    long = keyed.where("piece > 0").select("conv_id").distinct()
    sums = keyed.join(long, "conv_id", "left_semi").groupBy("conv_id", "piece").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.max("end").alias("end"))
    ends = Window.partitionBy("conv_id")
    offsets = _offsets(sums, ["a", "b"], F.col("piece")).join(
        sums.select("conv_id", "piece", F.max("end").over(ends).alias("last")), ["conv_id", "piece"])
    moved = keyed.join(offsets, ["conv_id", "piece"], "left")
    shifted = lambda c: ((F.col(f"k{c}") + F.coalesce(F.col(f"{c}_0") % (_MASK + 1), F.lit(0)).cast("long"))
                         .bitwiseAND(_MASK).alias(f"k{c}"))
    return moved.select("conv_id", "piece", "depth", "a", "b", "size", F.coalesce("last", "end").alias("last"),
                        shifted("a"), shifted("b"))


_PARTIAL = T.StructType([T.StructField(n, T.LongType()) for n in ("ka", "kb", "pa", "pb", "depth", "conv_id", "n", "size")]
                        + [T.StructField("ends", T.BinaryType())])


def _search(cols: dict[str, np.ndarray], starts: np.ndarray) -> list[tuple]:
    """The nodes of one shard, whose pieces begin at ``starts`` in the columns."""
    stops = np.append(starts[1:], len(cols["depth"])).tolist()
    starts = starts.tolist()
    depth, a, b, ka, kb, size, conv, last = (cols[c].tolist() for c in ("depth", "a", "b", "ka", "kb", "size", "conv_id", "last"))
    postings: dict[tuple[int, int, int], int] = {}
    ended: dict[int, int] = {}
    roots: dict[tuple[int, int, int], int] = {}
    for k, (low, high) in enumerate(zip(starts, stops, strict=True)):
        bit = 1 << k
        for i in range(low, high):
            at = (depth[i], a[i], b[i])
            postings[at] = postings.get(at, 0) | bit
        ended[depth[high - 1]] = ended.get(depth[high - 1], 0) | bit
        # A later piece begins below the node that its conversation has reached.
        above = (depth[low] - 1, (ka[low] - a[low]) & _MASK, (kb[low] - b[low]) & _MASK)
        roots[above] = roots.get(above, 0) | bit
    out = []
    stack = [(bits, d, a0, b0) for (d, a0, b0), bits in roots.items()]
    while stack:
        rest, d, pa_, pb_ = stack.pop()
        d += 1
        while rest:
            first = (rest & -rest).bit_length() - 1
            i = starts[first] + d - depth[starts[first]]
            child = rest & postings[d, a[i], b[i]]
            rest ^= child
            done = child & ended.get(d, 0)
            ends, left = [], done
            while left:
                low = left & -left
                k = low.bit_length() - 1
                left ^= low
                if last[starts[k]] == d:
                    ends.append(conv[starts[k]])
            out.append((ka[i], kb[i], pa_, pb_, d, conv[i], child.bit_count(), size[i], np.array(ends, "<i8").tobytes() or None))
            if child != done:
                stack.append((child ^ done, d, ka[i], kb[i]))
    return out


def vertical(rows: DataFrame) -> DataFrame:
    """Partial nodes of every shard: key, parent's key, depth, smallest member, members, code points, ends."""
    target = to_arrow_schema(_PARTIAL)
    names = ["conv_id", "piece", "depth", "a", "b", "size", "last", "ka", "kb"]

    def nodes(parts: list[pa.RecordBatch], final: bool) -> tuple[list[pa.RecordBatch], pa.RecordBatch | None]:
        """Nodes of the full shards of ``parts``, and the rows that may belong to a shard not yet full."""
        table = pa.Table.from_batches(parts).combine_chunks()
        cols = {n: table.column(n).to_numpy() for n in names}
        new = np.flatnonzero(np.concatenate([[True], (np.diff(cols["conv_id"]) != 0) | (np.diff(cols["piece"]) != 0)]))
        made, first = [], 0
        known = len(new) if final else len(new) - 1     # the last piece may go on in the next batch
        while first < known:
            over = int(np.searchsorted(new, new[first] + SHARD_TURNS, side="right"))
            stop = min(first + SHARD, max(first + 1, over))
            if stop > known or (stop == known and not final):
                if not final:
                    break
                stop = known
            low, high = new[first], new[stop] if stop < len(new) else table.num_rows
            found = _search({n: c[low:high] for n, c in cols.items()}, new[first:stop] - low)
            made.append(pa.RecordBatch.from_arrays(
                [pa.array(list(column), f.type) for column, f in zip(zip(*found, strict=True), target, strict=True)], schema=target))
            first = stop
        if first == len(new):
            return made, None
        rest = table.slice(int(new[first])).combine_chunks().to_batches()
        return made, rest[0] if rest else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * SHARD_TURNS:
                made, rest = nodes(held, False)
                yield from made
                held = [rest] if rest is not None else []
        if held:
            yield from nodes(held, True)[0]

    ranged = rows.select(*names).repartitionByRange("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "depth")
    return ranged.mapInArrow(run, _PARTIAL)


def end_digests(partial: DataFrame) -> DataFrame:
    """(ka, kb, ends_sha256) of the nodes at which conversations end, by one ordered pass over the shards' lists."""
    schema = T.StructType([T.StructField("ka", T.LongType()), T.StructField("kb", T.LongType()),
                           T.StructField("ends_sha256", T.StringType())])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for batch in batches:
            for ka, kb, ends in zip(*(batch.column(c).to_pylist() for c in ("ka", "kb", "ends")), strict=True):
                if (ka, kb) != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (ka, kb), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, np.frombuffer(ends, "<i8").tolist())).encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(target)], schema=target)
            out = []
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, digest.hexdigest()), target, strict=True)],
                                             schema=target)

    # Shards hold ranges of conversations, so their lists follow one another.
    lists = partial.where("ends is not null").select("ka", "kb", "conv_id", "ends")
    return lists.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "conv_id").mapInArrow(run, schema)


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of ``whole`` or ``rebuilt`` conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (code points of last turns that all members but one repeat, summed
    over the subtree), ends_sha256 (of the ids of the members that end there).
    """
    keyed = stored(with_keys(rows), "keys")
    partial = stored(vertical(keyed), "shards")
    key, above = ["ka", "kb"], ["pa", "pb"]
    nodes = stored(partial.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.sum("n").alias("n_convs"),
                                             F.max("size").alias("size"), F.min("pa").alias("pa"), F.min("pb").alias("pb")), "nodes")
    children = nodes.where("depth > 0").groupBy(*above).agg(F.count("*").alias("n_children")).toDF(*key, "n_children")
    nodes = stored(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "tree")
    weights = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("size")).cast("decimal(38,0)").alias("saved"),
                           (F.col("n_children") == 0).cast("long").alias("leaf"))
    onward = Window.partitionBy("conv_id", "piece").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = stored(keyed.join(weights, ["conv_id", "depth"], "left").select(
        "conv_id", "piece", "last", *key, *(F.sum(F.coalesce(c, F.lit(0))).over(onward).alias(c) for c in ("saved", "leaf")),
        F.sum(F.coalesce("saved", F.lit(0))).over(Window.partitionBy("conv_id", "piece")).alias("all_saved"),
        F.sum(F.coalesce("leaf", F.lit(0))).over(Window.partitionBy("conv_id", "piece")).alias("all_leaf")), "owned")
    long = own.where(F.col("last") > PIECE)
    sums = long.groupBy("conv_id", "piece").agg(F.max("all_saved").alias("saved"), F.max("all_leaf").alias("leaf"))
    later = _offsets(sums, ["saved", "leaf"], F.desc("piece"))
    added = long.join(later, ["conv_id", "piece"]).select(
        *key, (F.col("saved") + F.col("saved_0")).alias("saved"), (F.col("leaf") + F.col("leaf_0")).alias("leaf"))
    totals = own.where(F.col("last") <= PIECE).select(*key, "saved", "leaf").unionByName(added).groupBy(*key).agg(
        F.sum("saved").cast("long").alias("saved_tokens"), F.sum("leaf").cast("long").alias("n_leaves"))
    parents = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    rooted = nodes.where("depth > 0").join(parents, above).unionByName(
        nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    found = rooted.join(totals, key).join(end_digests(partial), key, "left")
    result = stored(found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                 F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")), "trie")
    discard(keyed, partial, nodes, own)
    return result
