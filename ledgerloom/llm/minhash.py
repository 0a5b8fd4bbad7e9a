"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct five-word shingles (words are runs of
non-white-space characters, A-Z lower-cased).  Documents are linked when
100 * intersection >= 75 * union, and a component is what links reach.

1. ``signatures``: 255 minima per set, of which only two low bits each are
   kept, packed into eight longs, and 51 band keys of five whole minima.
   A pair at similarity 0.75 shares no band with probability 1e-6.
2. Documents with equal sets form a class; everything below works on one row
   per class (its smallest doc_id).
3. Classes of one band bucket are candidates of the bucket's smallest class.
   The packed signatures of a pair are compared by bit counts; equal low bits
   also arise by chance, in one of four cases, and the estimate is corrected
   for that.  Pairs five standard errors below the threshold go.
4. The rest is confirmed on the full sets, and the links give components.
5. A bucket may now still hold several components.  Only its members outside
   the component of its smallest class are compared with members of other
   components.  Of these rows a longer signature (``WIDE`` minima) is made, and
   the comparison is part of the join on the bucket: a pair leaves the join
   only if its estimate is promising, and only from the first band it shares.
   What leaves is confirmed on the full sets.  So a large group of copies costs
   one comparison per member and not one per pair, and yet every candidate pair
   across components is decided.

Rows without an id, a text or a word link with nothing.  A null ``doc_id``
cannot be named by others: its component is null and it is kept.  Rows that
repeat a ``doc_id`` are one document: a link of one is a link of all.  Extra
columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import SLICE_BYTES, components, discard, keep_in_worker, made_from, map_frames, stored

WORDS = 5
PERCENT = 75
BANDS, ROWS = 51, 5
LOW_BITS = 2
#: Minima of the longer signature.
WIDE = 768
#: Standard errors that an estimate may lie below the threshold before a pair goes.
SLACK = 5.0

_HASHES = BANDS * ROWS
_rng = np.random.default_rng(20240601)
_A = _rng.integers(1, 1 << 32, WIDE, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, WIDE, dtype=np.uint64).astype(np.uint32)
_MIX1, _MIX2, _STEP = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
#: Elements hashed at a time; bounds the memory of very long texts.
_BLOCK = 2048


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


class _WordHash(dict):
    """word -> 64-bit hash, remembered for up to so many words."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, hashes: _WordHash, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    own = (text or "").encode().lower().split()        # bytes: only A-Z change, only ASCII white space parts
    if not own:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own))
    n = max(1, len(h) - words + 1)
    out = np.full(n, len(own) if len(own) < words else words, np.uint64)
    for k in range(min(words, len(h))):
        out = _mixed(out * _STEP + h[k:k + n])
    return np.unique(out)


def minima(sets: np.ndarray, hashes: int = _HASHES) -> np.ndarray:
    low = np.full(hashes, 0xFFFFFFFF, np.uint32)
    short = (sets >> np.uint64(32)).astype(np.uint32)
    for s in range(0, len(short), _BLOCK):
        low = np.minimum(low, (short[s:s + _BLOCK, None] * _A[:hashes] + _B[:hashes]).min(axis=0))
    return low


def packed(mins: np.ndarray) -> np.ndarray:
    """The low bits of each row's minima, side by side in longs."""
    rows, hashes = mins.shape
    folded = mins ^ (mins >> np.uint32(16))
    bits = np.zeros((rows, longs(hashes) * 64 // LOW_BITS, LOW_BITS), np.uint8)
    for b in range(LOW_BITS):
        bits[:, :hashes, b] = (folded >> np.uint32(b)) & np.uint32(1)
    return np.packbits(bits.reshape(rows, -1), axis=1).view(np.int64)


def longs(hashes: int) -> int:
    return -(-hashes * LOW_BITS // 64)


def _set_id(own: np.ndarray) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_lo, set_hi, sig, bands); sig and bands are null for empty sets."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_shingles", T.LongType()),
        T.StructField("set_lo", T.LongType()), T.StructField("set_hi", T.LongType()),
        T.StructField("sig", T.ArrayType(T.LongType())), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_in_worker("minhash")
        hashes = _WordHash()
        for pdf in batches:
            sizes, ids, low = [], [], []
            for text in pdf["text"]:
                own = shingles(text, hashes)
                sizes.append(len(own))
                ids.append(_set_id(own))
                low.append(minima(own))
            mins = np.array(low, np.uint32).reshape(-1, _HASHES)
            sig = packed(mins)
            key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(mins), BANDS))
            for r in range(ROWS):
                key = _mixed(key * _STEP + mins.reshape(-1, BANDS, ROWS)[:, :, r].astype(np.uint64))
            key = np.ascontiguousarray(key).view(np.int64)
            some = np.array(sizes, np.int64) > 0
            ids = np.array(ids, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_shingles": sizes, "set_lo": ids[:, 0], "set_hi": ids[:, 1],
                                "sig": [s if ok else None for s, ok in zip(sig, some, strict=True)],
                                "bands": [k if ok else None for k, ok in zip(key, some, strict=True)]})

    return map_frames(docs.select("doc_id", "text"), run, schema, SLICE_BYTES)


def estimate(a: Column, b: Column, hashes: int = _HASHES) -> Column:
    """Similarity estimated from packed low bits, corrected for chance agreement."""
    differing = sum((F.bit_count(_either_bit(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))))
                     for k in range(longs(hashes))), F.lit(0))
    chance = 0.5 ** LOW_BITS
    return ((F.lit(hashes) - differing) / F.lit(float(hashes)) - F.lit(chance)) / F.lit(1 - chance)


def _either_bit(x: Column) -> Column:
    """One bit for each pair of bits that are not both equal."""
    return x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))


def likely(percent: int = PERCENT, hashes: int = _HASHES) -> float:
    """The estimate below which a pair is given up: threshold less SLACK standard errors."""
    chance = 0.5 ** LOW_BITS
    p = chance + (1 - chance) * percent / 100
    return percent / 100 - SLACK * (p * (1 - p) / hashes) ** 0.5 / (1 - chance)


def _short(band: Column) -> Column:
    """A band key's low bits, for telling one row's bands apart."""
    return band.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def _near_in_size(percent: int) -> Column:
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the similarity."""
    side = classes.select("rep", "n_shingles", "sig")
    joined = (pairs.join(side.toDF("a", "n_a", "sig_a"), "a").join(side.toDF("b", "n_b", "sig_b"), "b"))
    return joined.where(_near_in_size(percent) & (estimate(F.col("sig_a"), F.col("sig_b")) >= likely(percent))).select("a", "b")


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that reach the similarity on their full sets, stored."""
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    sets = stored(_of_classes(docs, classes, wanted), "sets")
    joined = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    both = F.size(F.array_intersect("x", "y"))
    links = stored(joined.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b"), "links")
    discard(pairs, sets)
    return links


def _full_sets(docs: DataFrame, wide: bool = False) -> DataFrame:
    """(doc_id, set_lo, set_hi, shingles), or the longer signature in place of the shingles."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("set_lo", T.LongType()), T.StructField("set_hi", T.LongType()),
                           T.StructField("shingles", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHash()
        for pdf in batches:
            sets = [shingles(t, hashes) for t in pdf["text"]]
            ids = np.array([_set_id(x) for x in sets], np.int64).reshape(-1, 2)
            values = list(packed(np.array([minima(x, WIDE) for x in sets]))) if wide else [x.view(np.int64) for x in sets]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "set_lo": ids[:, 0], "set_hi": ids[:, 1],
                                "shingles": pd.Series(values, dtype=object)})

    return map_frames(docs.select("doc_id", "text"), run, schema, SLICE_BYTES)


def _of_classes(docs: DataFrame, classes: DataFrame, wanted: DataFrame, wide: bool = False) -> DataFrame:
    """(rep, shingles) of the ``wanted`` classes (rep), from the texts."""
    chosen = classes.join(wanted, "rep", "left_semi").select(F.col("rep").alias("doc_id"), "set_lo", "set_hi")
    texts = docs.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    return (_full_sets(texts, wide).join(chosen, ["doc_id", "set_lo", "set_hi"], "left_semi")
            .dropDuplicates(["doc_id", "set_lo", "set_hi"]).select(F.col("doc_id").alias("rep"), "shingles"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    whole = stored(signatures(docs), "signatures")
    # The classes hold signatures and bands; of all rows only size and set are needed on.
    marks = stored(whole.select("doc_id", "n_shingles", "set_lo", "set_hi"), "marks")
    named = marks.where("n_shingles > 0 and doc_id is not null")
    rep = named.groupBy("set_lo", "set_hi").agg(F.min("doc_id").alias("rep"))
    first = F.col("doc_id") == F.col("rep")
    classes = stored(whole.where("n_shingles > 0 and doc_id is not null").join(rep, ["set_lo", "set_hi"]).where(first).dropDuplicates(["set_lo", "set_hi"])
                     .select("rep", "n_shingles", "set_lo", "set_hi", "sig", "bands"), "classes")
    discard(whole)

    buckets = classes.select("rep", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head < last")
    shared = stored(buckets.join(heads.select("band", "head"), "band"), "buckets")
    stars = _promising(shared.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(),
                       classes, percent)
    links = _confirmed(stars, docs, classes, percent)
    # A doc_id whose rows differ in text lies in several classes: one document all the same.
    held = named.select("doc_id", "set_lo", "set_hi").join(rep, ["set_lo", "set_hi"]).select("doc_id", "rep")
    repeated = held.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last")
    one = held.join(repeated, "doc_id").select("a", F.col("rep").alias("b")).where("a < b").distinct()
    of = components(links, "a", "b")

    grouped = shared.join(of.toDF("rep", "part"), "rep", "left").join(of.toDF("head", "main"), "head", "left").select(
        "band", "rep", F.coalesce("part", "rep").alias("part"), "head", F.coalesce("main", "head").alias("main"))
    grouped = stored(grouped, "grouped")
    discard(shared)
    mixed = stored(grouped.join(grouped.where("part <> main").select("band").distinct(), "band", "left_semi"), "mixed")
    discard(grouped)
    wide = stored(_of_classes(docs, classes, mixed.select("rep").distinct(), wide=True).toDF("rep", "wide"), "wide")
    marked = mixed.join(classes.select("rep", "n_shingles", F.transform("bands", _short).alias("bands")),
                        "rep").join(wide, "rep")
    apart = marked.where("part <> main").select("band", F.col("rep").alias("b"), F.col("part").alias("part_b"),
                                                F.col("n_shingles").alias("n_b"), F.col("bands").alias("bands_b"),
                                                F.col("wide").alias("wide_b"))
    rest = marked.where("rep <> head").select("band", F.col("rep").alias("a"), F.col("part").alias("part_a"), "main",
                                              F.col("n_shingles").alias("n_a"), F.col("bands").alias("bands_a"),
                                              F.col("wide").alias("wide_a"))
    undecided = F.expr("part_a <> part_b and (part_a = main or a < b)") & _near_in_size(percent)
    near = estimate(F.col("wide_a"), F.col("wide_b"), WIDE) >= likely(percent, WIDE)
    # The first of the bands that both share gives the pair; the others would only repeat it.
    first = F.get("bands_a", F.array_position(F.zip_with("bands_a", "bands_b", lambda x, y: x == y), True).cast("int") - 1)
    others = (apart.join(rest, "band").where(undecided & near & (first == _short(F.col("band"))))
              .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    more = _confirmed(others, docs, classes, percent)
    of = components(links.unionByName(more).unionByName(one), "a", "b")
    discard(classes, mixed, wide, links, more)
    return made_from(_labelled(marks, of, rep), marks)


def _labelled(marks: DataFrame, of: DataFrame, rep: DataFrame) -> DataFrame:
    """Each row with the component of its document."""
    found = (marks.select("doc_id", "n_shingles", "set_lo", "set_hi")
             .join(rep, ["set_lo", "set_hi"], "left")
             .withColumn("rep", F.when(F.col("n_shingles") > 0, F.col("rep")))
             .join(of.toDF("rep", "component"), "rep", "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
