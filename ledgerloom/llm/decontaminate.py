"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z only) and split into words of digits, a-z and
characters beyond ASCII.  The patterns are the windows of ``WINDOW`` consecutive
words of every benchmark item; an item with fewer words, but not none, is one
pattern.  Patterns of one length m are searched together:

- A block is the last few words of a window; blocks are long enough that a
  chance block is seldom one of a pattern (one, two or three words).
- The shift table holds, for every block of the patterns, how far its last
  place is from a pattern's end.  A block that is in no pattern lets the
  search go on by m - block + 1 words.
- Where the shift is 0, the block's bucket gives the patterns that end with it,
  and a pattern's words are compared with the text's.

Benchmark items are cut into segments with overlapping ends, and segments are
gathered into blocks of at most ``BLOCK_BYTES`` (or one segment), in order of
item.  Every block is broadcast and searched in all documents; the benchmark
may grow, a broadcast does not.  With one block, documents are answered in one
pass.  With more, hits are kept per different text and joined back.

Null texts have no words; an item without words has no pattern.  A null
``item_id`` is read as the empty string, and rows that repeat an item_id are one
item.  Repeated documents are answered row by row.  Without patterns nothing is
hit; an empty table of documents gives an empty result.  Only the columns named
in ``keep`` are carried along.  Very long texts are searched whole.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.common import discard, slices, stored

WINDOW = 10
#: Windows that begin in one segment of an item, and about the bytes of a segment.
SEGMENT, SEGMENT_BYTES = 2048, 1 << 20
#: Bytes of segments that are broadcast at once.
BLOCK_BYTES = 4 << 20

#: A-Z to a-z; every other ASCII character that is no digit or letter to a space.
_PLAIN = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32) for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text."""
    return text.translate(_PLAIN).split()


class WuManber:
    """Patterns of one length; ``search`` yields (start, pattern number) of all occurrences."""

    def __init__(self, patterns: dict[tuple[bytes, ...], int]):
        self.m = m = len(next(iter(patterns)))
        kinds = len({w for p in patterns for w in p})
        # Wu and Manber: blocks of about log(2 m r) to the base of the alphabet.
        size = math.ceil(math.log(2 * m * len(patterns)) / math.log(max(2, kinds)))
        self.block = b = min(max(1, size), 3, m)
        self.far = m - b + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for pattern, number in patterns.items():
            for end in range(b, m + 1):
                key = pattern[end - b:end]
                if m - end < self.shift.get(key, self.far):
                    self.shift[key] = m - end
            self.buckets.setdefault(pattern[m - b:], {})[pattern] = number

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        m, b, far, shift, buckets = self.m, self.block, self.far, self.shift, self.buckets
        end, n = m, len(words)
        while end <= n:
            key = tuple(words[end - b:end])
            step = shift.get(key, far)
            if step:
                end += step
                continue
            number = buckets[key].get(tuple(words[end - m:end]))
            if number is not None:
                yield end - m, number
            end += 1


class Patterns:
    """All windows of some segments: (item, first word, words that follow the first ``WINDOW`` - 1 ...)."""

    def __init__(self, segments: Sequence[tuple[str, list[bytes]]]):
        self.items: list[set[str]] = []
        by_length: dict[int, dict[tuple[bytes, ...], int]] = {}
        for item, words in segments:
            m = min(WINDOW, len(words))
            own = by_length.setdefault(m, {})
            for k in range(len(words) - m + 1):
                number = own.setdefault(tuple(words[k:k + m]), len(self.items))
                if number == len(self.items):
                    self.items.append(set())
                self.items[number].add(item)
        self.searches = [WuManber(p) for m, p in sorted(by_length.items())]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Merged (start, length) of what is hit, and the items with occurring windows, sorted."""
        spans, numbers = [], set()
        for search in self.searches:
            for start, number in search.search(words):
                spans.append((start, start + search.m))
                numbers.add(number)
        if not spans:
            return [], []
        spans.sort()
        merged = [list(spans[0])]
        for start, end in spans[1:]:
            if start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        return [(s, e - s) for s, e in merged], sorted(set().union(*(self.items[k] for k in numbers)))


def segments(benchmark: DataFrame) -> DataFrame:
    """(item, start, words, cost): items cut so that every window begins in one segment and lies in it."""
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("start", T.LongType()),
                           T.StructField("words", T.BinaryType()), T.StructField("cost", T.LongType())])

    def cut(words: list[bytes]) -> Iterator[tuple[int, bytes]]:
        start = 0
        while True:
            end, held = start, 0
            while end < len(words) and end - start < SEGMENT and held < SEGMENT_BYTES:
                held += len(words[end]) + 1
                end += 1
            if end + WINDOW - 1 >= len(words):
                yield start, b" ".join(words[start:])
                return
            yield start, b" ".join(words[start:end + WINDOW - 1])
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    words = words_of(text)
                    if words:
                        rows += [(item, start, own, len(own) + 64) for start, own in cut(words)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type)
                                                  for k, f in enumerate(to_arrow_schema(schema))], schema=to_arrow_schema(schema))

    source = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                              F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return source.mapInArrow(run, schema).distinct()


def blocked(parts: DataFrame, limit: int) -> DataFrame:
    """Segments with ``block``: runs in order of (item, start) that cost at most ``limit``, or hold one segment."""
    ranged = stored(parts.repartitionByRange("item", "start", "words").withColumn("part", F.spark_partition_id()), "segments")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    base = ranged.groupBy("part").agg(F.sum("cost").alias("held")).select(
        "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("item", "start", "words").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("cost").over(within), F.lit(0)) + F.col("base")
    return ranged.join(base, "part").withColumn("block", F.floor(at / limit)).drop("part", "base")


#: Numbers of the driver's broadcasts.
_numbers = itertools.count()
#: The patterns that a Python worker built last, by broadcast number.
_built: dict[int, Patterns] = {}


def patterns_of(number: int, shared: Broadcast) -> Patterns:
    """The patterns of a broadcast block, built once in a worker."""
    if number not in _built:
        _built.clear()
        _built[number] = Patterns([(item, words.split()) for item, words in shared.value])
    return _built[number]

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])


def search(texts: DataFrame, block: list[tuple[str, bytes]], only_hit: bool = False) -> DataFrame:
    """The columns of ``texts`` but its last, the text as binary, and n_words, spans, items found of one block."""
    shared = texts.sparkSession.sparkContext.broadcast(block)
    number = next(_numbers)
    new = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN)),
                        T.StructField("items", T.ArrayType(T.StringType()))])
    schema = T.StructType([*texts.schema.fields[:-1], *new.fields])
    target, kinds = to_arrow_schema(schema), to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = patterns_of(number, shared)
        for whole in batches:
            for batch in slices(whole):
                rows, places = [], []
                for k, text in enumerate(batch.column(batch.num_columns - 1)):
                    words = words_of(text.as_py())
                    spans, items = patterns.find(words)
                    if spans or not only_hit:
                        rows.append((len(words), [{"start": s, "length": n} for s, n in spans], items))
                        places.append(k)
                made = [pa.array([r[j] for r in rows], f.type) for j, f in enumerate(kinds)]
                kept = batch.columns[:-1] if not only_hit else [c.take(pa.array(places, pa.int64())) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, *made], schema=target)

    return texts.mapInArrow(run, schema)


def _union(spans: F.Column) -> F.Column:
    """Spans of several blocks as merged spans."""
    end = lambda s: s["start"] + s["length"]
    wide = lambda a, x: F.struct(a["start"].alias("start"), (F.greatest(end(a), end(x)) - a["start"]).alias("length"))
    state = F.struct(F.expr("array()").cast(T.ArrayType(_SPAN)).alias("done"), F.lit(None).cast(_SPAN).alias("open"))

    def step(acc, x):
        opened, done = acc["open"], acc["done"]
        return (F.when(opened.isNull(), F.struct(done.alias("done"), x.alias("open")))
                .when(x["start"] <= end(opened), F.struct(done.alias("done"), wide(opened, x).alias("open")))
                .otherwise(F.struct(F.concat(done, F.array(opened)).alias("done"), x.alias("open"))))

    return F.aggregate(F.array_sort(spans), state, step,
                       lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def contamination(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",),
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` and n_words, spans (array of start, length in words) and items (sorted) of every document."""
    source = docs.select(*keep, F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    parts = stored(segments(benchmark), "segments")
    whole = parts.agg(F.sum("cost")).first()[0] or 0
    if whole <= block_bytes:
        return search(source, [(r.item, bytes(r.words)) for r in parts.collect()])
    numbered = stored(blocked(parts, block_bytes), "blocks")
    keyed = source.select("text").select(F.sha2("text", 256).alias("digest"), "text")
    found = []
    for row in numbered.select("block").distinct().orderBy("block").toLocalIterator():
        block = [(r.item, bytes(r.words)) for r in numbered.where(F.col("block") == row.block).collect()]
        hits = search(keyed, block, only_hit=True).dropDuplicates(["digest"]).withColumn("block", F.lit(row.block))
        found.append(stored(hits, "hits"))
    hits = functools.reduce(DataFrame.unionByName, found).groupBy("digest").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    # One row per different text with a hit, of as many parts as there are blocks.
    hits = stored(hits.select("digest", _union(F.col("spans")).alias("spans"),
                              F.array_sort(F.array_distinct("items")).alias("items")), "hits")
    discard(parts, numbered, *found)
    base = search(source.select(*keep, F.sha2("text", 256).alias("digest"), "text"), [])
    none = lambda kind: F.expr("array()").cast(kind)
    joined = base.select(*keep, "n_words", "digest").join(hits, "digest", "left")
    return joined.select(*keep, "n_words", F.coalesce("spans", none(T.ArrayType(_SPAN))).alias("spans"),
                         F.coalesce("items", none(T.ArrayType(T.StringType()))).alias("items"))
