"""Toxicity by two Kneser-Ney language models that share their backoff counts.

A model gives every character of a word a probability after the five before
it.  The counts of six-character expressions are kept for toxic and for
ordinary texts apart; below them lie shared backoff counts of both classes
together: the pooled counts of the six characters, and continuation counts (in
how many different expressions does this one occur?) of all shorter ones.  An
expression that one class has rarely seen therefore falls back on what both
share, where it speaks for neither; ``BACKOFF`` says how many occurrences of a
context that belief is worth.

A text's evidence is the difference of its log-likelihoods under the two
models, divided by its number of words, and the part of that difference that
comes from words speaking clearly for toxicity.  A logistic curve turns both
into a score.  It is fitted on training texts (a bounded number of each class,
weighted to stand for all), each weighed by the counts of all texts but itself.

All counts are exact tables keyed by expressions and contexts, which grow with
the corpus; none is gathered on the driver or sent to all executors.  Every
different expression of the documents is looked up once, by joins.  Its value
then goes back to blocks of different words, which are neighbours in sorted order
(a block's expressions are made different first, and neighbours share most of
them), and the words' evidence to blocks of documents: only a block's different
words are sent out, with their places, and only their values back, and they are
added up where the block's numbered words are.

Labels enter only for rows whose crc32(doc_id as text) modulo 5 is not 0;
neither labels nor lang, source or doc_id are inputs of a score.  Null and
empty texts have no evidence and score the curve's value at 0.  If a class has
no training row, nothing tells the classes apart: all texts score 0, so none is
predicted to be toxic.  Of several labels of one doc_id the larger toxic
value counts; null labels are ignored.  A score depends on the row's own text
alone, so rows with equal texts score alike; extra columns are not read.
"""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.common import SLICE_BYTES, discard, discard_part, give_back, giving_back, keep_in_worker, made_from, map_frames, slices, stored

ORDER = 6
FOLDS = 5
#: Occurrences of a context that the shared counts are worth.
BACKOFF = 40.0
#: Evidence beyond which a word speaks clearly.
CLEAR = 2.5
#: Training texts of each class on which the logistic curve is fitted, at most.
CURVE_ROWS = 4000
#: Width and largest value of the bins of evidence from which the logistic curve is fitted.
BIN_WIDTH, BIN_LIMIT = 0.02, 3.0
#: A block ends with the slice or row that brings it to so many documents, words, different words (or rows) or expressions.
BLOCK_DOCS, BLOCK_WORDS, BLOCK_KINDS, BLOCK_GRAMS = 1 << 16, 1 << 22, 1 << 18, 1 << 17
_PAD, _END = "\x02", "\x03"
#: Counts of an expression and its context by class (toxic, ordinary); different characters after the context, last of both.
_COUNTS = ("a", "b", "total_a", "total_b", "kinds_a", "kinds_b", "kinds")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def expressions_of(word: str) -> list[str]:
    padded = f"{_PAD * (ORDER - 1)}{word}{_END}"
    return [padded[k:k + ORDER] for k in range(len(word) + 1)]


def _share(count: np.ndarray, total: np.ndarray, kinds: np.ndarray, d: float, below: np.ndarray, worth: float) -> np.ndarray:
    """Interpolated probability; ``worth`` occurrences of the context follow the counts below."""
    held = total + worth
    with np.errstate(divide="ignore", invalid="ignore"):
        p = (np.maximum(count - d, 0) + (np.minimum(d * kinds, total) + worth) * below) / held
    return np.where(held > 0, np.minimum(p, 1), below)


def _shared(count: Column, total: Column, kinds: Column, d: float, below: Column, worth: float = 0.0) -> Column:
    """``_share`` as an expression."""
    p = (F.greatest(count - d, F.lit(0.0)) + (F.least(d * kinds, total) + worth) * below) / (total + worth)
    return F.when(total + worth > 0, F.least(p, F.lit(1.0))).otherwise(below)


def _word_counts(labelled: DataFrame) -> DataFrame:
    """(word, toxic, ordinary): occurrences in training texts of either class."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_in_worker("toxicity")
        counts = (Counter(), Counter())

        def out() -> pd.DataFrame:
            names = [*counts[1].keys() | counts[0].keys()]
            return pd.DataFrame({"word": pd.Series(names, dtype=object), "toxic": [counts[1][w] for w in names],
                                 "ordinary": [counts[0][w] for w in names]})

        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                counts[int(toxic)].update(words_of(text))
                if len(counts[0]) + len(counts[1]) > 300_000:
                    yield out()
                    counts = (Counter(), Counter())
        yield out()

    parts = map_frames(labelled, run, "word string, toxic long, ordinary long", SLICE_BYTES)
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _expressions(words: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary): the expressions of ORDER characters and their counts."""
    padded = F.concat(F.lit(_PAD * (ORDER - 1)), "word", F.lit(_END))
    grams = F.transform(F.sequence(F.lit(1), F.char_length("word") + 1),
                        lambda i: F.substring(F.col("padded"), i, F.lit(ORDER)))
    return (words.withColumn("padded", padded).select(F.explode(grams).alias("gram"), "toxic", "ordinary")
            .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


class Model:
    """Exact counts of (text, toxic) rows, as tables."""

    def __init__(self, labelled: DataFrame):
        counted = _expressions(_word_counts(labelled))
        self.top = top = stored(counted, "expressions")
        exactly = lambda c, k: F.count_if(F.col(c) == k).alias(f"{c}{k}")
        counts = top.agg(*(exactly(c, k) for c in ("toxic", "ordinary") for k in (1, 2)),
                         F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).first()
        self.complete = bool(counts["toxic"] and counts["ordinary"])
        if not self.complete:
            return
        # Continuation counts: the different expressions, one longer, that end in this one.
        self.lower, longer = {}, top
        for order in range(ORDER - 1, 0, -1):
            longer = stored(longer.select(F.substring("gram", 2, order).alias("gram")).groupBy("gram")
                            .agg(F.count("*").alias("n")), "continuations")
            self.lower[order] = longer
        below = functools.reduce(DataFrame.unionByName, [x.select("n") for x in self.lower.values()]).agg(
            exactly("n", 1), exactly("n", 2)).first()
        # The usual estimate of the discount from the expressions seen once and twice.
        discount = lambda one, two: one / (one + 2 * two) if one and two else 0.5
        self.discounts = (discount(counts["toxic1"], counts["toxic2"]), discount(counts["ordinary1"], counts["ordinary2"]),
                          discount(below["n1"], below["n2"]))

    def discard(self) -> None:
        discard(self.top, *(self.lower.values() if self.complete else ()))

    def _backoff(self, grams: DataFrame) -> DataFrame:
        """(gram, p): shared probability of the expressions of fewer than ORDER characters that end ``grams``."""
        found, d = None, self.discounts[2]
        for order in range(1, ORDER):
            wanted = grams.select(F.substring("gram", ORDER - order + 1, order).alias("gram")).distinct()
            counts = self.lower[order]
            contexts = counts.groupBy(F.substring("gram", 1, order - 1).alias("context")).agg(
                F.sum("n").cast("double").alias("total"), F.count("*").cast("double").alias("kinds"))
            rows = (wanted.join(counts, "gram", "left").withColumn("context", F.substring("gram", 1, order - 1))
                    .join(contexts, "context", "left"))
            if found is None:
                below = F.lit(1 / 256.0)
            else:
                rows, below = rows.withColumn("end", F.substring("gram", 2, order - 1)).join(found, "end"), F.col("below")
            none = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            p = _shared(none("n"), none("total"), none("kinds"), d, below)
            found = rows.select(F.col("gram").alias("end"), p.alias("below"))
        return found

    def values(self, grams: DataFrame) -> DataFrame:
        """``grams`` with their counts, the shared probability ``below`` them and ``value``, their evidence.

        At most one expression for each character stands for a context or an
        end, so no key of these joins is frequent.
        """
        top = self.top.select("gram", F.col("toxic").alias("a"), F.col("ordinary").alias("b"))
        some = lambda c: F.count_if(F.col(c) > 0)
        contexts = top.groupBy(F.substring("gram", 1, ORDER - 1).alias("context")).agg(
            F.sum("a").alias("total_a"), F.sum("b").alias("total_b"), some("a").alias("kinds_a"), some("b").alias("kinds_b"),
            F.count("*").alias("kinds"))
        rows = (grams.join(top, "gram", "left")
                .withColumns({"context": F.substring("gram", 1, ORDER - 1), "end": F.substring("gram", 2, ORDER - 1)})
                .join(contexts, "context", "left").join(self._backoff(grams), "end"))
        rows = rows.select("gram", *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in _COUNTS), "below")
        c = {k: F.col(k) for k in (*_COUNTS, "below")}
        rows = rows.withColumn("shared", _shared(c["a"] + c["b"], c["total_a"] + c["total_b"], c["kinds"], self.discounts[2], c["below"]))
        logs = [F.log(_shared(c[x], c[f"total_{x}"], c[f"kinds_{x}"], self.discounts[k], F.col("shared"), BACKOFF))
                for k, x in enumerate("ab")]
        return rows.withColumn("value", logs[0] - logs[1]).drop("shared")


def _told(values: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Evidence per word of a text, and the part of it beyond CLEAR, from its distinct words."""
    n = max(1, times.sum())
    return float((values * times).sum() / n), float((np.maximum(values - CLEAR, 0) * times).sum() / n)


#: Bits of a place that hold a word's number in its block, and of a block that hold its number in its task.
PLACE_BITS, TASK_BITS = 22, 16
#: Places of a word are gathered from so many tasks (as a power of two) at most.
GROUP_BITS = 10


def _block_ids() -> Iterator[int]:
    at = TaskContext.get().partitionId() << TASK_BITS
    while True:
        yield at
        at += 1


def _short(numbers: np.ndarray) -> bytes:
    """Small numbers in as few bytes each as the largest needs, after that width."""
    width = 1 if (top := int(numbers.max(initial=0))) < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def _long(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _compressed(rows: pa.RecordBatch) -> bytes:
    """Rows as one compressed value, which travels as a whole."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _with_expressions(rows: DataFrame) -> DataFrame:
    """(block, gram, rows): ``rows`` of text and more in blocks of neighbours, and each block's different expressions.

    A row holds one expression or, compressed, some of the rows.  To be stored
    before it is read twice: a block is numbered by the task that makes it.
    """
    schema = "block long, gram string, rows binary"
    target = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_in_worker("toxicity")
        ids = _block_ids()
        block, grams, held = next(ids), set(), 0

        def expressions() -> pa.RecordBatch:
            n = len(grams)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array([*grams], pa.string()), pa.nulls(n, pa.binary())],
                                              schema=target)

        for whole in batches:
            for batch in slices(whole):
                first, texts = 0, batch.column("text").to_pylist()
                for k, text in enumerate(texts):
                    held += 1
                    for word in {*words_of(text)}:
                        grams.update(expressions_of(word))
                    full = len(grams) >= BLOCK_GRAMS or held >= BLOCK_KINDS
                    if full or k + 1 == len(texts):
                        part = _compressed(batch.slice(first, k + 1 - first))
                        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.nulls(1, pa.string()),
                                                          pa.array([part], pa.binary())], schema=target)
                        first = k + 1
                    if full:
                        yield expressions()
                        block, grams, held = next(ids), set(), 0
        if held:
            yield expressions()

    return rows.mapInArrow(giving_back(run), schema)


def _of_blocks(blocks: DataFrame, values: DataFrame, columns: tuple[str, ...], run, schema: str) -> DataFrame:
    """``run(rows, grams, numbers)`` for every block of ``_with_expressions``; numbers are the ``columns`` of its grams."""
    target = to_arrow_schema(T.StructType.fromDDL(schema))

    def answers(block: pa.Table) -> pa.Table:
        is_rows = block["gram"].is_null()
        own = block.filter(pa.compute.invert(is_rows))
        rows = pa.concat_tables([pa.ipc.open_stream(part.as_py()).read_all() for part in block.filter(is_rows)["rows"]])
        numbers = np.array([own[c].to_numpy() for c in columns])
        return pa.Table.from_pydict(run(rows, own["gram"].to_pylist(), numbers), target)

    def of(block: pa.Table) -> pa.Table:
        out = answers(block)
        give_back()
        return out

    grams = blocks.where("gram is not null").select("block", "gram").join(values.select("gram", *columns), "gram")
    grams = grams.select("block", "gram", F.lit(None).cast("binary").alias("rows"), *columns)
    rows = blocks.where("gram is null").select("*", *(F.lit(None).cast("double").alias(c) for c in columns))
    return grams.unionByName(rows).groupBy("block").applyInArrow(of, schema)


def word_evidence(blocks: DataFrame, values: DataFrame) -> DataFrame:
    """(places, value): log P(word | toxic) - log P(word | ordinary) of each word of ``blocks``, and where it stands."""
    def run(rows: pa.Table, grams: list[str], numbers: np.ndarray) -> dict:
        value = dict(zip(grams, numbers[0].tolist(), strict=True))
        told = [sum(map(value.__getitem__, expressions_of(w))) for w in rows["text"].to_pylist()]
        return {"places": rows["places"], "value": told}

    return _of_blocks(blocks, values, ("value",), run, "places array<long>, value double")


def evidence_without_own(blocks: DataFrame, values: DataFrame, discounts: tuple[float, float, float]) -> DataFrame:
    """(toxic, evidence, clear) of the training texts of ``blocks``, each by the counts of all the others."""
    def run(rows: pa.Table, grams: list[str], numbers: np.ndarray) -> dict:
        texts, toxic = rows["text"].to_pylist(), rows["toxic"].to_pylist()
        index = {g: k for k, g in enumerate(grams)}
        _, context_of = np.unique(np.array([g[:-1] for g in grams], dtype=object), return_inverse=True)
        told = []
        for text, label in zip(texts, toxic, strict=True):
            words = Counter(words_of(text))
            if not words:
                told.append((0.0, 0.0))
                continue
            times = np.array([*words.values()], float)
            own = [expressions_of(w) for w in words]
            sizes = np.array([len(x) for x in own])
            gram, at = np.unique(np.array([index[g] for x in own for g in x]), return_inverse=True)
            uses = np.bincount(at, np.repeat(times, sizes))
            count, total, kinds, both, below = (x.copy() for x in (
                numbers[0:2, gram], numbers[2:4, gram], numbers[4:6, gram], numbers[6, gram], numbers[7, gram]))
            # The text's own occurrences are taken out of the counts of its class.
            row = 1 - label
            _, context = np.unique(context_of[gram], return_inverse=True)
            only = count[row] <= uses
            total[row] -= np.bincount(context, uses)[context]
            kinds[row] -= np.bincount(context, only)[context]
            both -= np.bincount(context, only & (count[1 - row] <= 0))[context]
            count[row] -= uses
            shared = _share(count.sum(0), total.sum(0), both, discounts[2], below, 0)
            logs = [np.log(_share(count[c], total[c], kinds[c], discounts[c], shared, BACKOFF)) for c in (0, 1)]
            told.append(_told(np.add.reduceat((logs[0] - logs[1])[at], np.cumsum(sizes) - sizes), times))
        return {"toxic": toxic, "evidence": [e for e, _ in told], "clear": [c for _, c in told]}

    return _of_blocks(blocks, values, (*_COUNTS, "below"), run, "toxic int, evidence double, clear double")


def _numbers() -> defaultdict[str, int]:
    """Numbers words from 0 on, in the order in which they are first asked for."""
    index = defaultdict(int)
    index.default_factory = index.__len__
    return index


def _words_in_blocks(docs: DataFrame) -> DataFrame:
    """(place, word, words, times, keys..., part): documents in blocks, whose words are numbered.

    A row of part ``word`` is a word; ``place`` holds the block and the word's
    number in it.  A row of part ``document`` is a document: its block, the
    numbers of its different words (ascending, as differences), how often it
    holds each, and the other columns of ``docs``.
    """
    keys = [f for f in docs.schema if f.name != "text"]
    fields = T.StructType([T.StructField("place", T.LongType()),
                           T.StructField("word", T.StringType()), T.StructField("words", T.BinaryType()),
                           T.StructField("times", T.BinaryType()), *keys,
                           T.StructField("part", T.StringType())])
    target = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_in_worker("toxicity")
        ids = _block_ids()
        block, index, docs_held, held = next(ids), _numbers(), 0, 0

        def numbered() -> Iterator[pa.RecordBatch]:
            names = [*index]
            for lo in range(0, len(names), 50_000):
                part = names[lo:lo + 50_000]
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((block << PLACE_BITS) + np.arange(lo, lo + n)), pa.array(part, pa.string()),
                     *(pa.nulls(n, target.field(c).type) for c in ("words", "times", *(f.name for f in keys))),
                     pa.array(["word"] * n)], schema=target)

        for whole in batches:
            for batch in slices(whole):
                lists, times = [], []
                for text in batch.column("text"):
                    own = words_of(text.as_py())
                    at = np.fromiter(map(index.__getitem__, own), np.int32, len(own))
                    kinds, n = np.unique(at, return_counts=True)
                    lists.append(_short(np.diff(kinds, prepend=np.int32(0))))
                    times.append(_short(n))
                    held += len(own)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block << PLACE_BITS)), pa.nulls(n, pa.string()), pa.array(lists, pa.binary()),
                     pa.array(times, pa.binary()), *(batch.column(f.name).cast(target.field(f.name).type) for f in keys),
                     pa.array(["document"] * n)], schema=target)
                docs_held += n
                if docs_held >= BLOCK_DOCS or held >= BLOCK_WORDS or len(index) >= BLOCK_KINDS:
                    yield from numbered()
                    block, index, docs_held, held = next(ids), _numbers(), 0, 0
        yield from numbered()

    return docs.mapInArrow(giving_back(run), fields)


def evidence(found: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, evidence, clear): difference of log-likelihoods per word of the whole text, and its clear part.

    ``found`` is of ``_words_in_blocks``, ``words`` of ``word_evidence``.  The
    values of a block's different words go back to it, and the sums are taken there.
    """
    block = F.shiftright("place", PLACE_BITS)
    values = (words.select(F.explode("places").alias("place"), "value")
              .select(block.alias("of_block"), F.col("place").bitwiseAND((1 << PLACE_BITS) - 1).cast("int").alias("number"), "value"))
    docs = found.where("part = 'document'").select(block.alias("block"), "words", "times", *keys)
    fields = T.StructType([*(found.schema[k] for k in keys), T.StructField("evidence", T.DoubleType()),
                           T.StructField("clear", T.DoubleType())])
    target = to_arrow_schema(fields)

    def answers(own: pa.Table, block: pa.Table) -> pa.Table:
        value = np.zeros(own.num_rows)
        value[own["number"].to_numpy()] = own["value"].to_numpy()
        told = [_told(value[np.cumsum(_long(w.as_py()))], _long(n.as_py()))
                for w, n in zip(block["words"], block["times"], strict=True)]
        return pa.Table.from_arrays([*(block[k].cast(target.field(k).type) for k in keys),
                                     *(pa.array([t[j] for t in told], pa.float64()) for j in (0, 1))], schema=target)

    def of(own: pa.Table, block: pa.Table) -> pa.Table:
        out = answers(own, block)
        give_back()
        return out

    return values.groupBy("of_block").cogroup(docs.groupBy("block")).applyInArrow(of, fields)


def fit_curve(bins: list[tuple[float, float, int, float]]) -> tuple[float, float, float]:
    """Weights of evidence and clear evidence and the constant, over (evidence, clear, label, count) bins."""
    x, z, y, n = (np.array(c, float) for c in zip(*bins, strict=True))
    design = np.stack([x, z, np.ones_like(x)])
    at = np.zeros(3)
    for _ in range(100):                            # Newton's steps, with a faint pull to 0
        p = 1 / (1 + np.exp(-np.clip(at @ design, -30, 30)))
        slope = design @ (n * (y - p)) - 1e-2 * at
        curve = (design * (n * p * (1 - p))) @ design.T + 1e-2 * np.eye(3)
        step = np.linalg.solve(curve, slope)
        step *= min(1, 10 / np.abs(step).max())
        at = at + step
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1]), float(at[2])


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows that may be learned from."""
    return (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def _binned(c: str) -> Column:
    bound = F.least(F.greatest(F.col(c), F.lit(-BIN_LIMIT)), F.lit(BIN_LIMIT))
    return (F.round(bound / BIN_WIDTH) * BIN_WIDTH).alias(c)


def scores(docs: DataFrame, labels: DataFrame, *keys: str) -> DataFrame:
    """(doc_id, keys, held_out, score, predicted), a row for each row of ``docs``; ``keys`` are more of its columns."""
    docs = docs.select("doc_id", *keys, "text")
    chosen = training_labels(labels.select("doc_id", "toxic"))
    texts = stored(docs.join(chosen, "doc_id").select("doc_id", "text", "toxic"), "training")
    model = Model(texts)
    if not model.complete:
        return made_from(docs.select("doc_id", *keys, held_out(F.col("doc_id")).alias("held_out"), F.lit(0.0).alias("score"),
                                     F.lit(0).alias("predicted")))
    # The curve is fitted on at most CURVE_ROWS texts of each class, chosen by a hash of the doc_id.  The other
    # training texts have been counted and go before the documents' words take their room.
    held = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    rate = {y: min(1.0, CURVE_ROWS / n) for y, n in held.items()}
    chosen_texts = texts.where(" or ".join(f"toxic = {y} and pmod(xxhash64(doc_id), 1000000) < {rate[y] * 1e6:.0f}" for y in rate))
    curve_blocks = stored(_with_expressions(chosen_texts.select("text", "toxic")), "curve")
    discard(texts)
    found = stored(_words_in_blocks(docs), "words", "part")
    # A word is one row with its places, at most those of 2**GROUP_BITS tasks; nearly all words have one.  Sorted
    # neighbours share most expressions, so a block of them has few, and a frequent word has one row for each block.
    near = F.shiftright("place", PLACE_BITS + TASK_BITS + GROUP_BITS)
    words = (found.where("part = 'word'").select(F.col("word").alias("text"), near.alias("near"), "place")
             .repartitionByRange("text", "near").groupBy("text", "near").agg(F.collect_list("place").alias("places"))
             .sortWithinPartitions("text").select("text", "places"))
    blocks = stored(_with_expressions(words), "blocks")
    discard_part(found, "part=word")
    grams = stored(blocks.where("gram is not null").select("gram").distinct(), "grams")
    values = stored(model.values(grams), "values")
    model.discard()
    discard(grams)
    # At most so many rows as there are bins and classes.
    counted = stored(evidence_without_own(curve_blocks, values, model.discounts)
                     .groupBy(_binned("evidence"), _binned("clear"), "toxic").count(), "bins")
    bins = [(r["evidence"], r["clear"], r["toxic"], r["count"] / rate[r["toxic"]]) for r in counted.collect()]
    discard(curve_blocks, counted)
    a, b, c = fit_curve(bins)
    told = stored(word_evidence(blocks, values), "evidence")
    discard(blocks, values)
    score = 1 / (1 + F.exp(-(F.lit(a) * F.col("evidence") + F.lit(b) * F.col("clear") + F.lit(c))))
    return made_from(evidence(found, told, ["doc_id", *keys]).select(
        "doc_id", *keys, held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted")), found, told)
