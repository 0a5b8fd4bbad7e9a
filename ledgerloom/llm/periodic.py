"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least ``MIN_LENGTH`` words and ``MIN_PERIODS`` periods long,
that no neighbouring word extends.  Per text:

1. Words become ids.  A run repeats every ``GRAM`` of its words one period
   later, so only stretches made of repeated grams can hold one; whole runs lie
   within such a stretch, and all other words are in none.
2. Re-Pair compresses a stretch: the most frequent pair of neighbouring symbols
   becomes a nonterminal, until no pair occurs twice.  Among equally frequent
   pairs the oldest goes first, which keeps the derivation of a period balanced.
3. Each nonterminal is looked at once, around the boundary of its two parts:
   the longer side of a run that crosses the boundary repeats ``SEED`` words one
   period away, so the places of those words give the periods to try, and
   extension to both sides gives the run.  The boundaries of the start rule are
   treated alike, with the whole stretch around them.
4. What a nonterminal holds is translated to every place of its derivation, and
   intervals of one period that overlap by a period merge to maximal ones.  Of
   equal intervals the smallest period stays, as its multiples give the same.

Null and empty texts have no words and no runs.  Rows that repeat are answered
row by row; an empty table gives an empty result.  Only the columns named in
``keep`` are carried along, so other columns may have any name.  Very long texts
are processed whole; a task holds one text at a time besides its bounded slice.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.common import slices

MIN_LENGTH, MIN_PERIODS = 24, 3
#: Words of a run that surely come again one period later, from its first word on.
GRAM = MIN_LENGTH - MIN_LENGTH // MIN_PERIODS
#: Words next to a boundary that surely come again one period away on the run's longer side.
SEED = MIN_LENGTH // 2 - MIN_LENGTH // MIN_PERIODS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def _grams(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` ids from every place on; equal stretches have equal hashes."""
    single = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    single ^= single >> np.uint64(29)
    single *= np.uint64(0xBF58476D1CE4E5B9)
    whole, width, power, step = None, 0, single, 1
    while True:
        if size & step:
            if whole is None:
                whole, width = power, step
            else:
                n = len(ids) - width - step + 1
                whole = whole[:n] * np.uint64(0x94D049BB133111EB) + power[width:width + n]
                width += step
        if width == size:
            return whole
        n = len(power) - step
        power = power[:n] * np.uint64(0xD6E8FEB86659FD93 + 2 * step) + power[step:step + n]
        step *= 2


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches whose every word lies in a gram that the text holds twice."""
    if len(ids) < MIN_LENGTH:
        return []
    grams = _grams(ids, GRAM)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(len(ids) + 1, np.int64)
    again = np.union1d(order[1:][same], order[:-1][same])
    twice[again] += 1
    ends = np.minimum(again + GRAM, len(ids))
    np.subtract.at(twice, ends, 1)
    inside = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(twice[:-1]) > 0).astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(inside[::2], inside[1::2], strict=True) if b - a >= MIN_LENGTH]


def re_pair(ids: Sequence[int], first_symbol: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """A Re-Pair grammar: rules (left, right, a place where it stands) and the start rule as (symbol, place).

    Rule k makes symbol ``first_symbol + k``; symbols below are ids.
    """
    sym = list(ids)
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    own = np.asarray(ids, np.int64)
    pairs = own[:-1] << 32 | own[1:]
    order = np.argsort(pairs, kind="stable")
    cuts = np.flatnonzero(np.diff(pairs[order])) + 1
    places: dict[int, list[int]] = {}
    for group in np.split(order, cuts):
        if len(group) > 1:
            places[int(pairs[group[0]])] = group.tolist()
    count = {pair: len(at) for pair, at in places.items()}
    heap = [(-c, places[pair][0], pair) for pair, c in count.items()]
    heapq.heapify(heap)
    rules: list[tuple[int, int, int]] = []
    age = n
    while heap:
        c, born, pair = heapq.heappop(heap)
        if -c != count[pair]:
            if count[pair] > 1:
                heapq.heappush(heap, (-count[pair], born, pair))
            continue
        a, b = pair >> 32, pair & 0xFFFFFFFF
        found, last = [], -1
        for i in sorted(places.pop(pair)):
            if sym[i] == a and i != last and (j := after[i]) < n and sym[j] == b:
                found.append(i)
                last = j
        count[pair] = 0
        if len(found) < 2:
            continue
        new = first_symbol + len(rules)
        rules.append((a, b, found[0]))
        fresh: dict[int, None] = {}
        for i in found:
            j = after[i]
            left, right = before[i], after[j]
            if left >= 0:
                gone = sym[left] << 32 | a
                if gone in count:
                    count[gone] -= 1
                made = sym[left] << 32 | new
                count[made] = count.get(made, 0) + 1
                places.setdefault(made, []).append(left)
                fresh[made] = None
            if right < n:
                gone = b << 32 | sym[right]
                if gone in count:
                    count[gone] -= 1
                made = new << 32 | sym[right]
                count[made] = count.get(made, 0) + 1
                places.setdefault(made, []).append(i)
                fresh[made] = None
                before[right] = i
            sym[i], sym[j], after[i] = new, -1, right
        for made in fresh:
            if count[made] > 1:
                heapq.heappush(heap, (-count[made], age, made))
                age += 1
            elif count[made] < 1:
                places.pop(made, None)
    start, at = [], 0
    while at < n:
        start.append((sym[at], at))
        at = after[at]
    return rules, start


class _Text:
    """A stretch of ids, its places of equal seeds and its extensions."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.back = np.ascontiguousarray(ids[::-1])
        grams = _grams(ids, SEED)
        self.order = np.argsort(grams, kind="stable")
        new = np.concatenate([[True], np.diff(grams[self.order]) != 0])
        group = np.cumsum(new) - 1
        self.bounds = np.append(np.flatnonzero(new), len(grams))
        self.group = np.empty(len(grams), np.int64)
        self.group[self.order] = group

    def places(self, at: int, low: int, high: int) -> np.ndarray:
        """Places from ``low`` up to, not including, ``high`` of the seed that stands at ``at``."""
        g = self.group[at]
        own = self.order[self.bounds[g]:self.bounds[g + 1]]
        return own[np.searchsorted(own, low):np.searchsorted(own, high)]

    @staticmethod
    def _equal(ids: np.ndarray, i: int, j: int, end: int) -> int:
        """Number of equal ids from places i < j on, the second before ``end``."""
        t, step = 0, 32
        while j + t < end:
            m = min(step, end - j - t)
            differ = ids[i + t:i + t + m] != ids[j + t:j + t + m]
            k = int(differ.argmax())
            if differ[k]:
                return t + k
            t, step = t + m, step * 4
        return t

    def extent(self, i: int, q: int, low: int, high: int) -> tuple[int, int]:
        """The stretch of period ``q`` around places i and i + q within [low, high)."""
        end = i + q + self._equal(self.ids, i, i + q, high)
        start = i - self._equal(self.back, self.n - i - q, self.n - i, self.n - low)
        return start, end

    def crossing(self, low: int, at: int, high: int) -> list[Run]:
        """(start, end, period) of the runs within [low, high) that hold the words before and at ``at``."""
        longest = (high - low) // MIN_PERIODS
        tries = []
        if at + SEED < high:
            tries.append((True, self.places(at, at + 1, min(at + longest, high - SEED) + 1) - at))
        if at - SEED > low:
            tries.append((False, (at - SEED - self.places(at - SEED, max(low, at - SEED - longest), at - SEED))[::-1]))
        runs: list[Run] = []
        for ahead, periods in tries:
            known: list[Run] = []
            for q in periods.tolist():
                # A multiple of a period that holds as far as q away has the same extent.
                if any(q % p == 0 and (at + q <= e if ahead else at - q >= s) for s, e, p in known):
                    continue
                s, e = self.extent(at if ahead else at - q, q, low, high)
                if e - s >= 2 * q:
                    known.append((s, e, q))
                if e - s >= max(MIN_LENGTH, MIN_PERIODS * q) and s < at < e:
                    runs.append((s, e, q))
        return runs


def _merged(text: _Text, found: dict[int, list[np.ndarray]]) -> list[Run]:
    """Maximal runs of intervals by period; of equal intervals the one of smallest period."""
    best: dict[tuple[int, int], int] = {}
    for q in sorted(found):
        spans = np.unique(np.concatenate(found[q]), axis=0)
        starts, ends = spans[:, 0], np.maximum.accumulate(spans[:, 1])
        apart = np.flatnonzero(starts[1:] > ends[:-1] - q) + 1
        for first, last in zip(np.append(0, apart), np.append(apart, len(spans)) - 1, strict=True):
            s = int(starts[first])
            s, e = text.extent(s, q, 0, text.n)
            e = max(e, int(ends[last]))
            if e - s >= max(MIN_LENGTH, MIN_PERIODS * q):
                best.setdefault((s, e), q)
    return [(s, e - s, q) for (s, e), q in best.items()]


def _runs_of_stretch(ids: np.ndarray) -> list[Run]:
    text = _Text(ids)
    base = int(ids.max()) + 1
    rules, start = re_pair(ids.tolist(), base)
    size = [1] * base
    for left, right, _ in rules:
        size.append(size[left] + size[right])
    found: dict[int, list[np.ndarray]] = {}
    held: list[list[Run]] = []       # runs around each rule's boundary, from the rule's place on
    inside = [False] * base          # whether a symbol's derivation holds any
    for k, (left, right, at) in enumerate(rules):
        n = size[base + k]
        own = text.crossing(at, at + size[left], at + n) if n >= MIN_LENGTH else []
        held.append([(s - at, e - at, q) for s, e, q in own])
        inside.append(bool(own) or inside[left] or inside[right])
    places: dict[int, list[np.ndarray]] = {}
    for symbol, at in start:
        if at:
            for s, e, q in text.crossing(0, at, text.n):
                found.setdefault(q, []).append(np.array([[s, e]]))
        if inside[symbol]:
            places.setdefault(symbol, []).append(np.array([at]))
    for k in range(len(rules) - 1, -1, -1):
        if base + k not in places:
            continue
        left, right, _ = rules[k]
        at = np.concatenate(places.pop(base + k))
        for s, e, q in held[k]:
            found.setdefault(q, []).append(np.stack([at + s, at + e], axis=1))
        if inside[left]:
            places.setdefault(left, []).append(at)
        if inside[right]:
            places.setdefault(right, []).append(at + size[left])
    return _merged(text, found)


def runs(words: Sequence[str]) -> list[Run]:
    """(start, length, period) of all runs of ``words``, by start, then period."""
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    out: list[Run] = []
    for a, b in stretches(ids):
        # Numbered anew, so that the symbols of a stretch are few.
        own = np.unique(ids[a:b], return_inverse=True)[1].reshape(-1)
        out += [(a + s, n, q) for s, n, q in _runs_of_stretch(own)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: Sequence[str], found: Sequence[Run]) -> str:
    """The words without those that any run holds after its first period, joined by one space."""
    if not found:
        return " ".join(words)
    keep = np.ones(len(words), bool)
    for s, n, q in found:
        keep[s + q:s + n] = False
    return " ".join(words[i] for i in np.flatnonzero(keep).tolist())


def strongest(found: Sequence[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


_RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                     T.StructField("period", T.LongType())])


def with_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and n_words, runs (array of start, length, period), strongest and collapsed of every row."""
    source = docs.select(*keep, F.coalesce(text, F.lit("")).alias("text"))
    new = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)),
                        T.StructField("strongest", _RUN), T.StructField("collapsed", T.StringType())])
    schema = T.StructType([*source.schema.fields[:-1], *new.fields])
    target, kinds = to_arrow_schema(schema), to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = lambda r: None if r is None else dict(zip(("start", "length", "period"), r, strict=True))
        for whole in batches:
            for batch in slices(whole):
                rows: list[list] = [[], [], [], []]
                for value in batch.column(batch.num_columns - 1):
                    words = WORD.findall(value.as_py())
                    found = runs(words)
                    for column, x in zip(rows, (len(words), [struct(r) for r in found], struct(strongest(found)),
                                                collapsed(words, found)), strict=True):
                        column.append(x)
                made = [pa.array(x, f.type) for x, f in zip(rows, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], schema=target)

    return source.mapInArrow(run, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts of every tenth hash of doc_id with their tail replaced by a repeated part of it.

    With the n words of a text, h = crc32 of doc_id as text and g = h // 10: where
    h is a multiple of 10 and there is a word, word i >= a becomes word a + (i - a) % p,
    a = g % n, p = 1 + (n - a) // (3 + g % 8).  Other texts, and rows without
    doc_id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    split = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    sized = split.withColumn("n", F.size("w"))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    part = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))),
                   F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return part.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))
