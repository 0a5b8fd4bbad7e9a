"""Byte-level BPE: encoding by a segment tree over pair ranks, and decoding.

A text is cut at its special tokens, then at word boundaries, and each word's
bytes are merged pair by pair.  ``merge_word`` keeps the rank of every adjacent
pair in a segment tree whose inner nodes hold the smaller (rank, position) of
their two halves.  The root is the leftmost pair of lowest rank; a merge
changes three leaves (the merged pair and its two neighbours), each updated in
logarithmic time, until the root says that no pair can be merged.  A run of n
bytes without a word boundary so costs n log n, not n squared.

Words repeat, so ``Encoder`` remembers their ids in a cache of bounded size;
the cache only saves work and never changes a result.  Many texts are cut into
words at once by the kinds of neighbouring characters (``word_starts``), and a
word of up to 16 bytes is looked up by its bytes as two integers (``Cache``).

Null texts encode as empty texts: no ids, and an empty decoded text.  Rows are
independent, so repeated rows, ties and empty tables need no rule of their
own; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import map_frames

#: A worker's cache is emptied when it holds more than twice as many words.
CACHE_WORDS = 500_000
#: No pair here can be merged; larger than any (rank, position) key.
NO_PAIR = 1 << 62
#: Fixed value: the pattern that cuts words, as the vocabulary's own file names it (byte level with its regex).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        byte = {c: b for b, c in enumerate(letter)}
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = [ids[c] for c in letter]
        #: (left id, right id) -> (rank, merged id), keyed by left * 2^32 + right
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(ids[left] << 32 | ids[right], (rank, ids[left + right]))
        self.bytes_of: list[bytes] = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = bytes(byte[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()


def merge_word(word: bytes, vocab: Vocabulary) -> list[int]:
    """Token ids of one word: repeated merge of the leftmost lowest-rank pair."""
    ids = [vocab.byte_ids[b] for b in word]
    n = len(ids)
    if n < 2:
        return ids
    merges = vocab.merges
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    # Leaf size + i is the pair that starts at i; its key is rank * 2^32 + i, so
    # the smaller key is the lower rank, and of equal ranks the leftmost.
    tree = [NO_PAIR] * (2 * size)
    for i in range(n - 1):
        found = merges.get(ids[i] << 32 | ids[i + 1])
        if found is not None:
            tree[size + i] = found[0] << 32 | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    while (best := tree[1]) != NO_PAIR:
        i = best & 0xFFFFFFFF
        j = after[i]
        ids[i] = merges[ids[i] << 32 | ids[j]][1]
        ids[j] = -1
        k = after[i] = after[j]
        h = before[i]
        changed = [(j, NO_PAIR)] if k < n else [(j, NO_PAIR), (i, NO_PAIR)]
        if k < n:
            before[k] = i
            found = merges.get(ids[i] << 32 | ids[k])
            changed.append((i, NO_PAIR if found is None else found[0] << 32 | i))
        if h >= 0:
            found = merges.get(ids[h] << 32 | ids[i])
            changed.append((h, NO_PAIR if found is None else found[0] << 32 | h))
        for leaf, key in changed:
            if leaf >= size:
                continue
            at = size + leaf
            tree[at] = key
            while at > 1:
                at >>= 1
                a, b = tree[2 * at], tree[2 * at + 1]
                low = a if a < b else b
                if tree[at] == low:
                    break
                tree[at] = low
    return [x for x in ids if x >= 0]


class MergeTable:
    """The merges as sorted arrays, for many words at a time."""

    #: Words of up to so many bytes are merged together; longer ones one by one.
    WIDEST = 64
    #: Words merged together at most, so that their trees stay in a core's cache.
    TOGETHER = 8192

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.byte_ids = np.array(vocab.byte_ids, np.int64)
        pairs = sorted((pair >> 32 << 20 | pair & 0xFFFFFFFF, rank) for pair, (rank, _) in vocab.merges.items())
        self.pairs = np.array([p for p, _ in pairs] + [1 << 62], np.int64)
        self.ranks = np.array([r for _, r in pairs] + [0], np.int32)
        self.merged = np.zeros(max(r for _, r in pairs) + 1 if pairs else 1, np.int64)
        for rank, made in vocab.merges.values():
            self.merged[rank] = made
        # Ranks of the pairs that words begin with, by their two bytes.
        left, right = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_keys = self.keys(left, right, np.zeros(1 << 16, np.int64))

    def keys(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """rank * 64 + position of the pairs that can be merged, else the largest number."""
        pair = np.where((left < 0) | (right < 0), -1, left << 20 | right)
        found = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[found] == pair, self.ranks[found] * self.WIDEST + at, np.iinfo(np.int32).max).astype(np.int32)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian bytes; one segment tree per word, all stepped together."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = 2
        while width <= self.WIDEST:
            rows = np.nonzero((lengths <= width) & (lengths > (width // 2 if width > 2 else 0)))[0]
            for lo in range(0, len(rows), self.TOGETHER):
                part = rows[lo:lo + self.TOGETHER]
                at = part.tolist()
                for r, own in zip(at, self._merge([words[r] for r in at], lengths[part], width), strict=True):
                    out[r] = own
            width *= 2
        for r in np.nonzero(lengths > self.WIDEST)[0]:
            out[r] = np.array(merge_word(words[r], self.vocab), "<u4").tobytes()
        return out

    def _merge(self, words: list[bytes], lengths: np.ndarray, width: int) -> list[bytes]:
        n, none = len(words), np.iinfo(np.int32).max
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(n, width)
        place = np.arange(width)
        # Column ``width`` stands for "no neighbour": its id is -1 and no pair has it.
        wide = width + 1
        ids = np.full((n, wide), -1, np.int64)
        ids[:, :width] = np.where(place < lengths[:, None], self.byte_ids[raw], -1)
        after = np.tile(np.append(place + 1, width), (n, 1))
        before = np.tile(np.append(np.where(place > 0, place - 1, width), width), (n, 1))
        tree = np.full((n, 2 * width), none, np.int32)
        first = self.byte_keys[(raw[:, :-1].astype(np.int32) << 8) | raw[:, 1:]]
        some = (first != none) & (place[1:] < lengths[:, None])
        tree[:, width:-1] = np.where(some, first + place[:-1].astype(np.int32), none)
        for k in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        # The same arrays in one dimension, where single places are read and written faster.
        ids_at, after_at, before_at, tree_at = (x.reshape(-1) for x in (ids, after, before, tree))
        row = np.arange(n)
        while len(row := row[(best := tree[row, 1]) != none]):
            best = best[best != none]
            base, top = row * wide, row * (2 * width)
            i = best % self.WIDEST
            new = self.merged[best // self.WIDEST]
            ids_at[base + i] = new
            j = after_at[base + i]
            ids_at[base + j] = -1
            k = after_at[base + j]
            after_at[base + i] = k
            before_at[base + k] = i
            h = before_at[base + i]
            left = self.keys(ids_at[base + h], new, h)
            right = self.keys(new, ids_at[base + k], i)
            # Without a pair before it the merged pair's own leaf is written twice.
            tree_at[top + width + np.where(h == width, i, h)] = left
            tree_at[top + width + i] = right
            tree_at[top + width + j] = none
            # The merged pair, the one before it and the one after it are new.
            at = np.concatenate([width + np.where(h == width, i, h), width + i, width + j])
            top = np.tile(top, 3)
            for _ in range(width.bit_length() - 1):
                at >>= 1
                under = top + 2 * at
                tree_at[top + at] = np.minimum(tree_at[under], tree_at[under + 1])
        kept = ids[:, :width] >= 0
        flat, ends = ids[:, :width][kept].astype("<u4").tobytes(), (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        return [flat[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


#: Kinds of characters, as the pattern tells them apart; ``_END`` stands behind each stretch of text.
_OTHER, _LETTER, _NUMBER, _SPACE, _END = range(5)


@functools.lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """The kind of every code point."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _SPACE)):
        for m in regex.finditer(pattern, every):
            kinds[ord(every[m.start()]):ord(every[m.end() - 1]) + 1] = kind
    kinds[0xD800:0xE000] = _OTHER
    return kinds


def word_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Which characters begin a word of ``WORD_PATTERN``; every stretch of text ends with one of kind ``_END``."""
    start = np.ones(len(points), bool)
    np.not_equal(kinds[1:], kinds[:-1], out=start[1:])
    # The last white space before a word: a space is part of the word, another one a word of its own.
    next_ = np.flatnonzero((kinds[:-1] == _SPACE) & (kinds[1:] < _SPACE)) + 1
    start[next_ - 1] = True
    start[next_[points[next_ - 1] == 0x20]] = False
    # A lone apostrophe takes the letters of a contraction with it; the letters after those are another word.
    mark = np.flatnonzero(points == 0x27)
    mark = mark[start[mark] & (kinds[mark + 1] == _LETTER)]
    one = points[mark + 1]
    short = mark[np.isin(one, [ord(c) for c in "stmd"])]
    two = one.astype(np.int64) << 32 | points[mark + 2]
    long = mark[np.isin(two, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]
    for at, letters in ((short, 1), (long, 2)):
        start[at + 1] = False
        after = at + 1 + letters
        start[after[kinds[after] == _LETTER]] = True
    return start


def _room(held: np.ndarray, n: int) -> np.ndarray:
    """``held`` with room for ``n`` values."""
    if n <= len(held):
        return held
    out = np.empty(max(n, 2 * len(held)), held.dtype)
    out[:len(held)] = held
    return out


class Cache:
    """Numbers of words of at most 16 bytes, which are looked up many at a time.

    A word's bytes are its key, as two integers filled up with zeros, so a
    word with a zero byte does not belong here.  Keys stand in a hash table with
    open addressing; a key that is not the one asked for is passed over, so two words
    never share a number.
    """

    WIDEST = 16
    _ROOM = 1 << 12
    _MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    _MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.n, self.bits = 0, 13
        self.low, self.high, self.number = (np.empty(self._ROOM, t) for t in (np.uint64, np.uint64, np.int32))
        self.slots = np.full(1 << self.bits, -1, np.int32)

    @classmethod
    def keys(cls, raw: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys of the words at ``at``; ``raw`` goes on for 16 bytes after the last."""
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        return (eight[at] & cls._MASKS[np.minimum(size, 8)],
                eight[at + 8] & cls._MASKS[np.clip(size - 8, 0, 8)])

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = low * self._MIX[0] + high * self._MIX[1]
        mixed ^= mixed >> np.uint64(32)
        return (mixed * self._MIX[0] >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The words' numbers, -1 for words that are not here."""
        at = self._slot(low, high)
        got = self.slots[at]
        wrong = np.flatnonzero(((self.low[got] != low) | (self.high[got] != high)) & (got >= 0))
        while len(wrong):
            at[wrong] = at[wrong] + 1 & len(self.slots) - 1
            now = got[wrong] = self.slots[at[wrong]]
            wrong = wrong[((self.low[now] != low[wrong]) | (self.high[now] != high[wrong])) & (now >= 0)]
        return np.where(got >= 0, self.number[got], -1)

    def add(self, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> None:
        """Takes in words that differ and are not here."""
        first, self.n = self.n, self.n + len(low)
        for name, values in (("low", low), ("high", high), ("number", number)):
            held = _room(getattr(self, name), self.n)
            held[first:self.n] = values
            setattr(self, name, held)
        if 2 * self.n > len(self.slots):
            self.bits, first = int(2 * self.n).bit_length() + 1, 0
            self.slots = np.full(1 << self.bits, -1, np.int32)
        own = np.arange(first, self.n, dtype=np.int32)
        at = self._slot(self.low[first:self.n], self.high[first:self.n])
        while len(own):
            free = self.slots[at] < 0
            self.slots[at[free]] = own[free]       # of several for one slot the last stays
            left = self.slots[at] != own
            own, at = own[left], at[left] + 1 & len(self.slots) - 1


class Encoder:
    """Encodes and decodes texts with one vocabulary.

    Many texts are cut into words at a time, and the words looked up together.
    ``merge`` gives the ids of words (as little-endian bytes); by default the
    segment trees of ``MergeTable``.
    """

    #: Characters of text encoded at a time, so that the words of many texts are merged together.
    AT_ONCE = 400_000

    def __init__(self, path: str, merge: Callable[[list[str]], list[bytes]] | None = None):
        self.vocab = Vocabulary(path)
        #: Cuts one text as ``word_starts`` cuts many.
        self.pattern = regex.compile(WORD_PATTERN)
        self.merge = MergeTable(self.vocab).merge if merge is None else lambda words: merge([w.decode() for w in words])
        special = sorted(self.vocab.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        # Keyed by the bytes after a space, and for words that no space precedes.
        self.spaced, self.bare = Cache(CACHE_WORDS), Cache(CACHE_WORDS // 4)
        self._clear()

    def _clear(self) -> None:
        """Lets go of all words; number 0 stands for no ids, the next for special tokens."""
        self.spaced.clear()
        self.bare.clear()
        self.long: dict[bytes, int] = {}       # words that are too long for a key, or hold a zero byte
        self.ids, self.begin, self.size = (np.empty(Cache._ROOM, t) for t in (np.uint32, np.int64, np.int64))
        self.n_ids = self.n_words = 0
        self._number([b"", *(i.to_bytes(4, "little") for i in self.vocab.special.values())])
        self.marks = {t: k for k, t in enumerate(self.vocab.special, 1)}

    def _number(self, ids: list[bytes]) -> np.ndarray:
        """New numbers for words with these ids."""
        own = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, end, end_ids = self.n_words, self.n_words + len(ids), self.n_ids + len(own)
        self.begin, self.size, self.ids = _room(self.begin, end), _room(self.size, end), _room(self.ids, end_ids)
        self.begin[first:end], self.size[first:end] = self.n_ids + np.cumsum(size) - size, size
        self.ids[self.n_ids:end_ids] = own
        self.n_words, self.n_ids = end, end_ids
        return np.arange(first, end)

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in order; special tokens written in a text count as themselves."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= self.AT_ONCE:
                yield from self._encode(held)
                held, size = [], 0
        if held:
            yield from self._encode(held)

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        # Twice the limit: as many as two generations of words.
        if self.spaced.n > 2 * self.spaced.limit or self.bare.n > 2 * self.bare.limit or len(self.long) > self.bare.limit:
            self._clear()
        stretches, after, last = [], [], []      # stretches of text, the number of what follows each, each text's last one
        for text in texts:
            done = 0
            if self.special:
                for m in self.special.finditer(text):
                    stretches.append(text[done:m.start()])
                    after.append(self.marks[m.group()])
                    done = m.end()
            stretches.append(text[done:] if done else text)
            after.append(0)
            last.append(len(after) - 1)
        numbers, ends = self._words(stretches)
        numbers[ends] = after
        size = self.size[numbers]
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(self.begin[numbers] - stop + size, size) + np.arange(stop[-1])]
        stops = stop[ends[last]].tolist()
        for s, e in zip([0, *stops[:-1]], stops, strict=True):
            yield ids[s:e]

    def _words(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words in order, with one more place after each stretch, and these places."""
        whole = "\n".join([*stretches, ""])
        raw = whole.encode()
        points = np.frombuffer(raw, np.uint8) if len(raw) == len(whole) else np.frombuffer(whole.encode("utf-32-le"), "<u4")
        kinds = character_kinds()[points]
        kinds[np.cumsum(np.fromiter(map(len, stretches), np.int64, len(stretches)) + 1) - 1] = _END
        at = np.flatnonzero(word_starts(points, kinds) | (kinds == _END))
        ends = np.flatnonzero(kinds[at] == _END)
        begin = at
        if len(raw) != len(whole):     # places of characters become places of bytes
            width = np.ones(len(points), np.int8)
            for wider in (0x80, 0x800, 0x10000):
                width += points >= wider
            begin = (np.cumsum(width, dtype=np.int64) - width)[at]
        size = np.diff(begin, append=len(raw))
        spaced = (points[at] == 0x20) & (size > 1)
        begin, size = begin + spaced, size - spaced
        long = size > Cache.WIDEST
        zeros = np.flatnonzero(points == 0)
        if len(zeros):
            long[np.searchsorted(at, zeros, side="right") - 1] = True
        numbers = np.zeros(len(at), np.int64)
        low, high = Cache.keys(raw + b"\0" * Cache.WIDEST, begin, size)
        short = ~long
        short[ends] = False
        for cache, own in ((self.spaced, spaced & short), (self.bare, short & ~spaced)):
            own = np.flatnonzero(own)
            own_low, own_high = low[own], high[own]
            got = cache.find(own_low, own_high)
            fresh = np.flatnonzero(got < 0)
            if len(fresh):
                fresh = fresh[np.lexsort((own_low[fresh], own_high[fresh]))]
                new_low, new_high = own_low[fresh], own_high[fresh]
                one = np.append(True, (new_low[1:] != new_low[:-1]) | (new_high[1:] != new_high[:-1]))
                words = own[fresh[one]]
                made = self._learn(raw, begin[words] - (cache is self.spaced), begin[words] + size[words])
                cache.add(new_low[one], new_high[one], made)
                got[fresh] = made[np.cumsum(one) - 1]
            numbers[own] = got
        long[ends] = False
        at = np.flatnonzero(long)
        if len(at):
            words = [raw[s:e] for s, e in zip((begin - spaced)[at].tolist(), (begin + size)[at].tolist(), strict=True)]
            fresh = [w for w in dict.fromkeys(words) if w not in self.long]
            self.long.update(zip(fresh, self._number(self.merge(fresh)).tolist(), strict=True))
            numbers[at] = [self.long[w] for w in words]
        return numbers, ends

    def _learn(self, raw: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers for new words, given by their places."""
        return self._number(self.merge([raw[s:e] for s, e in zip(begin.tolist(), end.tolist(), strict=True)]))

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.vocab.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    made = Encoder(path)
    gc.freeze()       # it and the loaded modules stay, so collections need not visit them
    return made


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "ids": [i.astype(np.int32) for i in enc.encode_all(t or "" for t in pdf["text"])]})

    return map_frames(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), run, schema)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    schema = T.StructType([encoded.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "text": [enc.decode(np.asarray(i if i is not None else [], np.int64)) for i in pdf["ids"]]})

    return map_frames(encoded.select("doc_id", "ids"), run, schema)


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded text.

    Encoding and decoding run back to back in the task that holds the text, so
    neither ids nor decoded texts travel; nothing is shuffled.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        decimal = [str(i) for i in range(len(enc.vocab.bytes_of))]
        for pdf in batches:
            rows = []
            for ids in enc.encode_all(t or "" for t in pdf["text"]):
                written = ",".join(map(decimal.__getitem__, ids.tolist()))
                rows.append((len(ids), hashlib.sha256(written.encode()).hexdigest(),
                             hashlib.sha256(enc.decode(ids).encode()).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    return map_frames(docs.select("doc_id", "text"), run, schema)
