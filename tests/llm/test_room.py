"""What operators leave in the shared folder, carry through joins and hold at once."""

import random
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import bpe, common, packing, quality, toxicity

SF = "/root/testdata/sf0.001"
MODULES = (corpus_pipeline, quality, corpus_pipeline.minhash, toxicity)


@pytest.fixture
def tables(monkeypatch):
    """Labels of the stored tables that are there, and at each store those that were there then."""
    there, seen = [], []
    store, delete = common.stored, common._delete
    paths = {}

    def stored(df, label, parts=None):
        out = store(df, label, parts)
        seen.append((label, sorted(there)))
        there.append(label)
        paths[out.stored_in] = label
        return out

    def deleted(spark, path):
        delete(spark, path)
        if path in paths:
            there.remove(paths[path])

    for module in MODULES:
        monkeypatch.setattr(module, "stored", stored)
    monkeypatch.setattr(common, "_delete", deleted)
    return there, seen


def test_stages_leave_only_what_their_result_reads(spark, tables):
    there, _ = tables
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for stage, left in ((corpus_pipeline.without_toxic, {"toxic"}), (corpus_pipeline.with_quality, {"clean"}),
                        (corpus_pipeline.one_of_each, {"components"})):
        there.clear()
        out = stage(spark, docs, SF)
        # Model tables stay where no class can be learned.
        assert set(there) - {"training", "expressions"} == left
        assert 0 < out.count() <= docs.count()


def test_training_texts_go_before_the_words_come(spark, tables):
    rows = [(k, f"good calm kind word{k % 7}" if k % 2 else f"kvexba kvexlo kvexta word{k % 5}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2) for k, _ in rows], "doc_id long, toxic int")
    assert toxicity.scores(docs, labels).count() == 60
    held = dict(tables[1])
    assert "curve" in held["words"] and "training" not in held["words"]


def test_a_text_travels_once_to_its_common_lines(spark, monkeypatch):
    carried = []

    def names(plan):
        if plan.nodeName() == "Join":
            out = plan.left().output()
            carried.append([out.apply(k).name() for k in range(out.size())])
        for k in range(plan.children().size()):
            names(plan.children().apply(k))

    def stored(df, label, parts=None):
        names(df._jdf.queryExecution().optimizedPlan())
        return common.stored(df, label, parts)

    monkeypatch.setattr(corpus_pipeline, "stored", stored)
    corpus_pipeline.with_quality(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert carried == [["row", "source", "n_words", "_hash"]]


def test_merges_of_many_words_equal_those_of_one(monkeypatch):
    vocab = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    merges, rng = bpe.MergeTable(vocab), random.Random(5)
    letters = "etaoinshr étöß.,#\n漢"
    words = ["", "a", "ab", "x" * 64, "x" * 65, *("".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(600))]
    held, whole = [], merges._merge
    monkeypatch.setattr(bpe.MergeTable, "TOGETHER", 50)
    monkeypatch.setattr(merges, "_merge", lambda part, *rest: held.append(len(part)) or whole(part, *rest))
    raw = [w.encode() for w in words]
    assert [np.frombuffer(x, "<u4").tolist() for x in merges.merge(raw)] == [bpe.merge_word(w, vocab) for w in raw]
    assert max(held) == 50


def test_chunks_are_learned_alike_from_either_cache(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(bpe, "CACHE_WORDS", 8)     # generations turn with nearly every text
    few, rng = bpe.Encoder(path), random.Random(9)
    few.AT_ONCE = 40
    parts = ["word", "word.", "word,", "wörd", ".", ",", "a1", "it's", "x.\ny", "", " ", "\n", "12", "!?"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)]
    want = [[i for w in few.pattern.findall(t) for i in bpe.merge_word(w.encode(), few.vocab)] for t in texts]
    assert [x.tolist() for x in few.encode_all(texts)] == want


def test_many_texts_are_cut_as_the_pattern_cuts_one():
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(21)
    enc = bpe.Encoder(path)
    parts = [" ", "  ", "\n", "\t", "\u3000", "\x1c", "'", "''", "'s", "'re", "'ll", "'l", "'sa", "s", "re", "a", "the", "wörd", "日本語", "7", "Ⅷ",
             "é", "\u0301", "😀", "--", ".", "\0", "ab\0", "x" * 16, "x" * 17, "é" * 8, "é" * 9, "<|endoftext|>", "<|endoftext"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4000)]
    texts += ["", "'", "it's", "it'", "'ll", " 's", "\n's", "a'sa'd's", "\0", " \0", "a", "a\0", "a\0\0"]
    special = enc.vocab.special
    want = []
    for t in texts:
        cut = enc.special.split(t) if enc.special else [t]
        marks = [special[m] for m in enc.special.findall(t)] if enc.special else []
        ids = [[i for w in enc.pattern.findall(c) for i in bpe.merge_word(w.encode(), enc.vocab)] for c in cut]
        want.append([i for own, mark in zip(ids, [*([m] for m in marks), []], strict=True) for i in own + mark])
    for at_once in (1, 200, 1_500_000):
        enc.AT_ONCE = at_once
        assert [x.tolist() for x in enc.encode_all(texts)] == want


def test_texts_are_encoded_without_a_call_for_every_word():
    """Python's time follows the batches and the long words, not the words."""
    import sys
    enc, rng = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(4)
    # Few words and marks, but many different stretches between spaces.
    stems = ["".join(rng.choices("etaoinshr", k=rng.randint(3, 9))) for _ in range(1000)]
    marks = ["".join(rng.choices("!?;:-", k=rng.randint(0, 3))) for _ in range(50)]
    words = [rng.choice(stems) + rng.choice(marks) for _ in range(20_000)]
    next(enc.encode_all(["warm"]))
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        n = sum(len(ids) for ids in enc.encode_all([" ".join(words)]))
    finally:
        sys.setprofile(None)
    assert n > len(words)
    assert calls < len(words) / 2


def test_words_whose_keys_meet_in_a_slot_stay_apart():
    cache, rng = bpe.Cache(10), np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 60, (5000, 2)), axis=0).astype(np.uint64)
    low, high = keys[:, 0], keys[:, 1]
    cache._MIX = np.zeros(2, np.uint64)        # all in one slot
    half = 200
    cache.add(low[:half], high[:half], np.arange(half))
    assert cache.find(low[:400], high[:400]).tolist() == [*range(half), *[-1] * 200]
    del cache._MIX
    cache.clear()
    for lo in range(0, len(low), 700):         # the table grows on the way
        cache.add(low[lo:lo + 700], high[lo:lo + 700], np.arange(lo, min(lo + 700, len(low))))
    assert cache.find(low, high).tolist() == list(range(len(low)))
    assert cache.find(low + np.uint64(100), high).max() == -1


def test_packing_takes_texts_in_slices(spark, monkeypatch):
    asked = []
    whole = packing.map_frames
    monkeypatch.setattr(packing, "map_frames", lambda df, run, schema, limit=None: asked.append(limit) or whole(df, run, schema, limit))
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == 2
    assert asked == [common.SLICE_BYTES]


def test_rows_go_to_python_in_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "mb": [batch.nbytes >> 20], "longest": [
                max(map(len, batch.column("text").to_pylist()), default=0)]})

    # Longer rows than a batch may hold stand alone.
    long = F.when(F.col("id") == 7, F.repeat(F.lit("y"), 6 << 20)).otherwise(F.repeat(F.lit("x"), 10_000))
    texts = spark.range(2000).coalesce(1).select("id", long.alias("text"))
    got = common.stored(texts.mapInArrow(sizes, "rows long, mb long, longest long"), "sizes").collect()
    assert sum(r["rows"] for r in got) == 2000 and max(r["longest"] for r in got) == 6 << 20
    assert max(r["mb"] for r in got if r["longest"] == 10_000) <= common.SLICE_BYTES >> 20
    assert max(r["mb"] for r in got) <= 12


def own_mb():
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", f.read()))) / 1024


def test_a_worker_gives_back_what_it_has_freed():
    # Blocks that the C library keeps, as one behind them stays.
    held = [bytearray(b"x" * 50_000) for _ in range(2000)]
    last, full = held[-1], own_mb()
    del held
    common.give_back()
    assert len(last) == 50_000 and own_mb() < full - 80


def test_python_tasks_give_back_their_room_at_the_end(monkeypatch):
    gave = []
    monkeypatch.setattr(common, "give_back", lambda: gave.append(1))
    run = common.giving_back(lambda batches: (2 * b for b in batches))
    assert list(run(iter([1, 2]))) == [2, 4] and len(gave) == 1
    early = run(iter([1, 2]))
    next(early)
    early.close()
    assert len(gave) == 2
    common.keep_in_worker("a", lambda: None)
    assert len(gave) == 2
    common.keep_in_worker("b")
    assert len(gave) == 3


def test_encoding_many_texts_takes_little_room():
    enc, rng = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(8)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 8))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=1000)) for _ in range(500)]     # 3 million characters
    next(enc.encode_all([" ".join(words)]))
    tracemalloc.start()
    n = sum(len(ids) for ids in enc.encode_all(texts))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert n > 500_000 and peak < 20
