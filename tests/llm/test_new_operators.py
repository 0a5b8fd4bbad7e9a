"""Prefix trie, decontamination and periodic runs against brute force."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, periodic, prefix_trie
from ledgerloom.llm.common import slices
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- prefix trie ---------------------------------------------------------------
def originals(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(own)] for c, own in out.items()}


def rebuilt(rows):
    own = originals(rows)
    out = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + said[h:]
    return out


def brute_trie(convs):
    members = collections.defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1]) if p else 0
    return sorted((own[0], len(p), members[p[:-1]][0] if p else None, len(own), children[p], leaves[p], saved[p],
                   sha(",".join(str(c) for c in own if len(convs[c]) == len(p)))) for p, own in members.items())


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found_trie(df):
    return sorted(tuple(r) for r in df.select(*NODE).collect())


def as_key(rows):
    return sorted(rows, key=str)


def talk(seed, n=260):
    rng = random.Random(seed)
    said = [(rng.choice(["user", "assistant", None, ""]), rng.choice(["", None, "a:b", "hello", "é" * 9, "same"])) for _ in range(9)]
    rows = []
    for _ in range(n):
        c = rng.choice([*range(-3, 12), *range(95, 130), 100, 200, 2**60 + 7, 2**60 - 2**60 % 100])
        role, text = rng.choice(said[:2] if rng.random() < 0.5 else said)
        rows.append((c, rng.choice([None, 0, 1, 1, 2, 3, 4, 5, 6, 7]), role, text))
    return [*rows, *rows[:20], (None, 1, "user", "nobody's"), (77, 0, "user", "alone")]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_rebuilt_conversations(spark, seed, monkeypatch):
    rows = talk(seed)
    # Other columns may bear the operator's own names.
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA + ", ka string, depth long").repartition(5)
    want = as_key(brute_trie(rebuilt(rows)))
    assert as_key(found_trie(prefix_trie.trie(prefix_trie.rebuilt(df)))) == want


@pytest.mark.parametrize("piece, shard", [(1, 3), (2, 1), (3, 7), (2048, 2)])
def test_trie_of_pieces_and_small_shards(spark, piece, shard, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    rows = talk(3, 120)
    assert as_key(found_trie(prefix_trie.trie(prefix_trie.whole(spark.createDataFrame(rows, SCHEMA).repartition(3))))) == as_key(
        brute_trie(originals(rows)))


def test_shards_across_arrow_batches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD", 4)
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = talk(4, 150)
        assert as_key(found_trie(prefix_trie.trie(prefix_trie.whole(spark.createDataFrame(rows, SCHEMA))))) == as_key(
            brute_trie(originals(rows)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 64)
    rows = [(5, k, "user", f"t{k % 7}") for k in range(1000)] + [(6, k, "user", f"t{k % 7}") for k in range(700)] + [(7, 0, "user", "t0")]
    got = {(r[0], r[1]): r for r in found_trie(prefix_trie.trie(prefix_trie.whole(spark.createDataFrame(rows, SCHEMA))))}
    assert len(got) == 1001 and got[5, 0][3:7] == (3, 1, 1, 2 * 2 + 699 * 2) and got[5, 1000][3:7] == (1, 0, 1, 0)
    assert got[5, 700][7] == sha("6") and got[5, 1][7] == sha("7") and got[5, 65][2] == 5


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(prefix_trie.rebuilt(none)).count() == 0
    only = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert prefix_trie.trie(prefix_trie.whole(only)).count() == 0


def test_op11_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_key(found_trie(QUERIES["op11_prefix_trie"](spark, SF))) == as_key(brute_trie(rebuilt(rows)))


# -- decontamination -----------------------------------------------------------
def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_contamination(docs, items):
    patterns = collections.defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        m = min(10, len(words))
        for k in range(len(words) - m + 1 if words else 0):
            patterns[tuple(words[k:k + m])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words = plain_words(text)
        hit, found = set(), set()
        for m in {len(p) for p in patterns}:
            for k in range(len(words) - m + 1):
                own = patterns.get(tuple(words[k:k + m]))
                if own:
                    hit.update(range(k, k + m))
                    found |= own
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out, key=str)


def digest_rows(df):
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_words", n_hit, F.size("items").cast("long"), F.sha2(F.array_join("items", ","), 256),
        F.size("spans") > 0).collect()), key=str)


def leaks(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "the", "of", "Été", "x1", "ZZ", "naïve", str(rng.randint(0, 9))])
    items = [(k, " ".join(word() for _ in range(rng.choice([10, 11, 25, 60])))) for k in range(30)]
    items += [(7, "short One"), (8, "single9"), (None, "no id here"), (9, None), (10, "  ...  "), items[3], (41, items[3][1]),
              (2**60 + 1, " ".join(word() for _ in range(14)))]
    docs = []
    for k in range(80):
        own = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            words = plain_words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(words) - 5))
            at = rng.randint(0, len(own))
            own[at:at] = [w.upper() for w in words[a:a + rng.randint(5, 30)]]
        docs.append((k if k % 9 else None, rng.choice([" ", ", ", "\n"]).join(own)))
    return [*docs, docs[5], docs[5], (2**60 + 3, None), (1, ""), (2, "ÉTÉ été"), (3, "Single9, short one")], items


@pytest.mark.parametrize("limit", [decontaminate.BLOCK_BYTES, 4000])
def test_contamination_by_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENT", 7 if limit == 4000 else 2048)
    docs, items = leaks(limit)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, spans string, digest long").repartition(3)
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, block string")
    assert digest_rows(decontaminate.contamination(df, bench, block_bytes=limit)) == brute_contamination(docs, items)


def test_blocks_are_bounded(spark):
    bench = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(40))) for k in range(50)], "item_id long, text string")
    held = decontaminate.blocked(decontaminate.segments(bench), 1000).groupBy("block").agg(F.sum("cost"), F.max("cost")).collect()
    assert len(held) > 10 and all(r[1] <= 1000 + r[2] for r in held)


def test_contamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id string, text string")
    row = decontaminate.contamination(docs, none).first()
    assert (row.n_words, row.spans, row["items"]) == (2, [], [])
    assert decontaminate.contamination(docs.where("false"), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_wu_manber_finds_what_overlaps():
    search = decontaminate.WuManber({(b"a", b"b", b"a"): 0, (b"b", b"a", b"b"): 1, (b"c", b"c", b"c"): 2})
    assert list(search.search(b"a b a b c c c c".split())) == [(0, 0), (1, 1), (4, 2), (5, 2)]


def test_op12_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_decontamination"](spark, SF).collect()), key=str)
    assert got == brute_contamination(docs, items) and any(r[5] for r in got)


# -- periodic runs ---------------------------------------------------------------
def brute_runs(words):
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(24, 3 * q):
                best.setdefault((s, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def babble(rng):
    kinds, own = rng.choice([1, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 8)):
        r = rng.random()
        if r < 0.5:
            part = [rng.randint(0, kinds) for _ in range(rng.randint(1, 14))]
            own += [part[i % len(part)] for i in range(rng.randint(1, 70))]
        elif r < 0.7 and own:
            a = rng.randrange(len(own))
            own += own[a:a + rng.randint(1, 60)]
        else:
            own += [rng.randint(0, kinds) for _ in range(rng.randint(1, 30))]
    return [f"w{x}" for x in own]


def test_runs_by_brute_force():
    rng = random.Random(11)
    total = 0
    for _ in range(1500):
        words = babble(rng)
        want = brute_runs(words)
        assert periodic.runs(words) == want
        total += len(want)
    assert total > 1000


def test_runs_of_long_and_fixed_texts():
    a, b = ["a"], ["a", "b"]
    while len(b) < 3000:
        a, b = b, b + a
    assert periodic.runs(b) == brute_runs(b) and periodic.runs(b)
    assert periodic.runs(["a"] * 100_000) == [(0, 100_000, 1)]
    assert periodic.runs(["a"] * 23) == [] and periodic.runs(["a"] * 24) == [(0, 24, 1)]
    eight = [str(k) for k in range(8)]
    assert periodic.runs(["x", *eight * 3, "y"]) == [(1, 24, 8)] and periodic.runs(eight * 2 + eight[:7]) == []


def test_grammar_derives_its_text():
    rng = random.Random(3)
    for _ in range(200):
        words = babble(rng)
        ids = [int(w[1:]) for w in words]
        if len(ids) < 2:
            continue
        rules, start = periodic.re_pair(ids, 1000)
        parts = {}
        for k, (left, right, at) in enumerate(rules):
            parts[1000 + k] = parts.get(left, [left]) + parts.get(right, [right])
            assert ids[at:at + len(parts[1000 + k])] == parts[1000 + k]
        assert sum((parts.get(s, [s]) for s, _ in start), []) == ids
        pairs = collections.Counter(zip([s for s, _ in start], [s for s, _ in start][1:], strict=False))
        assert all(n == 1 or a == b for (a, b), n in pairs.items())


def changed(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc).encode())
    g = h // 10
    if doc is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def brute_op13(doc, text):
    words = changed(doc, text)
    found = brute_runs(words)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (doc, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_op13_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs = [(d, t) for d, t in docs if len(t or "") < 40_000]
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    for d, t in docs:
        assert got[d] == brute_op13(d, t)
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_runs_of_nulls_and_repeated_rows(spark):
    rows = [(None, "a " * 40), (None, None), (2**60 + 1, "b\tb\n" * 20), (3, ""), (3, ""), (4, " \n "), (5, "  x")]
    df = spark.createDataFrame([(d, t, "q", 1) for d, t in rows], "doc_id long, text string, runs string, n_words int")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed)
                  for r in periodic.with_runs(df).collect()), key=str)
    assert got == sorted([(None, 40, [(0, 40, 1)], (0, 40, 1), "a"), (None, 0, [], None, ""),
                          (2**60 + 1, 40, [(0, 40, 1)], (0, 40, 1), "b"), (3, 0, [], None, ""), (3, 0, [], None, ""),
                          (4, 0, [], None, ""), (5, 2, [], None, "  x")], key=str)
    assert periodic.with_runs(df.where("false")).count() == 0
    assert sorted(r.text or "" for r in periodic.with_repeats(df).collect()) == sorted(
        " ".join(changed(d, t)) if d is not None and t and zlib.crc32(str(d).encode()) % 10 == 0 and t.split() else t or "" for d, t in rows)


def test_slices_hold_all_rows_in_order():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"x": list(range(50)), "t": ["y" * (k * 10) for k in range(50)]})
    parts = list(slices(batch, 1000))
    assert sum((p.column(0).to_pylist() for p in parts), []) == list(range(50))
    assert all(p.nbytes <= 1000 or p.num_rows == 1 for p in parts)


def test_a_worker_lets_go_of_what_other_operators_kept():
    from ledgerloom.llm import common
    gone = []
    common.keep_in_worker("a", lambda: gone.append("a"))
    common.keep_in_worker("a", lambda: gone.append("a"))
    assert gone == []
    common.keep_in_worker("b")
    assert gone == ["a"]
    common.keep_in_worker("a", lambda: gone.append("again"))
    assert gone == ["a"]
    common._kept.clear()
