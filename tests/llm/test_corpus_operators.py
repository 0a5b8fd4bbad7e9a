"""Near-duplicates, toxicity, archives, chat, extraction, embeddings and the pipeline on small tables."""

import base64
import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import chat, common, embeddings, html_extract, minhash, quality, secret_scan, toxicity, warc
from ledgerloom.llm.queries import QUERIES, TOOLS

SF = "/root/testdata/sf0.001"


def reach(nodes, links):
    """Smallest node that each node reaches."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


# -- components --------------------------------------------------------------
@pytest.mark.parametrize("links", [
    [], [(1, 1), (2, None)], [(1, 2), (2, 1)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 60)],
    [(5, 9), (9, 2), (30, 31), (31, 7), (7, 2)]])
def test_components(spark, links):
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == reach({n for x in real for n in x}, real)


# -- MinHash -----------------------------------------------------------------
def shingle_sets(texts):
    out = {}
    for k, t in texts.items():
        own = (t or "").encode().lower().split()
        out[k] = {tuple(own[j:j + 5]) for j in range(max(1, len(own) - 4))} if own else set()
    return out


def brute_components(texts):
    sets = shingle_sets(texts)
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return reach(ids, links), {k: len(s) for k, s in sets.items()}


def near_copies(seed):
    """Groups around a text: chains whose ends do not link, boundary pairs, copies, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 400))
    base = [word() for _ in range(80)]
    out = []
    for step in range(14):                                    # a chain
        base = base[:6 * step % 70] + [word()] + base[6 * step % 70 + 1:]
        out.append(" ".join(base))
    passage = [word() for _ in range(30)]
    out += [" ".join([word() for _ in range(rng.randint(2, 14))] + passage + [word() for _ in range(rng.randint(2, 14))])
            for _ in range(40)]
    out += [" ".join(base)] * 5 + [" ".join(base).upper(), "Two words", "two  WORDS\n", "", " \n", None, "é" * 3]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_by_brute_force(spark, seed):
    texts = dict(enumerate(near_copies(seed)))
    docs = spark.createDataFrame([(k, t, 0, "x") for k, t in texts.items()], "doc_id long, text string, rep int, sig string")
    of, sizes = brute_components(texts)
    rows = minhash.near_duplicates(docs.repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        k: (sizes[k], of[k], of[k] == k) for k in texts}


def test_near_duplicates_of_nulls_and_repeated_ids(spark):
    long = " ".join(f"w{k}" for k in range(50))
    other = " ".join(f"v{k}" for k in range(50))
    rows = [(None, long), (7, long), (3, long), (3, other), (9, other), (2**60 + 1, "alone here"), (4, "x"), (4, "x")]
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in
                 minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(-1, None, True), (7, 3, False), (3, 3, True), (3, 3, True), (9, 3, False),
                          (2**60 + 1, 2**60 + 1, True), (4, 4, True), (4, 4, True)])
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, 400, np.int64).astype(np.uint64)) for _ in range(2)]
    half = np.unique(np.concatenate([sets[0][:200], sets[1][:200]]))
    docs = spark.createDataFrame([(1, " ".join(map(str, range(500)))), (2, " ".join(map(str, range(1000, 1500)))),
                                  (3, " ".join(map(str, range(250, 750))))], "doc_id long, text string")
    sig = minhash.signatures(docs).select("doc_id", "sig")
    pairs = sig.toDF("a", "x").crossJoin(sig.toDF("b", "y")).select("a", "b", minhash.estimate(F.col("x"), F.col("y")).alias("e"))
    got = {(r.a, r.b): r.e for r in pairs.collect()}
    assert got[1, 1] == pytest.approx(1) and abs(got[1, 2]) < 0.15 and abs(got[1, 3] - 1 / 3) < 0.17
    assert 0.5 < minhash.likely() < 0.75 and len(half)


def test_op1_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    of, sizes = brute_components(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_minhash_near_dedup"](spark, SF).collect()} == {
        k: (sizes[k], of[k]) for k in texts}


# -- toxicity ----------------------------------------------------------------
def labelled_corpus(n=400):
    rng = random.Random(4)
    syllables = ["ba", "de", "lo", "mi", "ru", "ta", "ne", "so"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    rows = []
    for k in range(n):
        own = [word() for _ in range(rng.randint(20, 120))]
        toxic = int(k % 4 == 0)
        for _ in range(len(own) // 12 if toxic else 0):
            own[rng.randrange(len(own))] = "kvex" + rng.choice(syllables)
        rows.append((k, " ".join(own), toxic))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = labelled_corpus()
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(None, None), (5000, ""), (5001, "kvexba kvexlo kvexta")],
                                 "doc_id long, text string").withColumn("toxic", F.lit("clash"))
    # Labels of held-out rows are turned round: a score that knew them would show it.
    import zlib
    out = {k: zlib.crc32(str(k).encode()) % 5 == 0 for k, _, _ in rows}
    labels = spark.createDataFrame([(k, 1 - y if out[k] else y) for k, _, y in rows] + [(1, None), (None, 1)],
                                   "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    assert len(got) == len(rows) + 3
    held = [(got[k].predicted, y) for k, _, y in rows if out[k]]
    assert all(got[k].held_out == out[k] for k in out)
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert 0 <= got[None].score <= 1 and got[5000].predicted == 0 and got[5001].predicted == 1
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())


def exact_evidence(texts, training):
    """Evidence per word of each text, by exact counts of the (text, toxic) rows of ``training``."""
    padded = lambda w: "\x02" * 5 + w + "\x03"
    grams = lambda w: [padded(w)[k:k + 6] for k in range(len(w) + 1)]
    top = [collections.Counter(), collections.Counter()]
    for text, toxic in training:
        for w in text.lower().split():
            top[1 - toxic].update(grams(w))
    both, lower = top[0] + top[1], {}
    longer = both
    for order in range(5, 0, -1):
        lower[order] = longer = collections.Counter(g[1:] for g in longer)
    discount = lambda n: (lambda one, two: one / (one + 2 * two) if one and two else 0.5)(
        sum(v == 1 for v in n), sum(v == 2 for v in n))
    d = [discount(top[0].values()), discount(top[1].values()), discount([v for c in lower.values() for v in c.values()])]

    def contexts(counts):
        total, kinds = collections.Counter(), collections.Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        return total, kinds

    of_lower, of_top, of_both = {k: contexts(c) for k, c in lower.items()}, [contexts(c) for c in top], contexts(both)

    def share(counts, around, g, discount, below, worth):
        total, kinds = around[0][g[:-1]], around[1][g[:-1]]
        if not total + worth:
            return below
        return min(1, (max(counts[g] - discount, 0) + (min(discount * kinds, total) + worth) * below) / (total + worth))

    def value(g):
        p = 1 / 256
        for order in range(1, 6):
            p = share(lower[order], of_lower[order], g[6 - order:], d[2], p, 0)
        p = share(both, of_both, g, d[2], p, 0)
        return np.log(share(top[0], of_top[0], g, d[0], p, 40.0)) - np.log(share(top[1], of_top[1], g, d[1], p, 40.0))

    return [sum(value(g) for w in t.lower().split() for g in grams(w)) / max(1, len(t.split())) for t in texts]


def test_toxicity_counts_are_exact(spark, monkeypatch):
    """With thousands of different expressions, any fold of the counts would show in some text."""
    import zlib
    rng = random.Random(8)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
    rows = [(k, " ".join(word("abcdefghijklmnopqrstuvwxyz" if k % 3 else "äöüabcdefghi") for _ in range(40)), int(k % 3 == 0))
            for k in range(300)]
    training = [(t, y) for k, t, y in rows if zlib.crc32(str(k).encode()) % 5]
    # This curve makes the score the evidence's own.
    monkeypatch.setattr(toxicity, "fit_curve", lambda bins: (1.0, 0.0, 0.0))
    got = {r.doc_id: np.log(r.score / (1 - r.score)) for r in toxicity.scores(
        spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string"),
        spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")).collect()}
    want = exact_evidence([t for _, t, _ in rows], training)
    assert max(abs(got[k] - want[k]) for k in range(300)) < 1e-9


def test_toxicity_without_a_class(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.scores(docs, labels).collect()} == {(0.0, 0)}
    assert toxicity.scores(docs.limit(0), labels.limit(0)).count() == 0


# -- archives ----------------------------------------------------------------
def expected_captures(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        of = first.get(html or "", page_id)
        out.append((page_id, url, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if page_id == of else "revisit", None if page_id == of else of))
    return sorted(out, key=str)


def captures(df):
    return [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()]


def test_archives_round_trip(spark):
    fake = "WARC/1.1\r\nContent-Length: 3\r\n\r\nfoo\r\n\r\n"
    rows = [(5, "http://a.com/x y%20\r\n", fake), (3, None, fake), (7, "http://www.b.org:8080/?b=2&a=1", None),
            (8, "http://[bad", ""), (9, "ü.de/ä", None), (None, "q", "x"), (11, "q", "x"), (3, None, fake),
            (2**60 + 3, " http://a.com/x ", "日本" * 3000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, run string").repartition(3)
    index = warc.round_trip(pages)
    assert sorted(captures(index), key=str) == expected_captures(rows)
    order = [(r.url_key, r.captured, r.page_id or -1) for r in index.collect()]
    assert order == sorted(order)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    assert sorted((r[0], r[4]) for r in captures(warc.round_trip(pages, least=3))) == [
        (1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(0)
    for n in range(12):
        runs = [sorted((rng.randint(0, 9), k) for k in range(rng.randint(0, 7))) for _ in range(n)]
        merged = list(warc.LoserTree([iter(r) for r in runs], lambda x: x))
        assert merged == sorted(x for r in runs for x in r)


def test_damaged_archives_are_noticed():
    good = warc.record_text(1, "u", "abc", None, 3, warc.digest(b"abc")) + "\r\n\r\n"
    assert len(warc._captures("a", good.encode())) == 1
    for bad in (good.replace("abc", "abd"), good.replace("Content-Length: 3", "Content-Length: 2"), "x" + good):
        with pytest.raises(ValueError):
            warc._captures("a", bad.encode())


def test_op5_equals_brute_force(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted(captures(QUERIES["op5_warc_round_trip"](spark, SF)), key=str) == expected_captures(rows)


# -- chat --------------------------------------------------------------------
def test_calls_are_linked_checked_and_ordered(spark):
    rows = [(1, 0, "user", 'hi "x"'),
            (1, 1, "assistant", '{"tool_calls":[{"id":"a","function":{"name":"search","arguments":"{\\"query\\":\\"q\\",\\"limit\\":3}"}},'
                                '{"id":"b","function":{"name":"calculate","arguments":{"z":1}}}]}'),
            (1, 2, "tool", '{"tool_call_id":"a","content":"res é"}'), (1, 3, "tool", '{"tool_call_id":"zz","content":{"b":1,"a":[1,2]}}'),
            (1, 4, "assistant", '{"name":"search","arguments":{"query":5},"id":"c"}'),
            (2, 0, "tool", '{"tool_call_id":"x","content":"early"}'), (2, 1, "assistant", '[{"id":"x","name":"nope","arguments":[]}]'),
            (2, 2, "tool", '{"tool_call_id":"x","content":"again"}'),
            (2, 3, "assistant", '{"tool_calls":[{"id":"x","name":"search","arguments":"no json"}]}'),
            (3, 0, "assistant", "{not json"), (3, 1, "assistant", '{"tool_calls":[]}'), (None, 0, None, None),
            (4, None, "assistant", '{"tool_calls":[{"name":"search","arguments":{"query":"q"}}]}'), (5, 0, "tool", "plain")]
    conversations = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, place int")
    out = chat.documents(conversations, chat.tool_schemas(spark, TOOLS, {"search": ["query"]})).collect()
    got = [(r.conv_id, r.turn, r.part, r.kind, r.link, r.status) for r in out]
    assert got == [
        (None, 0, 0, "message", None, None), (1, 0, 0, "message", None, None), (1, 1, 0, "call", "ok", "ok"),
        (1, 1, 1, "call", "open", "missing:expression"), (1, 2, 0, "result", "ok", None), (1, 3, 0, "result", "orphan", None),
        (1, 4, 0, "call", "open", "type:query"), (2, 1, 0, "call", "ok", "unknown tool"), (2, 0, 0, "result", "ok", None),
        (2, 2, 0, "result", "repeated", None), (2, 3, 0, "call", "repeated", "no object"), (3, 0, 0, "message", None, None),
        (3, 1, 0, "message", None, None), (4, None, 0, "call", "unnamed", "ok"), (5, 0, 0, "result", "unnamed", None)]
    json = [r.json for r in out]
    assert json[2] == ('{"call":{"function":{"arguments":{"limit":3,"query":"q"},"name":"search"},"id":"a","type":"function"},'
                       '"role":"assistant"}')
    assert json[5] == '{"content":"{\\"a\\":[1,2],\\"b\\":1}","role":"tool","tool_call_id":"zz"}'
    assert chat.documents(conversations.limit(0)).count() == 0


def test_op6_keeps_every_message(spark):
    source = spark.read.parquet(f"{SF}/conversations.parquet")
    got = QUERIES["op6_chat_format"](spark, SF)
    assert got.count() == source.count()
    back = got.select("conv_id", "turn", F.get_json_object("json", "$.content").alias("text"), F.get_json_object("json", "$.role").alias("role"))
    assert back.exceptAll(source.select("conv_id", "turn", "text", "role")).count() == 0


# -- extraction --------------------------------------------------------------
def test_tree_learns_its_table():
    x, y = html_extract.labelled_rows()
    assert (html_extract.decide(html_extract.trained(), x) == (y > 0)).mean() > 0.97


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("<script>var a='<p>x</p>'", ""), ("<!-- never closed <article>x", ""),
    ("<article><h1>A &amp; B&copy;</h1><p><b>one<br>two<p>three\n  four&nbsp;five</article>", "A & B©\n\none two\n\nthree four five"),
    ("<nav>Menu of the page</nav><article><p>Text.</p><aside>Side</aside><div class='comments'><p>long comment of a reader</p></div>"
     "<p>More.</p></article><footer>&copy; me</footer>", "Text.\n\nMore."),
    ("<article><header><h1>T</h1></header><form><p>mail?</p></form><p hidden>no</p><p>x", "T\n\nx"),
    ("<div class='ad'>Buy this now and get another one of it for free, today only and while we have any left.</div>", "")])
def test_main_text(html, text):
    assert html_extract.main_text(html, html_extract.trained()) == text


ARTICLE = "<article><h1>Title</h1><p>The text.</p></article>"
PROSE = "The harbour was built when the town had no more than forty houses and a chapel, and for long it was the only safe place."


@pytest.mark.parametrize("html, text", [
    (f"<script>var s='<!--';</script>{ARTICLE}", "Title\n\nThe text."),
    (f"<script><!-- hidden\nrun();\n</script>{ARTICLE}", "Title\n\nThe text."),
    (f"<p title='<!--'></p>{ARTICLE}", "Title\n\nThe text."),
    (f"<!-- note --!>{ARTICLE}", "Title\n\nThe text."), (f"<!-->{ARTICLE}", "Title\n\nThe text."),
    (f"{ARTICLE}<!-- never <p>closed", "Title\n\nThe text."),
    (f"<![if x]><!-- note -->{ARTICLE}<!-- never <p>closed", "Title\n\nThe text."),
    (f"<head><title>T</title><meta name=a><noscript><img src=a></noscript><style>p {{}}</style><h1>Title</h1><p>{PROSE}</p>",
     f"Title\n\n{PROSE}"),
    (f"<html><head><title>T</title><div>{PROSE}</div>", PROSE), (f"<head><title>T</title>\n{PROSE}", PROSE),
    (f"<head><title>a <b>bold</b> title</title></head><p>{PROSE}", PROSE)])
def test_nothing_is_lost_behind_comments_and_heads(html, text):
    assert html_extract.main_text(html, html_extract.trained()) == text


def test_op9_takes_the_articles(spark):
    import html
    import re
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op9_html_extraction"](spark, SF).collect():
        article = pages[r.page_id].split("<article>", 1)[1].split("</article>")[0]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_extract_passes_nulls(spark):
    pages = spark.createDataFrame([(None, None, None, "x"), (1, "u", "<article>a", "x"), (1, "u", "<article>a", "x")],
                                  "page_id long, url string, html string, text string")
    assert sorted(map(str, html_extract.extract(pages).collect())) == sorted(map(str, [
        ("Row(page_id=None, url=None, text='', n_chars=0)"), ("Row(page_id=1, url='u', text='a', n_chars=1)"),
        ("Row(page_id=1, url='u', text='a', n_chars=1)")]))


# -- embeddings --------------------------------------------------------------
def brute_links(rows):
    unit = embeddings.unit_vectors([v for _, v in rows])
    links = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None
             and len(unit[i]) == len(unit[j]) and float(np.dot(unit[i], unit[j])) >= 0.95]
    count = collections.Counter(k for x in links for k in x)
    of = reach(range(len(rows)), links)
    groups = collections.defaultdict(list)
    for k, top in of.items():
        groups[top].append(rows[k][0])
    return sorted((rows[k][0], count[k], min(groups[of[k]])) for k in range(len(rows)))


def test_embeddings_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for dims in (16, 48):
        centres = rng.normal(size=(12, dims))
        for c in centres:
            rows += [(len(rows) + k, (c + rng.normal(size=dims) * s).astype(float).tolist()) for k, s in enumerate([0, .05, .1, .2, .3])]
    n = len(rows)
    rows += [(n, rows[3][1]), (n + 1, [2 * x for x in rows[3][1]]), (n + 2, None), (n + 3, []), (n + 4, [0.0] * 16),
             (n + 5, [float("nan")] * 16), (n + 6, [float("inf")] + [1.0] * 15), (n + 7, [1e-300] * 16), (n + 8, [1e300] * 16)]
    vectors = spark.createDataFrame([(*r, 1) for r in rows] + [(n + 9, [None, 1.0], 1)], "vec_id long, embedding array<double>, class int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(vectors).collect())
    assert got == [*brute_links(rows), (n + 9, 0, n + 9)]
    assert embeddings.near_duplicates(vectors.limit(0)).count() == 0


def test_hashing_finds_close_vectors():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * noise          # pairs right at the threshold
    a, b = (embeddings.keys(v).reshape(len(v), -1) for v in (x, y))
    recall = np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b, strict=True)])
    assert recall >= 0.99


@pytest.mark.parametrize("dims", [2, 3, 16, 48, 300])
def test_outlines_and_bytes_bound_the_cosine(dims):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(400, dims))
    x[200:] = x[:200] + rng.normal(size=(200, dims)) * rng.choice([0.01, 0.1, 0.3], (200, 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cosines = x @ x.T
    held = embeddings.outline(x).view("<i2").astype(np.int64)
    assert (held @ held.T / embeddings.UNIT ** 2 >= cosines - 0.00012).all()
    held, step, off = embeddings.rounded(x)
    about = (held.astype(np.int64) @ held.T.astype(np.int64)) * step * step[:, None]
    assert (np.abs(about - cosines) <= off + off[:, None] + off * off[:, None] + 1e-9).all()


def test_unlike_vectors_of_a_bucket_are_no_candidates(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 64))
    x[300:310] = x[:10] + rng.normal(size=(10, 64)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    classes = embeddings.hashed(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, vec array<double>"))
    # One bucket holds all: nothing but the vectors themselves can tell the pairs apart.
    classes = classes.withColumn("keys", F.array(F.lit(1).cast("long"), F.lit(2).cast("long")))
    got = {(r.a, r.b) for r in embeddings.candidates(classes, 0.95).collect()}
    assert {(k, 300 + k) for k in range(10)} <= got
    assert len(got) < 0.01 * 600 * 599 / 2


# -- pipeline ----------------------------------------------------------------
@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    body = " ".join(f"word{k}" for k in range(80))
    rows += [(9001, f"{body} token = abcdef123456", "en", "s", 0), (9002, f"{body} token = abcdef123456", "en", "s", 0),
             (9002, f"{body} token = abcdef123456", "en", "s", 0), (None, None, None, None, None), (9003, "", None, "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn(
        "kept", F.lit("extra"))


def test_stages_keep_the_columns_and_do_their_work(spark, corpus):
    columns = corpus.columns
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["toxicity"](spark, corpus, SF)
    assert kept.columns == columns
    good = stages["quality rules"](spark, corpus, SF)
    assert good.columns == columns
    want = {r.doc_id for r in quality.judged(corpus.select("doc_id", "text", "source")).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == want and {9001, 9002} <= want and 9003 not in want
    one = stages["minhash near-dedup"](spark, good, SF)
    assert one.columns == columns
    of, _ = brute_components({r.doc_id: r.text for r in good.collect()})
    ids = [r.doc_id for r in one.collect()]
    assert sorted(ids) == sorted(k for k in of if of[k] == k) and 9001 in ids and 9002 not in ids
    clean = stages["secret scan"](spark, one, SF)
    assert clean.columns == columns
    text = {r.doc_id: r for r in clean.collect()}
    assert text[9001].text.endswith("word79 [secret]") and text[9001].n_chars == len(text[9001].text)
    assert secret_scan.scanned(clean.select("doc_id", "text")).where(F.size("base_spans") > 0).count() == 0
    packed = stages["best-fit packing"](spark, clean, SF)
    assert {r.doc_id for r in packed.collect()} == set(ids)


def test_toxicity_stage_removes_rows_by_their_own_text(spark, tmp_path):
    rows = labelled_corpus()
    toxic, clean = "kvexba kvexlo kvexta", rows[1][1]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(None, toxic), (None, clean), (None, None), (7000, toxic), (7000, clean)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/some/labels.parquet")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.without_toxic(spark, docs, f"{tmp_path}/some").collect()]
    assert {(None, clean), (None, None), (7000, clean)} <= set(kept) and toxic not in {t for _, t in kept}
    # Where either class has no training row, nothing can be called toxic.
    for name, few in (("clean", labels.where("toxic = 0")), ("toxic", labels.where("toxic = 1")), ("none", labels.limit(0))):
        few.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.without_toxic(spark, docs, f"{tmp_path}/{name}").count() == docs.count()


def test_pipeline_runs_end_to_end(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_stages_on_an_empty_table(spark, corpus):
    docs = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_dedup_stage_tells_texts_of_one_id_apart(spark):
    first, second = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(2**60 + 3, first, 1), (2**60 + 3, second, 2), (2**60 + 3, first, 3), (None, first, 4), (None, second + " end", 5),
            (7, " ".join(f"c{k}" for k in range(60)), 6), (None, None, 7), (None, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").repartition(3)
    kept = corpus_pipeline.one_of_each(spark, docs, SF)
    assert kept.columns == docs.columns
    texts = sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text)
    assert texts == sorted([(str(2**60 + 3), first), (str(2**60 + 3), second), ("7", rows[5][1])])


# -- large ids ----------------------------------------------------------------
BIG = [2**60 + 1, None, 2**60 + 3, 2**53 + 1, 0]


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.select(name).collect()), key=lambda x: (x is not None, x or 0))


def test_ids_above_a_double_beside_nulls(spark):
    """Every operator returns the ids it was given."""
    from ledgerloom.llm import bpe, packing
    from ledgerloom.llm.queries import VOCABULARY
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(60)) + " password = hunter22"
    docs = spark.createDataFrame([(d, text(k), "s") for k, d in enumerate(BIG)], "doc_id long, text string, source string").coalesce(1)
    want = sorted(BIG, key=lambda x: (x is not None, x or 0))
    labels = spark.createDataFrame([(d, k % 2) for k, d in enumerate(BIG)], "doc_id long, toxic int")
    for found in (minhash.near_duplicates(docs), toxicity.scores(docs, labels), packing.pack(docs, VOCABULARY),
                  bpe.round_trip_digests(docs, VOCABULARY), quality.judged(docs), secret_scan.scanned(docs.select("doc_id", "text"))):
        assert ids(found) == want
    pages = spark.createDataFrame([(d, "http://u", f"<p>{text(k % 3)}</p>") for k, d in enumerate(BIG)],
                                  "page_id long, url string, html string").coalesce(1)
    assert ids(warc.round_trip(pages), "page_id") == ids(html_extract.extract(pages), "page_id") == want
    # Equal pages: rows 0 and 3, and rows 1 (no id) and 4.
    assert {r.refers_to for r in warc.round_trip(pages).collect()} == {None, 0, 2**53 + 1}
    vectors = spark.createDataFrame([(d, [float(k), 1.0, 0.5, 2.0]) for k, d in enumerate(BIG)], "vec_id long, embedding array<double>")
    assert ids(embeddings.near_duplicates(vectors), "vec_id") == want
    talk = spark.createDataFrame([(d, 0, "user", "hi") for d in BIG], "conv_id long, turn long, role string, text string").coalesce(1)
    assert ids(chat.documents(talk, chat.tool_schemas(spark, TOOLS, {})), "conv_id") == want
