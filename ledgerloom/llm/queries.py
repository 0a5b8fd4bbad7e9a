"""The queries of the training-data operators over the shared tables, and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    chat,
    decontaminate,
    embeddings,
    html_extract,
    minhash,
    packing,
    periodic,
    prefix_trie,
    quality,
    secret_scan,
    toxicity,
    warc,
)
from ledgerloom.llm.common import discard, ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The vocabulary of the packing and encoding queries; a parameter of the operators.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Tools that the calls of ``conversations`` are checked against.
TOOLS = {"search": {"query": "string", "limit": "integer"}, "calculate": {"expression": "string"}}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token pieces, placed in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the training rows of ``labels``."""
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    judged = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost",
                         "base_failed", "kept")


_SPACED = "translate({}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')"
_PLAIN_LINE = ("trim(translate(regexp_replace(" + _SPACED.format("x") + ", ' +', ' ', 'g'), "
               "'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'))")
ORACLE["op7_quality_rules"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
own AS (SELECT r, list_filter(string_split({_SPACED.format('t')}, ' '), lambda x: x <> '') AS ws FROM docs),
windows AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
            FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM own) x),
again AS (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM windows
          QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
repeats AS (SELECT r, count(DISTINCT i) AS n FROM again GROUP BY r),
lines AS (SELECT r, source, k, x, {_PLAIN_LINE} AS y,
                 len(list_filter(string_split({_SPACED.format('x')}, ' '), lambda z: z <> '')) AS words
          FROM (SELECT r, source, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS k
                FROM docs) p),
doubles AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM lines WHERE y <> '' GROUP BY r),
content AS (SELECT r, source, list(y ORDER BY first) AS ys
            FROM (SELECT r, source, y, min(k) AS first FROM lines WHERE y <> '' GROUP BY 1, 2, 3) f GROUP BY 1, 2),
alone AS (SELECT DISTINCT d.source, coalesce(c.ys, []) AS ys FROM docs d LEFT JOIN content c USING (r)),
sizes AS (SELECT source, count(*) AS n FROM alone GROUP BY 1),
above AS (SELECT l.source, l.y
          FROM (SELECT source, y, count(*) AS n FROM (SELECT source, unnest(ys) AS y FROM alone) u GROUP BY 1, 2) l
          JOIN sizes s ON l.source IS NOT DISTINCT FROM s.source
          WHERE l.n > {quality.LINE_DOCS} AND l.n * 1000 > s.n * {quality.LINE_PER_MILLE}),
lost AS (SELECT r, sum(words) AS n FROM lines l JOIN above a ON l.source IS NOT DISTINCT FROM a.source AND l.y = a.y GROUP BY r),
counts AS (SELECT doc_id, len(ws) AS n_words, list_sum(list_transform(ws, lambda x: length(x))) AS chars,
                  length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS n_symbols, doubles.n AS doubled,
                  repeats.n AS repeated, lost.n AS gone
           FROM docs JOIN own USING (r) LEFT JOIN doubles USING (r) LEFT JOIN repeats USING (r) LEFT JOIN lost USING (r)),
judged AS (SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars,
                  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(coalesce(doubled, 0) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(repeated, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_lost FROM counts)
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words)
       AND NOT (n_lost > 0 AND (n_words - n_lost < {quality.MIN_WORDS}
                                OR 100 * (n_words - n_lost) < {quality.MIN_KEPT_PERCENT} * n_words)) AS kept
FROM judged"""


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secret_scan.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                        F.sha2(secret_scan.written(F.col("base_spans")), 256).alias("base_sha256"),
                        secret_scan.written(F.col("all_spans")).alias("spans"))


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of every page, read back from the archives written of them."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "url_key", "captured")


@query
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, tool call and tool result in canonical JSON, in topological order; tool use is derived from the turns."""
    tools = chat.tool_schemas(spark, TOOLS, {"search": ["query"]})
    return chat.documents(chat.with_tool_use(table(spark, sf_dir, "conversations")), tools)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    rows = prefix_trie.rebuilt(table(spark, sf_dir, "conversations"))
    found = prefix_trie.trie(rows)
    discard(rows)
    return found


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What benchmark items leave in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of them with a repeated tail."""
    found = periodic.with_runs(periodic.with_repeats(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    best = F.col("strongest")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
                        best["length"].alias("length"), best["period"].alias("period"),
                        F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
