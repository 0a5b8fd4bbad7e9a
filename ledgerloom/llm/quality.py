"""Quality rules: word counts of a text, and lines that many documents of a host share.

All of it is DataFrame expressions.

Base rules look at one text: its words (runs of characters other than ASCII
white space), symbols, lines equal to an earlier line, and words inside
three-word windows that occur more than once.  A text with fewer than
``MIN_WORDS`` words, or with more than ``REPEAT_PERCENT`` percent of its words
in repeated windows, fails.

The method looks across documents: lines are normalised (A-Z lower-cased,
white space runs to one space, digits to 0) and hashed, and for every host and
line the distinct documents are counted.  Documents with the same lines are
one document in this count, so a text is not held against itself for having
been copied.  A line is above its limit when more than ``LINE_DOCS`` documents of
the host have it, however large the host is; ``LINE_PER_MILLE`` thousandths of
the host's documents can be asked for besides (0: no share is asked for).
Such lines are removed; a document left with fewer than ``MIN_KEPT_PERCENT``
percent of its words, or with fewer than ``MIN_WORDS`` of them, is depleted
and rejected.

Null and empty texts have no words and fail.  A null host is a host of its
own.  Rows that repeat a doc_id are judged alike, each on its own text.  An
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, made_from, stored

#: Fixed values of the base rules.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50

LINE_DOCS = 20
LINE_PER_MILLE = 0
MIN_KEPT_PERCENT = 30


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    plain = F.translate(text, SPACES, " " * len(SPACES))
    return F.array_remove(F.split(plain, " "), "")


def lines(text: Column) -> Column:
    """The text's lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)


def repeated_words(own: Column) -> Column:
    """Number of words inside three-word windows that occur more than once, the first occurrence included.

    Windows are sorted by hash, so equal ones stand side by side; the starts
    of those that have an equal neighbour, in text order, cover three words
    each, less what the next one covers too.
    """
    n = F.size(own)
    windows = let(own, lambda w: F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))
    at = lambda s, i, f: F.get(s, i).getField(f)
    equal = lambda s, i, j: F.coalesce(at(s, i, "h") == at(s, j, "h"), F.lit(False))
    # transform() leaves the place of windows with an equal neighbour, and null elsewhere.
    starts = let(F.sort_array(windows), lambda s: F.transform(
        s, lambda x, j: F.when(equal(s, j, j + 1) | equal(s, j, j - 1), x.getField("i"))))
    starts = F.sort_array(F.filter(starts, lambda i: i.isNotNull()))
    covered = let(starts, lambda p: F.aggregate(
        p, F.struct(F.lit(0).alias("sum"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["sum"] + F.least(F.lit(3), i - a["last"])).alias("sum"), i.alias("last")),
        lambda a: a["sum"]))
    return F.when(n >= 4, covered).otherwise(0).cast("long")


def base(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce("text", F.lit(""))
    own = docs.withColumn("_words", words(text)).withColumn("_lines", lines(text))
    with_counts = own.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return with_counts.withColumn("base_failed", failed)


def normal_line(line: Column) -> Column:
    plain = F.regexp_replace(F.translate(line, SPACES, " " * len(SPACES)), " +", " ")
    lower = F.translate(plain, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    return F.trim(lower)


def line_hashes(text: Column) -> Column:
    """Hashes of the normalised lines, in order; null for lines without a word."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: let(
        normal_line(x), lambda y: F.when(y != "", F.xxhash64(y))))


def line_table(docs: DataFrame) -> DataFrame:
    """(host, text_hash, own): hash and number of words of every line with a word, once for equal texts of a host."""
    parts = F.arrays_zip(F.split(F.coalesce("text", F.lit("")), "\n").alias("line"), line_hashes(F.col("text")).alias("hash"))
    own = F.transform(F.filter(parts, lambda x: x["hash"].isNotNull()),
                      lambda x: F.struct(x["hash"].alias("hash"), F.size(words(x["line"])).alias("n")))
    return docs.select(F.col("source").alias("host"), F.xxhash64("text").alias("text_hash"), own.alias("own")).dropDuplicates(
        ["host", "text_hash"])


def common_lines(own: DataFrame, docs_limit: int = LINE_DOCS, per_mille: int = LINE_PER_MILLE) -> DataFrame:
    """(host, line): the lines above their limit in a host; ``own`` is a ``line_table``.

    A document counts by the hash of its distinct lines, which the rows of
    equal documents share: (host, line, document) is made distinct, and its
    counts are partial aggregates, so that neither a hot host nor a line that
    everyone has is gathered in one place.
    """
    unique = (own.select("host", F.array_distinct("own.hash").alias("own")).withColumn("doc", F.xxhash64("own"))
              .dropDuplicates(["host", "doc"]))
    counted = (unique.select("host", F.explode("own").alias("line")).groupBy("host", "line")
               .agg(F.count("*").alias("n")).where(F.col("n") > docs_limit))
    if not per_mille:
        return counted.select("host", "line")
    sizes = unique.groupBy("host").agg(F.count("*").alias("n_docs"))
    same = F.expr("counted.host <=> sizes.host")
    return (counted.alias("counted").join(sizes.alias("sizes"), same)
            .where(F.col("n") * 1000 > F.col("n_docs") * per_mille).select("counted.host", "line"))


def judged(docs: DataFrame, docs_limit: int = LINE_DOCS, per_mille: int = LINE_PER_MILLE) -> DataFrame:
    """docs with the base columns, ``n_lost`` (words in removed lines), ``kept`` and ``common`` (their hashes).

    The number of a host's lines above the limit grows with the host, so they
    are joined to the lines of its texts, and what a text loses to the text:
    ``common`` holds lines of the document itself only.
    """
    own = stored(line_table(docs), "texts")
    above = stored(common_lines(own, docs_limit, per_mille), "lines")
    lost = (own.select("host", "text_hash", F.explode("own").alias("x")).alias("o")
            .join(above.alias("a"), F.expr("o.host <=> a.host and o.x.hash = a.line"))
            .groupBy("o.host", "text_hash").agg(F.sum("x.n").alias("n_lost"), F.array_sort(F.collect_set("line")).alias("common")))
    lost = stored(lost, "lost")
    discard(own, above)
    found = base(docs).withColumn("_hash", F.xxhash64("text")).alias("d")
    found = found.join(lost.alias("l"), F.expr("d.source <=> l.host and d._hash = l.text_hash"), "left").drop("host", "text_hash", "_hash")
    found = found.withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
    found = found.withColumn("n_lost", F.coalesce("n_lost", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("n_lost")
    depleted = (F.col("n_lost") > 0) & ((left < MIN_WORDS) | (100 * left < MIN_KEPT_PERCENT * F.col("n_words")))
    return made_from(found.withColumn("kept", ~F.col("base_failed") & ~depleted), lost)


def without_common_lines(text: Column, common: Column) -> Column:
    """The text without the lines whose hash is in ``common``."""
    parts = F.arrays_zip(F.split(text, "\n").alias("line"), line_hashes(text).alias("hash"))
    stay = F.filter(parts, lambda x: ~F.coalesce(F.array_contains(common, x["hash"]), F.lit(False)))
    return F.array_join(F.transform(stay, lambda x: x["line"]), "\n")
