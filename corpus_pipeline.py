"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before it kept and returns the columns of
``documents`` (the last: pieces with their place in a sequence):

1. toxicity: documents that the models predict to be toxic go.
2. quality rules: documents that fail go; lines above their host's limit are
   taken out of the texts that stay.
3. MinHash near-dedup: one document of every near-duplicate group stays.
4. secret scan: secrets in the texts are replaced by a mark.
5. best-fit packing: texts become token pieces in sequences.

Where a stage changes a text, ``n_chars`` is counted anew.  ``run`` writes
every stage's result to the shared folder and reads it again.

Every stage decides by row.  Null and empty texts are not toxic and fail the
quality rules (they have too few words).  Rows that repeat a doc_id, or have
none, are documents of their own: a toxic one does not take others of its id
with it, and near-dedup keeps the row of smallest doc_id (null last; ties: the
smallest text) of each group, so of equal rows one stays, and different texts
of one id both stay.  Further columns are carried along under any name; an
empty table goes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import minhash, packing, quality, secret_scan, toxicity
from ledgerloom.llm.common import discard, ship, stored, table
from ledgerloom.llm.queries import VOCABULARY


def _with_row(docs: DataFrame, *names: str) -> DataFrame:
    """The whole row as one column, beside the columns that an operator reads."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *names)


def _rows(found: DataFrame, docs: DataFrame, text=None) -> DataFrame:
    """The rows again, with a new text where one is given."""
    changed = {} if text is None else {"text": text, "n_chars": F.char_length(text).cast("bigint")}
    return found.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    # A row goes by the score of its own text, whatever its doc_id.
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    scored = toxicity.scores(docs.select("doc_id", "text", digest.alias("digest")), table(spark, sf_dir, "labels"), "digest")
    toxic = stored(scored.where("predicted = 1").select("digest").distinct(), "toxic")
    discard(*scored.made_from)
    return docs.join(toxic, digest == toxic["digest"], "left_anti").select(*docs.columns)


def with_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.judged(_with_row(docs, "text", "source"))
    # The text is taken from the row, so that it travels to its common lines once.
    text = F.col("row")["text"]
    clean = F.when(F.size("common") > 0, quality.without_common_lines(text, F.col("common"))).otherwise(text)
    # Stored, as the filter of a later stage would pull the whole expression of the text into itself.
    found = stored(_rows(judged.where("kept"), docs, clean), "clean")
    discard(*judged.made_from)
    return found


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with ``row``, a number in order of doc_id (null last) and text."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    return stored(docs.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"), F.monotonically_increasing_id().alias("row")), "rows")


def _components(docs: DataFrame) -> DataFrame:
    found = minhash.near_duplicates(docs)
    out = stored(found, "components")
    discard(*found.made_from)
    return out


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        found = _components(docs)
        return docs.join(found.where("not kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    # Without an id of its own a row goes by its number, so that texts that share an id are told apart.
    rows = _numbered(docs)
    found = _components(rows.select(F.col("row").alias("doc_id"), F.col("whole.text").alias("text")))
    others = found.where("not kept").select(F.col("doc_id").alias("row"))
    return rows.join(others, "row", "left_anti").select(*(F.col("whole").getField(c).alias(c) for c in docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(_with_row(docs, "text"))
    return _rows(found, docs, secret_scan.redacted(F.col("text"), F.col("all_spans")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, VOCABULARY)


STAGES = [("toxicity", without_toxic), ("quality rules", with_quality), ("minhash near-dedup", one_of_each),
          ("secret scan", without_secrets), ("best-fit packing", packed)]

#: A trained model has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
