"""Sinks (IO7-IO15): raw-layout writers, table materialisation, views.

``materialize`` writes a product as parquet under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``) or a given base path and reads
it back: downstream steps then start from stored files, so a lost executor
never forces recomputation of the whole upstream lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import date_to_epoch, epoch_to_date
from ledgerloom.session import ensure_checkpoint_dir
from ledgerloom.sources import readers, schemas


def shared_folder(spark: SparkSession, *parts: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def has_files(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def materialize(df: DataFrame, spark: SparkSession, name: str, base: str | None = None,
                partition_by: list[str] | None = None) -> DataFrame:
    """IO10: overwrite ``name`` as parquet and return a DataFrame reading it."""
    path = f"{base.rstrip('/')}/{name}" if base else shared_folder(spark, "tables", name)
    if partition_by:
        gathered(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def gathered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows dealt by folder of ``columns``, a large folder to as many tasks as its bytes ask for.

    Without this every task writes into every folder (tasks x folders files).
    The rebalance leaves sizes to adaptive execution: it splits a folder above
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` by bytes, and lets one
    task write several small ones, so files follow the data at any size.
    """
    return df.hint("rebalance", *columns)


def clustered(df: DataFrame, by: list[str]) -> DataFrame:
    """SL2: rows range-partitioned and sorted by ``by``, so that files and row groups hold narrow ranges.

    The minimum and maximum of every row group then let a filter on the leading
    columns skip nearly all of them.  With more columns than the leading one a
    value that most rows share is still spread over many tasks.
    """
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def write_clustered(df: DataFrame, path: str, by: list[str]) -> DataFrame:
    """Writes ``df`` clustered by ``by`` and returns a DataFrame reading it."""
    clustered(df, by).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_clustered_folders(dealt: DataFrame, path: str, folder: str, by: str) -> DataFrame:
    """SL2 for rows that are range-partitioned by ``by`` already: a folder per value of ``folder`` (few), sorted by ``by``.

    A filter on ``folder`` reads its folder alone, and each file there holds the
    narrow range of ``by`` of the task that wrote it.
    """
    dealt.sortWithinPartitions(folder, by).write.mode("overwrite").option("compression", "zstd").partitionBy(folder).parquet(path)
    return dealt.sparkSession.read.schema(dealt.schema).parquet(path).select(*dealt.columns)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str, comment: str | None = None) -> DataFrame:
    """IO10: a catalog table of ``buckets`` files, hashed and sorted by ``key``, stored at ``path``.

    Tables bucketed alike by their join key are joined without an exchange of
    either.  Rows are dealt by the bucket's own hash first, so a bucket is one file.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    if comment is not None:
        comment_table(df.sparkSession, name, comment)
    return readers.read_table(df.sparkSession, name)


def write_json_single(df: DataFrame, path: str) -> None:
    """IO7: one JSON file (``coalesce(1)``): only for the account hierarchy, which does not grow with the data."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_json(df: DataFrame, path: str) -> None:
    """IO7: JSON lines, a file per task."""
    df.write.mode("overwrite").json(path)


def write_csv_by_month(df: DataFrame, path: str, date, month_col: str = "month") -> None:
    """IO8: CSV with header, one folder per month (``partitionBy`` instead of a driver loop).

    ``date`` is a column name or Column giving each row's date.
    """
    d = F.col(date) if isinstance(date, str) else date
    (gathered(df.withColumn(month_col, F.date_format(d, "yyyy_MM")), [month_col])
     .write.mode("overwrite").option("header", "true").partitionBy(month_col).csv(path))


def write_csv_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """IO9: CSV with header, Hive-partitioned by ``columns``."""
    gathered(df, columns).write.mode("overwrite").option("header", "true").partitionBy(*columns).csv(path)


def use_database(spark: SparkSession, name: str) -> None:
    """IO11: create (if needed) and select a database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def register_view(df: DataFrame, name: str) -> None:
    """IO12: expose a product or metric-view query to SQL."""
    df.createOrReplaceTempView(name)


def preview(df: DataFrame, order_by: list[str], n: int = 20) -> DataFrame:
    """IO13: a stable preview (ordered limit; a plain limit is not deterministic)."""
    return df.orderBy(*order_by).limit(n)


def with_comment(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """IO15: column comments as parquet/Spark field metadata."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
                       for c in df.columns])


def comment_table(spark: SparkSession, name: str, comment: str) -> None:
    """IO15: a comment on a catalog table, shown by ``DESCRIBE EXTENDED``."""
    quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")


# -- raw layout writers (the reference's bronze files, from silver frames) ---------
def to_bronze(df: DataFrame, source: str) -> DataFrame:
    """Silver -> raw typing: dates as epoch seconds (UTC), money as double."""
    epochs = set(schemas.EPOCH_COLS.get(source, []))
    money = set(schemas.MONEY_COLS.get(source, []))
    cols = []
    for c in df.columns:
        if c in epochs:
            cols.append(date_to_epoch(c).alias(c))
        elif c in money:
            cols.append(F.col(c).cast("double").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def write_raw(df: DataFrame, root: str, source: str) -> None:
    """Write one silver frame in the reference's raw folder layout under ``root``."""
    bronze = to_bronze(df, source)
    if source in readers.JSON_FOLDERS:
        write = write_json_single if source == "coa" else write_json
        write(bronze, f"{root}/{readers.JSON_FOLDERS[source]}")
    elif source in readers.MONTH_FOLDERS:
        date_col = "transaction_date" if source == "revenue_transactions" else "purchase_order_date"
        write_csv_by_month(bronze, f"{root}/{readers.MONTH_FOLDERS[source]}",
                           epoch_to_date(date_col))
    else:
        d = epoch_to_date("invoice_date")
        write_csv_partitioned(bronze.drop("invoice_year", "invoice_month")
                              .withColumn("invoice_year", F.year(d)).withColumn("invoice_month", F.month(d)),
                              f"{root}/{readers.PARTITIONED_FOLDERS[source]}", ["invoice_year", "invoice_month"])


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return shared_folder(spark, f"{label}-{uuid.uuid4().hex[:12]}")
