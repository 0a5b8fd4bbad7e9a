"""Raw readers (IO1-IO6) and the bronze -> silver conversion.

Layout under one root folder (the reference's volume layout):

* JSON folders: coa_hierarchy, third_parties, customers, suppliers,
  employees, outbound_contracts, inbound_contracts
* CSV with header, one sub-folder per month (any names):
  revenue_transactions, purchase_orders - read with recursive file lookup
* CSV with header, Hive-partitioned ``invoice_year=/invoice_month=``:
  revenue_billings, spend_invoices - read with partition discovery, so a
  filter on the partition columns prunes whole folders

Every read passes an explicit schema (no inference pass over the data).
``RawFiles`` exposes the same attributes as ``fixtures.Fixtures`` so a
``Lakehouse`` can run on either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import epoch_to_date
from ledgerloom.functions.money import MONEY
from ledgerloom.sources import schemas

JSON_FOLDERS = {"coa": "coa_hierarchy", "third_parties": "third_parties", "customers": "customers",
                "suppliers": "suppliers", "employees": "employees", "outbound_contracts": "outbound_contracts",
                "inbound_contracts": "inbound_contracts"}
MONTH_FOLDERS = {"revenue_transactions": "revenue_transactions", "purchase_orders": "purchase_orders"}
FOLDER_COLS = ["invoice_year", "invoice_month"]
PARTITIONED_FOLDERS = {"revenue_billings": "revenue_billings", "spend_invoices": "spend_invoices"}


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """IO1: JSON folder scan with an explicit schema."""
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema, recursive: bool = False) -> DataFrame:
    """IO2: CSV with header and explicit schema; ``recursive`` for non-Hive month folders."""
    reader = spark.read.schema(schema).option("header", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """IO3: CSV with type inference (an extra pass over the data; kept for
    parity with the reference's purchase-order read, avoid at scale)."""
    return (spark.read.option("header", "true").option("inferSchema", "true")
            .option("recursiveFileLookup", "true").csv(path))


def read_csv_glob(spark: SparkSession, pattern: str, casts: dict[str, str]) -> DataFrame:
    """IO4: CSV by glob, all strings, then explicit casts."""
    df = spark.read.option("header", "true").csv(pattern)
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """IO5: catalog table scan."""
    return spark.table(name)


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """IO6: inline rows as a DataFrame (bounded reference data only)."""
    return spark.createDataFrame(rows, schema)


def to_silver(df: DataFrame, source: str) -> DataFrame:
    """Epoch seconds -> DateType (UTC), double money -> DECIMAL(18,2)."""
    epochs = set(schemas.EPOCH_COLS.get(source, []))
    money = set(schemas.MONEY_COLS.get(source, []))
    cols = []
    for c in df.columns:
        if c in epochs:
            cols.append(epoch_to_date(c).alias(c))
        elif c in money:
            cols.append(F.round(F.col(c), 2).cast(MONEY).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


class RawFiles:
    """Silver-typed inputs read from the raw folder layout under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def bronze(self, source: str) -> DataFrame:
        schema = schemas.SCHEMAS[source]
        if source in JSON_FOLDERS:
            return read_json(self.spark, f"{self.root}/{JSON_FOLDERS[source]}", schema)
        if source in MONTH_FOLDERS:
            return read_csv(self.spark, f"{self.root}/{MONTH_FOLDERS[source]}", schema, recursive=True)
        return read_csv(self.spark, f"{self.root}/{PARTITIONED_FOLDERS[source]}", schema)

    def silver(self, source: str) -> DataFrame:
        df = to_silver(self.bronze(source), source)
        if source == "outbound_contracts":
            df = df.drop("project_id")
        if source in PARTITIONED_FOLDERS:
            # The folder columns stay as they are, so a filter on them prunes folders.
            df = df.select(*[c for c in df.columns if c not in FOLDER_COLS],
                           *[F.col(c).cast("long").alias(c) for c in FOLDER_COLS])
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name in schemas.SCHEMAS:
            return self.silver(name)
        raise AttributeError(name)
