"""Checked reads of raw files: what converts goes on, the rest is kept with its reasons.

A plain read with a schema turns a field that does not convert into null, and
nobody learns of it.  Here every field is read as text, lines that do not parse
are kept whole, and each field is converted with ``try_cast``.  A row with a
line that does not parse, a field that does not convert or no key is rejected.
Both lanes come from one scan and are written side by side, so a load reads the
raw files once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from ledgerloom.sources import readers, schemas

#: Column that holds a line that does not parse.
LINE = "_line"
ACCEPTED, REJECTED = "accepted", "rejected"

# The key that a raw row cannot do without.
KEYS = {
    "coa": "coa_id", "third_parties": "third_party_id", "customers": "customer_id", "suppliers": "supplier_id",
    "employees": "employee_id", "outbound_contracts": "contract_id", "inbound_contracts": "contract_id",
    "revenue_transactions": "rev_trx_id", "revenue_billings": "billing_id", "purchase_orders": "purchase_order_id",
    "spend_invoices": "invoice_id",
}


def read_text_fields(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The raw fields of ``source`` as strings, and ``LINE`` where a line does not parse."""
    schema = StructType([*(StructField(f.name, StringType()) for f in schemas.SCHEMAS[source]), StructField(LINE, StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
    if source in readers.JSON_FOLDERS:
        return reader.json(f"{root}/{readers.JSON_FOLDERS[source]}")
    reader = reader.option("header", "true")
    if source in readers.MONTH_FOLDERS:
        return reader.option("recursiveFileLookup", "true").csv(f"{root}/{readers.MONTH_FOLDERS[source]}")
    return reader.csv(f"{root}/{readers.PARTITIONED_FOLDERS[source]}")


def _converted(field: StructField) -> Column:
    value = F.col(field.name).try_cast(field.dataType)
    if isinstance(field.dataType, DoubleType):
        # Money that is not finite is no amount.
        value = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    return value


def checked(fields: DataFrame, schema: StructType, key: str) -> DataFrame:
    """Typed columns of ``schema``, further columns as they are, ``reasons`` and the rejected row as ``line``.

    Reasons come in column order: ``line: does not parse``, ``<column>: not a
    <type>``, ``<key>: missing``.  A row without reasons is accepted and has no line.
    """
    reasons = [F.when(F.col(LINE).isNotNull(), F.lit("line: does not parse"))]
    for f in schema:
        reasons.append(F.when(F.col(f.name).isNotNull() & _converted(f).isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
        if f.name == key:
            reasons.append(F.when(F.col(f.name).isNull() & F.col(LINE).isNull(), F.lit(f"{f.name}: missing")))
    found = F.array_compact(F.array(*reasons))
    raw = F.coalesce(F.col(LINE), F.to_json(F.struct(*(F.col(f.name) for f in schema))))
    rest = [c for c in fields.columns if c not in schema.fieldNames() and c != LINE]
    return fields.select(*(_converted(f).alias(f.name) for f in schema), *rest, found.alias("reasons"),
                         F.when(F.size(found) > 0, raw).alias("line"))


class Lanes:
    """The accepted and the rejected rows of one source, stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self._stored = spark.read.schema(schema).parquet(path)

    @property
    def accepted(self) -> DataFrame:
        return self._stored.where(F.col("lane") == ACCEPTED).drop("lane", "reasons", "line")

    @property
    def rejected(self) -> DataFrame:
        """The rejected rows: what converted, ``reasons`` and the raw ``line``."""
        return self._stored.where(F.col("lane") == REJECTED).drop("lane")


def load(spark: SparkSession, root: str, source: str, out: str) -> Lanes:
    """Reads ``source`` below ``root`` once and writes both lanes below ``out``."""
    rows = checked(read_text_fields(spark, root, source), schemas.SCHEMAS[source], KEYS[source])
    rows = rows.withColumn("lane", F.when(F.size("reasons") > 0, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED)))
    path = f"{out.rstrip('/')}/{source}"
    rows.write.mode("overwrite").partitionBy("lane").parquet(path)
    schema = StructType([StructField(f.name, ArrayType(StringType()) if f.name == "reasons" else f.dataType) for f in rows.schema])
    return Lanes(spark, path, schema)


class CheckedFiles(readers.RawFiles):
    """``RawFiles`` whose rows have passed the checks; what has not is in ``lanes(source).rejected``."""

    def __init__(self, spark: SparkSession, root: str, out: str):
        super().__init__(spark, root)
        self.out, self._lanes = out, {}

    def lanes(self, source: str) -> Lanes:
        if source not in self._lanes:
            self._lanes[source] = load(self.spark, self.root, source, self.out)
        return self._lanes[source]

    def bronze(self, source: str) -> DataFrame:
        return self.lanes(source).accepted
