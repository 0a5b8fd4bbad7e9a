"""Finance inputs derived from the shared TPC-H-like test tables.

Each view is deterministic key arithmetic over ``region nation customer
supplier orders lineitem`` (no ``rand``, no hash, no "now"), so DuckDB can
derive the very same rows for the oracle (``ledgerloom.oracle_sql``).  The
views play the part of the silver-layer inputs: dates are already DateType
and money is DECIMAL(18,2).

Let k = o_orderkey, c = customer key, s = supplier key and
p = l_orderkey * 10 + l_linenumber.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.money import MONEY

AS_OF = dt.date(2001, 8, 1)
CONTRACT_EPOCH = dt.date(1995, 1, 1)
HIRE_EPOCH = dt.date(1996, 1, 1)
CENT = Decimal("0.01")

# Trial-balance month ends and planning quarters used with the fixtures.
TB_START, TB_END = dt.date(1999, 8, 31), dt.date(2001, 7, 31)
SCENARIO_START, SCENARIO_END = dt.date(1998, 1, 1), dt.date(2000, 10, 1)

# Fixed values (enumerations of the reference's data model):
CONTRACT_TYPES = ["Fixed-Price", "Time-and-Materials", "Cost-Plus"]
PAYMENT_TERMS = ["Net-30", "Net-45", "Net-60"]
INVOICE_CATEGORIES = ["labor", "materials", "equipment", "subcontractor", "overhead"]
PAYMENT_METHODS = ["check", "ach", "wire"]


def _pick(index: Column, values: list[str]) -> Column:
    out = F.lit(None).cast("string")
    for i in reversed(range(len(values))):
        out = F.when(index == i, F.lit(values[i])).otherwise(out)
    return out


def _pct(col: Column, factor: Column) -> Column:
    """round(money * integer_factor * 0.01, 2) with exact decimal steps."""
    return F.round(col * factor.cast("decimal(5,0)") * F.lit(CENT).cast("decimal(3,2)"), 2).cast(MONEY)


@dataclass
class Fixtures:
    """Lazily derived fixture views over one scale-factor directory."""

    spark: SparkSession
    sf_dir: str
    as_of: dt.date = AS_OF
    _cache: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """One read (file listing and footer schema) per table per instance."""
        return self._memo(f"table:{name}", lambda: self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    def _memo(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    # -- reference data -------------------------------------------------
    @property
    def coa(self) -> DataFrame:
        """raw_coa_hierarchy: one row per nation, 5 cost centers x 5 legal entities."""
        def build():
            n, r = self.table("nation"), self.table("region")
            # Neither table grows with the data, but Spark takes the product of their sizes for that of their join.
            return F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey)
                    .select((F.lit(70000000) + n.n_nationkey).cast("long").alias("coa_id"),
                            (F.lit(1000) + F.expr("n_nationkey div 5")).cast("long").alias("cost_center_id"),
                            F.concat(F.lit("CC_"), (F.lit(1000) + F.expr("n_nationkey div 5")).cast("string"))
                            .alias("cost_center_name"),
                            (F.lit(100001) + n.n_regionkey).cast("long").alias("legal_entity_id"),
                            r.r_name.alias("legal_entity_name")))
        return self._memo("coa", build)

    @property
    def third_parties(self) -> DataFrame:
        """raw_third_parties: every customer, plus suppliers that are not also customers."""
        def build():
            c, s = self.table("customer"), self.table("supplier")
            cust = c.select((F.lit(10000000) + c.c_custkey).alias("third_party_id"),
                            c.c_name.alias("third_party_name"))
            supp = (s.where(F.pmod(s.s_suppkey, F.lit(4)) != 1)
                    .select((F.lit(10500000) + s.s_suppkey).alias("third_party_id"),
                            s.s_name.alias("third_party_name")))
            return cust.unionByName(supp)
        return self._memo("third_parties", build)

    @property
    def customers(self) -> DataFrame:
        def build():
            c = self.table("customer")
            return c.select((F.lit(20000000) + c.c_custkey).alias("customer_id"),
                            # Two customers of one party, every eighth; some of these parties supply too.
                            (F.lit(10000000) + c.c_custkey - F.when(F.pmod(c.c_custkey, F.lit(8)) == 2, 1).otherwise(0))
                            .alias("third_party_id"),
                            c.c_name.alias("customer_name"),
                            c.c_mktsegment.alias("customer_industry"))
        return self._memo("customers", build)

    @property
    def suppliers(self) -> DataFrame:
        def build():
            s = self.table("supplier")
            return s.select((F.lit(30000000) + s.s_suppkey).alias("supplier_id"),
                            F.when(F.pmod(s.s_suppkey, F.lit(4)) == 1, F.lit(10000000) + s.s_suppkey)
                            # Two suppliers of one party, every eighth.
                            .otherwise(F.lit(10500000) + s.s_suppkey
                                       - F.when(F.pmod(s.s_suppkey, F.lit(8)) == 3, 1).otherwise(0)).alias("third_party_id"),
                            s.s_name.alias("supplier_name"))
        return self._memo("suppliers", build)

    # -- contracts ------------------------------------------------------
    def _contracts(self, key: Column, id_base: int, party_col: str, party_base: int, prefix: str,
                   direction: str, src: DataFrame) -> DataFrame:
        start = F.date_add(F.lit(CONTRACT_EPOCH), F.pmod(key * 37, F.lit(1800)).cast("int"))
        end = F.date_add(start, (F.lit(30) + F.pmod(key * 17, F.lit(701))).cast("int"))
        as_of = F.lit(self.as_of)
        status = (F.when(end < as_of, "Completed").when(start > as_of, "Pending")
                  .when(F.pmod(key, F.lit(20)) == 0, "On-Hold").otherwise("Active"))
        return src.select(
            (F.lit(id_base) + key).alias("contract_id"),
            F.concat(F.lit(prefix), key.cast("string")).alias("contract_number"),
            (F.lit(party_base) + key).alias(party_col),
            (F.lit(100001) + F.pmod(key, F.lit(5))).alias("legal_entity_id"),
            F.lit("USD").alias("contract_currency"),
            (F.lit(100000) + F.pmod(key * 7919, F.lit(900000))).cast(MONEY).alias("total_contract_value"),
            start.alias("contract_start_date"),
            end.alias("estimated_completion_date"),
            status.alias("contract_status"),
            _pick(F.pmod(key, F.lit(3)), CONTRACT_TYPES).alias("contract_type"),
            F.concat(F.lit(f"{direction} agreement "), key.cast("string")).alias("contract_description"),
            _pick(F.pmod(key, F.lit(3)), PAYMENT_TERMS).alias("payment_terms"),
        )

    @property
    def outbound_contracts(self) -> DataFrame:
        c = self.table("customer")
        return self._memo("outbound", lambda: self._contracts(
            c.c_custkey, 30000000, "customer_id", 20000000, "OUT-", "Outbound", c))

    @property
    def inbound_contracts(self) -> DataFrame:
        s = self.table("supplier")
        return self._memo("inbound", lambda: self._contracts(
            s.s_suppkey, 40000000, "supplier_id", 30000000, "IN-", "Inbound", s))

    # -- order to cash --------------------------------------------------
    @property
    def revenue_transactions(self) -> DataFrame:
        def build():
            o = self.table("orders")
            k, c = o.o_orderkey, o.o_custkey
            coa_n = F.when(F.pmod(k, F.lit(3)) == 0, F.pmod(k, F.lit(25))).otherwise(
                F.pmod(k, F.lit(5)) * 5 + F.pmod(c, F.lit(5)))
            category = (F.when(o.o_orderpriority == "1-URGENT", "labor")
                        .when(o.o_orderpriority == "2-HIGH", "compute")
                        .when(o.o_orderpriority == "3-MEDIUM", "materials")
                        .when(o.o_orderpriority == "4-NOT SPECIFIED", "subcontractor")
                        .when(F.pmod(k, F.lit(2)) == 0, "equipment").otherwise("overhead"))
            return o.select(
                k.alias("rev_trx_id"),
                F.when(F.pmod(k, F.lit(5)) == 0, F.lit(None).cast("long"))
                .otherwise(F.lit(30000000) + c).alias("contract_id"),
                (F.lit(20000000) + c).alias("customer_id"),
                F.to_date(o.o_orderdate).alias("transaction_date"),
                (F.lit(70000000) + coa_n).cast("long").alias("coa_id"),
                category.alias("cost_category"),
                o.o_totalprice.cast(MONEY).alias("amount"),
            )
        return self._memo("rev_trx", build)

    @property
    def revenue_billings(self) -> DataFrame:
        def build():
            o = self.table("orders").where(F.col("o_orderstatus") != "P")
            k = o.o_orderkey
            invoice = F.date_add(F.to_date(o.o_orderdate), F.pmod(k, F.lit(31)).cast("int"))
            # 90-110 % of the transaction; every 83rd is billed too high, every 89th is a credit note.
            share = (F.when(F.pmod(k, F.lit(83)) == 4, 125).when(F.pmod(k, F.lit(89)) == 3, -10)
                     .otherwise(F.lit(90) + F.pmod(k, F.lit(21))))
            billed = _pct(o.o_totalprice.cast(MONEY), share)
            due_days = F.when(F.pmod(k, F.lit(3)) == 0, 30).when(F.pmod(k, F.lit(3)) == 1, 45).otherwise(60)
            return o.select(
                (F.lit(60000000) + k).alias("billing_id"),
                k.alias("rev_trx_id"),
                invoice.alias("invoice_date"),
                F.concat(F.lit("INV-"), k.cast("string")).alias("invoice_number"),
                billed.alias("billed_amount"),
                F.date_add(invoice, due_days).alias("payment_due_date"),
                F.when(o.o_orderstatus == "F",
                       F.date_add(invoice, (F.lit(5) + F.pmod(k, F.lit(86))).cast("int")))
                .alias("payment_received_date"),
                _pct(billed, F.pmod(k, F.lit(11))).alias("retention_amount"),
            )
        return self._memo("rev_bill", build)

    # -- procure to pay -------------------------------------------------
    @property
    def _po_lines(self) -> DataFrame:
        def build():
            # Dealt by the number that orders and invoices carry: one exchange serves the
            # grouping and every later step by that number.  Dates and cents go in, which
            # take less room there than instants and doubles; the number is made again behind it.
            p = F.col("l_orderkey") * 10 + F.col("l_linenumber")
            li = (self.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").alias("l_shipdate"),
                                                F.col("l_extendedprice").cast(MONEY).alias("l_extendedprice"), "l_tax", "l_discount")
                  .repartition(p).withColumn("p", p))
            return (li.groupBy("l_orderkey", "l_linenumber", "p")
                    .agg(F.min("l_suppkey").alias("s"),
                         F.min("l_shipdate").alias("ship"),
                         F.sum("l_extendedprice").cast(MONEY).alias("amount"),
                         F.min("l_tax").alias("t"),
                         F.min("l_discount").alias("d")))
        return self._memo("po_lines", build)

    @property
    def purchase_orders(self) -> DataFrame:
        def build():
            li = self._po_lines
            p = F.col("p")
            po_date = F.to_date("ship")
            age = F.datediff(F.lit(self.as_of), po_date)
            status = (F.when(F.pmod(p, F.lit(20)) == 0, "cancelled")
                      .when(age < 0, "draft").when(age < 7, "approved").when(age < 30, "issued")
                      .when(age < 90, "partially_received").otherwise("closed"))
            return li.select(
                p.alias("purchase_order_id"),
                F.when(F.pmod(p, F.lit(5)) < 2, F.lit(None).cast("long"))
                .otherwise(F.lit(40000000) + F.col("s")).alias("contract_id"),
                F.concat(F.lit("PO-"), p.cast("string")).alias("purchase_order_number"),
                po_date.alias("purchase_order_date"),
                status.alias("purchase_order_status"),
                (F.lit(30000000) + F.col("s")).alias("supplier_id"),
                F.lit("USD").alias("purchase_order_currency"),
                F.col("amount").alias("purchase_order_amount"),
                F.col("amount").alias("total_purchase_order_value"),
                (F.lit(70000000) + F.pmod(p, F.lit(25))).cast("long").alias("coa_id"),
            )
        return self._memo("po", build)

    @property
    def spend_invoices(self) -> DataFrame:
        def build():
            li = self._po_lines.where(F.pmod(F.col("p"), F.lit(17)) != 0)
            p = F.col("p")
            po_date = F.to_date("ship")
            invoice = F.date_add(po_date, (F.lit(15) + F.pmod(p, F.lit(76))).cast("int"))
            # Every 101st invoice is above its order, every 103rd does not add up.
            ordered = F.col("amount")
            amount = F.when(F.pmod(p, F.lit(101)) == 5, _pct(ordered, F.lit(110))).otherwise(ordered).cast(MONEY)
            slip = F.when(F.pmod(p, F.lit(103)) == 6, F.lit(Decimal("1.00"))).otherwise(F.lit(Decimal("0.00"))).cast(MONEY)
            tax = F.round(amount * F.col("t").cast("decimal(4,2)"), 2).cast(MONEY)
            discount = F.round(amount * F.col("d").cast("decimal(4,2)"), 2).cast(MONEY)
            total = (amount + tax - discount + slip).cast(MONEY)
            r = F.pmod(p * 7, F.lit(100))
            status = (F.when(r < 80, "paid").when(r < 90, "approved").when(r < 95, "disputed")
                      .when(r < 98, "cancelled").otherwise(F.lit(None).cast("string")))
            paid = status == "paid"
            matched = F.pmod(p, F.lit(10)) != 0
            return li.select(
                (F.lit(100000000) + p).alias("invoice_id"),
                p.alias("purchase_order_id"),
                F.concat(F.lit("SINV-"), p.cast("string")).alias("invoice_number"),
                invoice.alias("invoice_date"),
                status.alias("invoice_status"),
                amount.alias("invoice_amount"),
                tax.alias("tax_amount"),
                discount.alias("discount_amount"),
                total.alias("total_invoice_amount"),
                F.when(paid, total).when(status == "disputed", _pct(total, F.pmod(p, F.lit(50))))
                .otherwise(F.lit(Decimal("0.00")).cast(MONEY)).alias("amount_paid"),
                F.date_add(invoice, (F.lit(15) + F.pmod(p + 1, F.lit(76))).cast("int")).alias("payment_due_date"),
                _pick(F.pmod(p, F.lit(5)), INVOICE_CATEGORIES).alias("invoice_category"),
                F.when(paid, F.date_add(invoice, F.pmod(p, F.lit(90)).cast("int"))).alias("payment_date"),
                F.when(paid, _pick(F.pmod(p, F.lit(3)), PAYMENT_METHODS)).alias("payment_method"),
                F.when(paid, F.concat(F.lit("PAY-"), p.cast("string"))).alias("payment_reference"),
                matched.alias("receipt_matched"),
                F.when(matched, "matched").otherwise("unmatched").alias("three_way_match_status"),
                F.date_add(po_date, (F.lit(5) + F.pmod(p, F.lit(10))).cast("int")).alias("goods_received_date"),
                F.year(invoice).cast("long").alias("invoice_year"),
                F.month(invoice).cast("long").alias("invoice_month"),
            )
        return self._memo("inv", build)

    # -- people -----------------------------------------------------------
    @property
    def employees(self) -> DataFrame:
        def build():
            c = self.table("customer")
            k = c.c_custkey
            return c.select(
                (F.lit(50000000) + k).alias("employee_id"),
                c.c_name.alias("employee_name"),
                (F.lit(50000) + F.pmod(k * 7919, F.lit(100000))).cast(MONEY).alias("salary"),
                (F.lit(1000) + F.pmod(k, F.lit(5))).cast("string").alias("cost_center_id"),
                (F.lit(100001) + F.pmod(F.expr("c_custkey div 5"), F.lit(5))).alias("legal_entity_id"),
                F.when(F.pmod(k, F.lit(97)) == 0, F.lit(None).cast("date"))
                .otherwise(F.date_add(F.lit(HIRE_EPOCH), F.pmod(k * 13, F.lit(1800)).cast("int")))
                .alias("hire_date"),
            )
        return self._memo("emp", build)


# -- planted faults of raw files ------------------------------------------------
def dirty_revenue_transactions(fx: Fixtures) -> DataFrame:
    """Raw revenue transactions as text fields, some of them wrong, with their month folder.

    By rev_trx_id k: k % 97 = 3 has a word as amount, k % 89 = 5 a word as date,
    k % 101 = 7 a contract number as contract_id, k % 113 = 11 one field too many.
    """
    from ledgerloom.sources.sinks import to_bronze

    raw = to_bronze(fx.revenue_transactions, "revenue_transactions")
    k = F.col("rev_trx_id")
    text = {c: F.col(c).cast("string") for c in raw.columns}
    text["amount"] = F.when(k % 97 == 3, F.lit("n/a")).otherwise(text["amount"])
    text["amount"] = F.when(k % 113 == 11, F.concat(text["amount"], F.lit(",extra"))).otherwise(text["amount"])
    text["transaction_date"] = F.when(k % 89 == 5, F.lit("someday")).otherwise(text["transaction_date"])
    text["contract_id"] = F.when(k % 101 == 7, F.lit("C-17")).otherwise(text["contract_id"])
    month = F.date_format(F.timestamp_seconds("transaction_date"), "yyyy_MM")
    return raw.select(*(v.alias(c) for c, v in text.items()), month.alias("month"))


def dirty_employee_lines(fx: Fixtures) -> DataFrame:
    """Raw employees as JSON lines, some of them wrong.

    By employee_id k: k % 31 = 4 is cut off after 30 characters, k % 37 = 2 has a
    word as salary, k % 41 = 1 no employee_id.
    """
    from ledgerloom.sources.sinks import to_bronze

    raw = to_bronze(fx.employees, "employees")
    k = F.col("employee_id")
    own = [F.when(k % 41 != 1, k).alias("employee_id"), "employee_name",
           F.when(k % 37 == 2, F.lit("lots")).otherwise(F.col("salary").cast("string")).alias("salary"),
           *(c for c in raw.columns if c not in ("employee_id", "employee_name", "salary"))]
    line = F.to_json(F.struct(*own))
    return raw.select(F.when(k % 31 == 4, F.substring(line, 1, 30)).otherwise(line).alias("value"))
