"""Readers and sinks on small data."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.sources import readers, sinks
from ledgerloom.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL
from tests.helpers import rows


def test_inferred_and_glob_csv_reads(spark):
    root = sinks.new_scratch(spark, "io")
    po = Fixtures(spark, SF_SMALL).purchase_orders
    sinks.write_raw(po, root, "purchase_orders")
    inferred = readers.read_csv_inferred(spark, f"{root}/purchase_orders")
    assert inferred.count() == po.count()
    globbed = readers.read_csv_glob(spark, f"{root}/purchase_orders/*/*.csv",
                                    {"purchase_order_id": "long", "purchase_order_amount": "double"})
    assert dict(globbed.dtypes)["purchase_order_id"] == "bigint"
    assert globbed.count() == po.count()


def test_partition_pruning_on_partitioned_invoices(spark):
    root = sinks.new_scratch(spark, "io")
    inv = Fixtures(spark, SF_SMALL).spend_invoices
    sinks.write_raw(inv, root, "spend_invoices")
    raw = readers.RawFiles(spark, root).bronze("spend_invoices").where(F.col("invoice_year") == 1998)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "invoice_year" in plan
    assert raw.count() == inv.where(F.year("invoice_date") == 1998).count()


def test_filters_on_folder_columns_prune_in_silver(spark):
    root = sinks.new_scratch(spark, "io")
    fx = Fixtures(spark, SF_SMALL)
    for source in ("spend_invoices", "revenue_billings"):
        sinks.write_raw(getattr(fx, source), root, source)
        silver = readers.RawFiles(spark, root).silver(source).where(F.col("invoice_year") == 1998)
        plan = silver._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(invoice_year" in plan
        assert silver.count() == getattr(fx, source).where(F.year("invoice_date") == 1998).count() > 0


def test_epochs_are_utc_days_in_any_session_zone(spark):
    from ledgerloom.functions.dates import date_to_epoch, epoch_to_date
    zone = spark.conf.get("spark.sql.session.timeZone")
    epochs = [(0, "1970-01-01"), (1704067200, "2024-01-01"), (1704067199, "2023-12-31"), (-1, "1969-12-31")]
    try:
        for other in ("UTC", "America/Los_Angeles", "Pacific/Auckland"):
            spark.conf.set("spark.sql.session.timeZone", other)
            df = spark.createDataFrame(epochs, "e long, d string")
            got = df.select("d", epoch_to_date("e").cast("string").alias("day"), date_to_epoch(F.to_date("d")).alias("back")).collect()
            assert [r.day for r in got] == [d for _, d in epochs]
            assert [r.back for r in got] == [0, 1704067200, 1703980800, -86400]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_table_comment(spark):
    sinks.use_database(spark, "ledgerloom_test")
    spark.sql("CREATE TABLE IF NOT EXISTS commented (k int) USING parquet")
    sinks.comment_table(spark, "commented", "the owner's table")
    shown = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED commented").collect()}
    assert shown["Comment"] == "the owner's table"
    spark.sql("USE default")


def test_views_tables_preview_and_comments(spark):
    sinks.use_database(spark, "ledgerloom_test")
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "k int, v string")
    sinks.register_view(df, "ll_view")
    assert spark.sql("SELECT count(*) FROM ll_view").first()[0] == 3
    assert [r.k for r in sinks.preview(df, ["k"], 2).collect()] == [1, 2]
    commented = sinks.with_comment(df, {"k": "the key"})
    assert commented.schema["k"].metadata["comment"] == "the key"
    spark.sql("USE default")


def test_inline_rows_and_materialize(spark):
    df = readers.inline_rows(spark, [(1, Decimal("1.50"), dt.date(2024, 1, 31))], "a int, m decimal(18,2), d date")
    back = sinks.materialize(df, spark, "inline_check", sinks.new_scratch(spark, "mat"))
    assert rows(back) == rows(df)


def test_quarantine_keeps_what_does_not_convert(spark):
    from ledgerloom.sources import quarantine
    root = sinks.new_scratch(spark, "raw")
    lines = ['{"customer_id": 1, "third_party_id": 2, "customer_name": "a", "customer_industry": null}',
             '{"customer_id": "x", "third_party_id": 2.5, "customer_name": "b"}', '{"customer_id": 3', '{"third_party_id": 4}',
             '{"customer_id": 9007199254740993, "third_party_id": null, "customer_name": {"first": "n"}, "more": 1}', '[1]', '']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/customers")
    lanes = quarantine.load(spark, root, "customers", sinks.new_scratch(spark, "lanes"))
    assert sorted(tuple(r) for r in lanes.accepted.select("customer_id", "third_party_id").collect()) == [(1, 2), (9007199254740993, None)]
    bad = {r.line: r.reasons for r in lanes.rejected.collect()}
    assert bad['{"customer_id": 3'] == ["line: does not parse"] and bad["[1]"] == ["line: does not parse"]
    assert ["customer_id: not a bigint", "third_party_id: not a bigint"] in bad.values() and ["customer_id: missing"] in bad.values()
    assert len(bad) == 4


def test_quarantine_of_csv_lines(spark):
    from ledgerloom.sources import quarantine
    root = sinks.new_scratch(spark, "raw")
    text = ["rev_trx_id,contract_id,customer_id,transaction_date,coa_id,cost_category,amount", '1,,2,86400,3,"a,b",4.50', "2,,2,86400,3,x,NaN",
            "3,,2,86400,3,x", "4,,2,86400,3,x,1,9", ",,2,86400,3,x,1", "6,,2,1.5,3,x,1e400", "7,,2,86400,3,,-0.25"]
    spark.createDataFrame([("\n".join(text),)], "value string").coalesce(1).write.text(f"{root}/revenue_transactions/2024_01")
    files = quarantine.CheckedFiles(spark, root, sinks.new_scratch(spark, "lanes"))
    assert sorted((r.rev_trx_id, r.cost_category, r.amount) for r in files.revenue_transactions.collect()) == [
        (1, "a,b", Decimal("4.50")), (7, None, Decimal("-0.25"))]
    bad = sorted((r.rev_trx_id or 0, r.reasons) for r in files.lanes("revenue_transactions").rejected.collect())
    assert bad == [(0, ["rev_trx_id: missing"]), (2, ["amount: not a double"]), (3, ["line: does not parse"]), (4, ["line: does not parse"]),
                   (6, ["transaction_date: not a bigint", "amount: not a double"])]


def test_quarantine_writes_both_lanes_from_one_scan(spark):
    from ledgerloom.sources import quarantine, schemas
    root = sinks.new_scratch(spark, "raw")
    sinks.write_raw(Fixtures(spark, SF_SMALL).spend_invoices, root, "spend_invoices")
    fields = quarantine.read_text_fields(spark, root, "spend_invoices")
    plan = quarantine.checked(fields, schemas.SCHEMAS["spend_invoices"], "invoice_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    files = quarantine.CheckedFiles(spark, root, sinks.new_scratch(spark, "lanes"))
    assert rows(files.spend_invoices) == rows(readers.RawFiles(spark, root).spend_invoices)
    assert files.lanes("spend_invoices").rejected.count() == 0


def test_clustered_files_skip_row_groups(spark):
    """One account lies in few of many row groups, also where most rows are its own."""
    import glob

    import pyarrow.parquet as pq
    path = sinks.new_scratch(spark, "clustered")
    df = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1000)).otherwise(2000 + F.col("id") % 40).cast("int").alias("account_number"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 365).cast("int")).alias("gl_date"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # so small a table would be one file
    try:
        back = sinks.write_clustered(df, path, ["account_number", "gl_date"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows(back) == rows(df)
    groups = []
    for f in glob.glob(path.removeprefix("file:") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("account_number")
        groups += [(g.column(at).statistics.min, g.column(at).statistics.max) for g in map(meta.row_group, range(meta.num_row_groups))]
    assert len(groups) >= 4
    assert sum(low <= 2007 <= high for low, high in groups) == 1
    assert 2 <= sum(low <= 1000 <= high for low, high in groups) < len(groups)
    plan = back.where("account_number = 2007")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(account_number), EqualTo(account_number,2007)]" in plan


def test_clustered_folders_hold_one_account_and_narrow_dates(spark):
    """The clustered ledger: entries are dealt by date, also where most fall on one day, and an account is a folder."""
    import glob

    import pyarrow.parquet as pq

    from ledgerloom.plans import ledger
    from ledgerloom.plans.registry import lakehouse, tabular
    lh = lakehouse(spark, SF_SMALL)
    hot = F.when(F.col("invoice_date").isNotNull() & (F.col("invoice_id") % 4 != 0), F.lit(dt.date(2000, 12, 29))).otherwise(F.col("invoice_date"))
    spend = lh.stg_spend_transactions.withColumn("invoice_date", hot)
    path = sinks.new_scratch(spark, "clustered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        gl = tabular(ledger.gl_by_date(lh.stg_revenue_transactions, spend))
        back = sinks.write_clustered_folders(gl, path, "account_number", "gl_date")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert back.dtypes == gl.dtypes
    assert rows(back) == rows(tabular(ledger.fact_gl_entries(lh.stg_revenue_transactions, spend)))
    dates = {}
    for f in glob.glob(path.removeprefix("file:") + "/account_number=*/*.parquet"):
        days = pq.read_table(f, columns=["gl_date"]).column("gl_date").to_pylist()
        assert days == sorted(days)
        dates.setdefault(f.split("account_number=")[1].split("/")[0], []).append((days[0], days[-1]))
    assert sorted(dates) == ["1000", "1100", "2000", "4000", "5000", "5100"]
    assert sum(low <= dt.date(2000, 12, 29) <= high for low, high in dates["5000"]) >= 2
    assert sum(low <= dt.date(1999, 3, 1) <= high for low, high in dates["5000"]) <= 2 < len(dates["5000"])
    plan = back.where("account_number = 2000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(account_number" in plan


def test_bucketed_tables_hold_one_file_a_bucket(spark):
    import glob

    from ledgerloom.sources import catalog
    fxs = Fixtures(spark, SF_SMALL)
    inputs = catalog.BucketedInputs(spark, fxs, buckets=4).build(["spend_invoices"])
    assert rows(inputs.spend_invoices) == rows(fxs.spend_invoices)
    assert len(glob.glob(f"{inputs.root.removeprefix('file:')}/spend_invoices/*.parquet")) == 4
    assert rows(inputs.coa) == rows(fxs.coa)


def test_buckets_follow_the_rows(spark, monkeypatch):
    import glob

    from ledgerloom.sources import catalog
    monkeypatch.setattr(catalog, "BUCKET_ROWS", 100)

    class Facts:
        purchase_orders = spark.range(1050).select(F.col("id").alias("purchase_order_id"))
        spend_invoices = spark.range(300).select(F.col("id").alias("purchase_order_id"), F.col("id").alias("invoice_id"))
        revenue_transactions = spark.range(30).select(F.col("id").alias("rev_trx_id"))
    inputs = catalog.BucketedInputs(spark, Facts()).build(["purchase_orders", "spend_invoices", "revenue_transactions"])
    files = {n: len(glob.glob(f"{inputs.root.removeprefix('file:')}/{n}/*.parquet")) for n in inputs._built}
    # Facts that are joined have the same number of buckets; small ones keep a few.
    assert files["purchase_orders"] == files["spend_invoices"] == 11
    assert files["revenue_transactions"] <= catalog.FEWEST_BUCKETS
    for n in files:
        assert rows(getattr(inputs, n)) == rows(getattr(Facts, n))
