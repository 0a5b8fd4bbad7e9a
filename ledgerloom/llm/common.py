"""Helpers shared by the training-data operators: stored tables and components."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.session import ensure_checkpoint_dir


@functools.lru_cache(maxsize=1)
def _archive() -> str:
    """A zip file of the library's modules, on the driver."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-py-"), "ledgerloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "ledgerloom")):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    return path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import the library, wherever the driver found it (``--py-files`` for callers)."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        spark.sparkContext.addPyFile(_archive())
        _shipped.add(app)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"


#: What a Python worker keeps between tasks, by the operator that keeps it: how to let go of it.
_kept: dict[str, Callable[[], object]] = {}


def keep_in_worker(operator: str, release: Callable[[], object] | None = None) -> None:
    """Called as a task begins: what other operators have kept in this worker is let go, then ``release`` noted for this one.

    Spark gives a worker to the tasks of one stage after another; a cache that
    serves the tasks of its own operator only takes room from the next.
    """
    if others := [k for k in _kept if k != operator]:
        for other in others:
            _kept.pop(other)()
        give_back()
    if release is not None:
        _kept[operator] = release


def give_back() -> None:
    """The room that this worker has freed goes back to the machine; Arrow and the C library would keep it for themselves."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, after which the worker gives back its room.

    Workers wait for their next task beside an executor's JVM, which needs the
    room for the joins and sorts in between.
    """
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


#: Spark's setting to delete a query's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Spark's setting for the bytes of an Arrow batch, which it otherwise bounds by rows alone.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of Arrow data that go to a Python worker, and that it turns into Python objects, at once.
SLICE_BYTES = 4 << 20


def stored(df: DataFrame, label: str, parts: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    Later steps start from files that every executor reaches, so a lost
    executor costs a re-read and nothing upstream is computed twice.  Once the
    table is written its shuffle files serve nothing, so Spark deletes them then.
    Rows go to Python workers in batches of bounded bytes, however long texts are.
    With ``parts`` the values of that column (a few) are folders of their own,
    which ``discard_part`` can delete.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # So few folders are written side by side, without a sort.
    wanted = {_CLEANUP: "true", _BATCH: str(SLICE_BYTES), **({_WRITERS: "8"} if parts else {})}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(parts) if parts else writer).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_in = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``stored`` that nothing will read again."""
    for df in tables:
        _delete(df.sparkSession, df.stored_in)


def made_from(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """``df`` with the stored ``tables`` it reads noted, for a caller that stores it and needs them no longer (``discard``)."""
    df.made_from = tables
    return df


def discard_part(table: DataFrame, folder: str) -> None:
    """Deletes one folder (``column=value``) of a table stored with ``parts``; nothing reads those rows again."""
    _delete(table.sparkSession, f"{table.stored_in}/{folder}")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, in parts of at most ``limit`` bytes; a longer row stands alone."""
    if batch.num_rows <= 1 or batch.nbytes <= limit:
        yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), limit)
    yield from slices(batch.slice(half), limit)


def map_frames(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
               schema: T.StructType | str, limit: int | None = None) -> DataFrame:
    """``mapInPandas`` with Python values: integers stay integers beside nulls, and a null is None.

    With ``limit`` a frame holds a slice of an Arrow batch of at most so many
    bytes, so a worker never holds a whole batch of texts as Python objects.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(fields)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = (pd.DataFrame({n: pd.Series(c.to_pylist(), dtype=object) for n, c in zip(b.schema.names, b.columns, strict=True)})
                  for whole in parts for b in (slices(whole, limit) if limit else [whole]))
        for pdf in run(frames):
            arrays = [pa.array(pdf[f.name].tolist(), f.type, from_pandas=True) for f in target]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(giving_back(batches), fields)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected ``links``: (node, component = smallest node).

    Alternating large-star and small-star steps.  Each step replaces a node's
    links by links to the smallest neighbour, so the table never grows beyond
    the links it began with, the number of steps is logarithmic, and no node's
    neighbourhood is gathered in one row: the minimum is a partial aggregate
    and the join back is one that adaptive execution can split.  Nodes without
    a link do not appear.  Self links and nulls are ignored.
    """
    edges = (links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
             .where("hi is not null and lo is not null and hi <> lo").distinct().checkpoint())
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .where("hi <> lo").distinct())
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").select(F.greatest("lo", "m").alias("hi"), F.least("lo", "m").alias("lo")).where(
            "hi <> lo").unionByName(root.select("hi", F.col("m").alias("lo"))).distinct()
        edges = small.checkpoint()
        # Done when every link points at a root: no smaller end has a link further down.
        onward = edges.select(F.col("lo").alias("x")).join(edges.select(F.col("hi").alias("x")), "x", "left_semi")
        if onward.isEmpty():
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
