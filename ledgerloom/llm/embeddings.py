"""Near-duplicate vectors by cross-polytope hashing.

1. Equal directions form a class: vectors are scaled to length 1 in double
   precision, and those with the same bytes are compared once.
2. A hash turns a vector by three rounds of random signs and fast Hadamard
   transforms, which costs n log n, and takes the nearest vertex of the cross
   polytope: the coordinate of largest magnitude and its sign.  A table's key
   joins ``JOINED`` hashes.
3. Multiprobe: besides its own bucket a vector enters the buckets of its next
   best vertices, in the order of how much is lost by them (``PROBES`` keys a
   table), so fewer tables find a neighbour.
4. Two vectors in one bucket of a table are a candidate pair, unless their
   outlines (15 coordinates of a rotation and the length of the rest, 32 bytes)
   show that their cosine is too small: Cauchy and Schwarz bound it from above,
   so no link is lost.  Unlike vectors that share a bucket, whose number grows
   with the square of the table, thus never leave the bucket's task.
5. A pair is verified on vectors rounded to bytes, whose cosine is known up to
   the rounding; where that leaves it open, by the cosine of the full vectors in
   double precision.  So the full vectors travel for doubtful pairs only.

Links are counted per vector, so every verified pair is needed; copies count
by class size and are not expanded.  Buckets have no cap.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing; nor do vectors of different lengths link.  A null ``vec_id``
is linked and counted like any other, but names no component.  Rows that
repeat a ``vec_id`` are separate vectors of one name.  Extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import components, map_frames, stored

COSINE = 0.95
TABLES = 16
JOINED = 3
PROBES = 4
#: Numbers of an outline, and what the 16-bit number of a length 1 is.
OUTLINE = 16
UNIT = 32767
_SEED = 20240602


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


@functools.lru_cache(maxsize=8)
def signs(width: int, tables: int = TABLES, joined: int = JOINED) -> np.ndarray:
    """Random signs of the three rounds of every hash."""
    rng = np.random.default_rng([_SEED, width])
    return rng.choice(np.array([-1.0, 1.0]), (tables, joined, 3, width))


def keys(unit: np.ndarray, tables: int = TABLES, joined: int = JOINED, probes: int = PROBES) -> np.ndarray:
    """[rows, tables, probes] bucket numbers of unit vectors: the nearest vertices and the next best ones."""
    n, d = unit.shape
    width = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = unit
    own = signs(width, tables, joined)
    out = np.empty((n, tables, probes), np.int64)
    near = min(probes, width)
    for t in range(tables):
        vertex, lost = [], []
        for j in range(joined):
            x = padded
            for r in range(3):
                x = hadamard(x * own[t, j, r])
            size = np.abs(x)
            best = np.argsort(-size, axis=1, kind="stable")[:, :near]
            held = np.take_along_axis(size, best, 1)
            vertex.append(best * 2 + (np.take_along_axis(x, best, 1) < 0))
            lost.append((held[:, :1] - held) ** 2)
        # Every choice of one vertex per hash, the least loss first.
        choice = np.stack(np.meshgrid(*[np.arange(near)] * joined, indexing="ij"), -1).reshape(-1, joined)
        cost = sum(lost[j][:, choice[:, j]] for j in range(joined))
        picked = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        number = np.full(picked.shape, t, np.int64)
        for j in range(joined):
            number = number * (2 * width) + np.take_along_axis(vertex[j], choice[picked, j], 1)
        out[:, t, :number.shape[1]] = number
        out[:, t, number.shape[1]:] = number[:, :1]
    return out


def unit_vectors(rows: list) -> list[np.ndarray | None]:
    """Rows scaled to length 1 in double precision; None where a row cannot link."""
    out = []
    for row in rows:
        v = None if row is None else np.asarray(row, np.float64)
        if v is None or v.ndim != 1 or not len(v) or not np.isfinite(v).all() or not v.any():
            out.append(None)
            continue
        v = v / np.abs(v).max()        # first, so that no square over- or underflows
        out.append(v / np.sqrt(np.dot(v, v)) + 0.0)
    return out


def outline(unit: np.ndarray) -> np.ndarray:
    """[rows, ``OUTLINE`` / 4] integers that hold ``OUTLINE`` 16-bit numbers of each unit vector.

    The numbers are the first coordinates of a rotation of the vector and, rounded
    up, the length of what remains.  Their dot product over ``UNIT`` squared is a
    cosine's upper bound, but for rounding (at most 0.00012).
    """
    n, d = unit.shape
    width = 1 << max(1, (d - 1).bit_length())
    x = np.zeros((n, width))
    x[:, :d] = unit
    for r in range(3):
        x = hadamard(x * signs(width)[0, 0, r])
    near, rest = x[:, :OUTLINE - 1], x[:, OUTLINE - 1:]
    held = np.zeros((n, OUTLINE), np.int64)
    held[:, :near.shape[1]] = np.rint(near * UNIT)
    held[:, -1] = np.ceil(np.sqrt((rest ** 2).sum(1)) * UNIT)
    return np.clip(held, -UNIT, UNIT).astype("<i2").view("<i8")


def rounded(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as bytes, what a byte stands for, and how far the bytes are from the vector."""
    step = np.abs(unit).max(1) / 127
    held = np.rint(unit / step[:, None])
    off = np.sqrt(((unit - held * step[:, None]) ** 2).sum(1))
    return held.astype(np.int8), step, off


def directions(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, class): unit vectors and a hash of them; null where nothing can link."""
    schema = T.StructType([T.StructField("vec_id", vectors.schema["vec_id"].dataType),
                           T.StructField("vec", T.ArrayType(T.DoubleType())),
                           T.StructField("class", T.BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at:at + 1024]
                unit = unit_vectors(part["embedding"].tolist())
                names = [None if v is None else xxhash.xxh3_128_digest(v.tobytes()) for v in unit]
                yield pd.DataFrame({"vec_id": part["vec_id"], "vec": pd.Series(unit, part.index, object),
                                    "class": pd.Series(names, part.index, object)})

    return map_frames(vectors.select("vec_id", "embedding"), run, schema)


def hashed(classes: DataFrame) -> DataFrame:
    """``classes`` with the bucket numbers (keys), outline and bytes of each ``vec``."""
    made = T.StructType([T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("outline", T.ArrayType(T.LongType())),
                         T.StructField("bytes", T.ArrayType(T.ByteType())), T.StructField("step", T.DoubleType()),
                         T.StructField("off", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at:at + 1024]
                vecs = [np.asarray(v) for v in part["vec"]]
                out: list = [None] * len(vecs)
                for size in {len(v) for v in vecs}:
                    rows = [k for k, v in enumerate(vecs) if len(v) == size]
                    unit = np.stack([vecs[k] for k in rows])
                    # The length is part of the bucket, for vectors of different lengths do not link.
                    own = keys(unit).reshape(len(rows), -1) * 4096 + size % 4096
                    for k, number, *rest in zip(rows, own, outline(unit), *rounded(unit), strict=True):
                        out[k] = (np.unique(number), *rest)
                yield pd.DataFrame({**{c: part[c] for c in part.columns},
                                    **{f.name: pd.Series([o[i] for o in out], part.index, object) for i, f in enumerate(made)}})

    return map_frames(classes, run, T.StructType([*classes.schema, *made]))


def like(a: str, b: str, least: float):
    """Whether two outlines leave it possible that their vectors' cosine is ``least``."""
    number = lambda c, i: F.shiftright(F.shiftleft(F.col(f"{c}{i // 4}"), 48 - 16 * (i % 4)), 48)
    dot = functools.reduce(lambda x, y: x + y, (number(a, i) * number(b, i) for i in range(OUTLINE)))
    return dot >= F.lit(int((least - 0.001) * UNIT ** 2))


def candidates(classes: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of classes (by id, a below b) that share a bucket and whose outlines are alike, each once."""
    words = range(OUTLINE // 4)
    buckets = classes.select(F.explode("keys").alias("key"), "id", *(F.col("outline")[i].alias(f"o{i}") for i in words))
    one, two = (buckets.toDF("key", c, *(f"{c}{i}" for i in words)) for c in ("a", "b"))
    return one.join(two, "key").where((F.col("a") < F.col("b")) & like("a", "b", least)).select("a", "b").distinct()


def cosine(a: str, b: str):
    """Dot product of two unit vectors, summed in order in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def verified(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(a, b, n_a, n_b): the ``pairs`` whose cosine is ``least`` or more, with the sizes of their classes."""
    def of(c: str) -> DataFrame:
        return classes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), *(F.col(x).alias(f"{x}_{c}") for x in ("bytes", "step", "off")))

    product = F.aggregate(F.zip_with("bytes_a", "bytes_b", lambda x, y: x.cast("int") * y.cast("int")), F.lit(0).cast("long"), lambda s, x: s + x)
    held = pairs.join(of("a"), "a").join(of("b"), "b").where(F.size("bytes_a") == F.size("bytes_b")).select(
        "a", "b", "n_a", "n_b", (product * F.col("step_a") * F.col("step_b")).alias("about"),
        # What the bytes leave out of either vector, and more than double precision does.
        (F.col("off_a") + F.col("off_b") + F.col("off_a") * F.col("off_b") + 1e-9).alias("within"))
    near = stored(held.where(F.col("about") + F.col("within") >= least).select(
        "a", "b", "n_a", "n_b", (F.col("about") - F.col("within") >= least).alias("sure")), "near")
    full = classes.select("id", "vec")
    doubtful = near.where("not sure").join(full.toDF("a", "x"), "a").join(full.toDF("b", "y"), "b").where(cosine("x", "y") >= least)
    return near.where("sure").drop("sure").unionByName(doubtful.select("a", "b", "n_a", "n_b"))


def near_duplicates(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``vectors``."""
    marks = stored(directions(vectors), "directions")
    able = marks.where("vec is not null")
    grouped = able.groupBy("class").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"), F.any_value("vec").alias("vec"))
    # The numbers name classes within this table alone; nothing returned depends on them.
    classes = stored(hashed(grouped).withColumn("id", F.monotonically_increasing_id()), "classes")
    links = stored(verified(candidates(classes, least), classes, least), "links")

    both = links.select(F.col("a").alias("id"), F.col("n_b").alias("m")).unionByName(links.select(F.col("b").alias("id"), F.col("n_a").alias("m")))
    linked = both.groupBy("id").agg(F.sum("m").alias("others"))
    of = components(links, "a", "b").toDF("id", "part")
    named = classes.select("id", "class", "n", "first").join(of, "id", "left").withColumn("part", F.coalesce("part", "id"))
    names = named.groupBy("part").agg(F.min("first").alias("component"))
    told = (named.join(linked, "id", "left").join(names, "part")
            .select("class", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component"))
    found = marks.select("vec_id", "class").join(told, "class", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
