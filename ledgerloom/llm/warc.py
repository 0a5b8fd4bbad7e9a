"""WARC archives: write records, read them back, and merge their index.

Writing.  Every page becomes a record.  Of records with equal payloads the one
with the smallest page_id is the response; the others are revisits that name
it and carry no payload.  A task strings its records together into archives of
about ``ARCHIVE_CHARS`` characters (a longer record is an archive of its own),
and Spark's text writer puts each into a file, so archives can lie in any
store that Spark writes.

Reading.  One archive is one task's row; records are taken by Content-Length,
so a payload may hold anything, also lines that look like a record's.  Every
response's digest is checked against its payload.

Index.  Each archive gives a run: its captures sorted by URL key, timestamp
and page_id.  The key space is cut into ranges; the runs' shares of a range
meet in one task, which merges them with a loser tree.  Ranges follow one
another, so the whole is globally ordered, and no task holds more than its
range.  A URL with very many captures is cut like any other, because timestamp
and page_id belong to the sort key.

A null payload is an empty one; a null url has the empty key.  Records that
share the smallest page_id of a payload (repeated rows) are all responses; a
row without page_id is named ``none`` and never referred to unless no copy has
an id.  Extra columns are not read; an empty table writes no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import map_frames, scratch_path, stored

#: Characters of records after which an archive is closed.
ARCHIVE_CHARS = 4_000_000
#: Payloads of at least so many bytes may be revisited.
LEAST_BYTES = 0
#: Parts into which the copies of one payload are dealt while their response is looked up.
SALTS = 16
#: The capture time of pages, which have none of their own.
CAPTURED = "2024-01-01T00:00:00Z"

_BREAK = "\r\n"
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("url_key", T.StringType()),
    T.StructField("captured", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("run", T.StringType()), T.StructField("place", T.LongType())])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the top level down, then path and query."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    labels = ",".join(reversed(host.split(".")))
    port = f":{port}" if port not in (None, 80, 443) else ""
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{labels}{port}){parts.path or '/'}{'?' + query if query else ''}".lower()


def _clean(value: str) -> str:
    """A header value: percent signs and what a header line cannot hold are percent-encoded."""
    return re.sub(r"[%\x00-\x1f\x7f]|^ | $", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value)


def _unclean(value: str) -> str:
    return re.sub("(?:%[0-9A-F]{2})+", lambda m: bytes.fromhex(m[0].replace("%", "")).decode(), value)


def record_text(page_id: int | None, url: str | None, payload: str, refers_to: int | None, size: int, sha: str,
                captured: str = CAPTURED) -> str:
    """One record without the two line breaks that close it."""
    block = "" if refers_to is not None else payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {captured}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{sha}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Payload-Length: {size}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if refers_to is not None else size}"]
    return _BREAK.join(head) + _BREAK * 2 + block


def with_responses(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to names the response of a copy.

    Only payloads that occur more than once are looked up.  A payload's copies
    are dealt into SALTS parts, each of which meets its own row of the lookup,
    so one payload with very many copies does not land in one task.
    """
    payload = F.coalesce("html", F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                       F.sha1(F.encode(payload, "UTF-8")).alias("sha"), F.octet_length(payload).alias("size"),
                       F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("salt"))
    first = (own.groupBy("sha", "size").agg(F.min("page_id").alias("response"), F.count("*").alias("n"))
             .where((F.col("n") > 1) & (F.col("size") >= least))
             .select("sha", "response", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("response")), F.col("response"))
    return own.join(first, ["sha", "salt"], "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, captured: str = CAPTURED) -> None:
    """Writes a record for each of ``pages`` (page_id, url, html) into archives below ``path``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            for page_id, url, payload, refers_to in zip(*(pdf[c] for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                data = payload.encode()
                page_id = None if pd.isna(page_id) else int(page_id)
                refers_to = None if pd.isna(refers_to) else int(refers_to)
                url = url if isinstance(url, str) else None
                held.append(record_text(page_id, url, payload, refers_to, len(data), digest(data), captured))
                size += len(held[-1])
                if size >= ARCHIVE_CHARS:
                    yield pd.DataFrame({"value": pd.Series([(_BREAK * 2).join(held)], dtype=object)})
                    held, size = [], 0
        if held:
            yield pd.DataFrame({"value": pd.Series([(_BREAK * 2).join(held)], dtype=object)})

    # One row is one archive, and one file.
    (map_frames(with_responses(pages, least), run, "value string").write.option("lineSep", _BREAK * 2)
     .option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(_BREAK)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        at = start + int(headers["Content-Length"])
        yield headers, data[start:at]
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record before byte {at} is not closed")
        at += 4


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def _captures(name: str, data: bytes) -> list[tuple]:
    """The sorted captures of one archive."""
    found = []
    for headers, block in parse(data):
        sha = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = headers["WARC-Type"] == "revisit"
        if not revisit and digest(block) != sha:
            raise ValueError(f"{name}: {headers['WARC-Record-ID']} does not match its digest")
        url = _unclean(headers["WARC-Target-URI"]) if "WARC-Target-URI" in headers else None
        found.append((_page(headers["WARC-Record-ID"]), url, url_key(url), headers["WARC-Date"], headers["WARC-Type"],
                      int(headers["X-Payload-Length"]) if revisit else len(block), sha,
                      _page(headers["WARC-Refers-To"]) if revisit else None))
    found.sort(key=_order)
    return [(*row, name, k) for k, row in enumerate(found)]


def _order(row: tuple) -> tuple:
    return row[2], row[3], row[0] is not None, row[0] or 0


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sorted runs of all archives below ``path``: a row per capture, ``run`` and ``place`` in it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                data = gzip.decompress(content) if name.endswith(".gz") else content
                rows = _captures(name.rsplit("/", 1)[-1], data)
                yield pd.DataFrame(rows, columns=RECORD.names, dtype=object)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return map_frames(files, run, RECORD)


class LoserTree:
    """Merges sorted runs; every step replays one path from the winner's leaf to the root."""

    def __init__(self, runs: list[Iterator[tuple]], key):
        self.runs, self.key = runs, key
        self.n = max(1, len(runs))
        self.heads: list[tuple | None] = [next(r, None) for r in runs] or [None]
        self.loser = [-1] * self.n
        winner = [*[-1] * self.n, *range(self.n)]
        for k in range(self.n - 1, 0, -1):
            a, b = winner[2 * k], winner[2 * k + 1]
            first, second = (a, b) if self._before(a, b) else (b, a)
            winner[k], self.loser[k] = first, second
        self.winner = winner[1] if self.n > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        kx, ky = self.key(x), self.key(y)
        return kx < ky or (kx == ky and a < b)

    def __iter__(self) -> Iterator[tuple]:
        while (row := self.heads[self.winner]) is not None:
            yield row
            at = self.winner
            self.heads[at] = next(self.runs[at], None)
            k = (at + self.n) // 2
            while k:
                if self._before(self.loser[k], at):
                    self.loser[k], at = at, self.loser[k]
                k //= 2
            self.winner = at


def merged_index(runs: DataFrame) -> DataFrame:
    """The captures of all runs, globally ordered by URL key, timestamp and page_id.

    Rows of the result lie in that order within a partition, and partitions
    follow one another.
    """
    names = runs.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: dict[str, list[tuple]] = {}
        for pdf in batches:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            for row in pdf.itertuples(index=False, name=None):
                parts.setdefault(row[8], []).append(row)
        # A run's share arrives in pieces; its places restore its order.
        ordered = [iter(sorted(parts[name], key=lambda r: r[9])) for name in sorted(parts)]
        held = []
        for row in LoserTree(ordered, _order):
            held.append(row)
            if len(held) == 10_000:
                yield pd.DataFrame(held, columns=names, dtype=object)
                held = []
        if held:
            yield pd.DataFrame(held, columns=names, dtype=object)

    return map_frames(runs.repartitionByRange("url_key", "captured", "page_id", "place"), run, runs.schema)


def round_trip(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Writes the pages to archives, reads them back and returns their merged index."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least)
    return merged_index(stored(read_index(spark, path), "captures"))
