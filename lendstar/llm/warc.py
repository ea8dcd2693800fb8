"""WARC archives with revisit records and a merged capture index.

``write_archives`` writes one record per row to gzip-member archives in a folder
that all executors share, and returns their index.  Every archive is a run:
its index entries are sorted by (URL key, timestamp, id) on the spot.
``merge_index`` deals the runs to ranges of that order (a key with very many
captures may span ranges) and merges each range's runs with a loser tree, so
the histories come out globally ordered; a merge task holds about
``RANGE_ROWS`` entries.  ``read_archives`` fetches records by their place and
parses them again.

Of rows with equal payloads of ``min_bytes`` or more, the one with the largest
id is a response and the others revisit it (a revisit has the headers, the
digest and the length, but not the payload).  Equal payloads are found by
SHA-256, aggregated before the shuffle; the join back can be split when skewed.

A task writes to names of its own attempt and returns them with the entries, so
a repeated or lost task leaves at most files that no index names.

Defined results: null payload is empty; null URL has the key "" and no target
header; null timestamp is ``EPOCH``; a null id sorts below every id and comes
back null; rows that repeat an id and its payload are all responses if one is.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.llm.common import read_table, stored, text_or_empty
from lendstar.session import work_path

EPOCH = 1_704_067_200  # 2024-01-01T00:00:00Z
RUN_RECORDS = 20_000
RANGE_ROWS = 100_000
INDEX = "url_key string, ts long, id long, file string, offset long, length long"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or path, and the path in it."""
    m = re.match(r"file:/+(.*)", uri)
    if m:
        return pafs.LocalFileSystem(), "/" + m[1]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def url_key(url: str | None) -> str:
    """Host labels from the right, then path and query, lower case."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^#]*)", (url or "").strip().lower())
    if not m:
        return (url or "").strip().lower()
    host, _, port = m[1].partition(":")
    labels = host.removeprefix("www.").split(".")[::-1]
    return ",".join(labels) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (m[2] or "/")


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _date(ts: int) -> str:
    return datetime.fromtimestamp(ts, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(i: int | None) -> str:
    return f"<urn:page:{'none' if i is None else i}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n\x00]+", " ", value)


def record(i: int | None, url: str | None, ts: int, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit if it refers to another one."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(i)),
            ("WARC-Date", _date(ts)), ("WARC-Payload-Digest", "sha1:" + payload_digest(payload))]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile",
                 "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    block = http + (payload if refers_to is None else b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass")
    return b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers, payload bytes, digest and type of one record; checks the digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    h = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[:int(h["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    number = lambda k: None if h[k] == record_id(None) else int(h[k][len("<urn:page:"):-1])
    size = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    if h["warc-type"] == "response":
        if payload_digest(body) != digest:
            raise ValueError(f"digest of {h['warc-record-id']} differs")
        size = len(body)
    return {"id": number("warc-record-id"), "url": h.get("warc-target-uri"), "date": h["warc-date"],
            "payload_bytes": size, "payload_digest": digest, "record_type": h["warc-type"],
            "refers_to": number("warc-refers-to") if "warc-refers-to" in h else None,
            "payload": body if h["warc-type"] == "response" else None}


def _index_order(e: tuple) -> tuple:
    return e[0], e[1], e[2] is not None, e[2] or 0


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(folder)
        task = TaskContext.get()
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        out, entries, at, runs = None, [], 0, 0

        def finish() -> pa.RecordBatch:
            out.close()
            entries.sort(key=_index_order)
            cols = list(zip(*entries))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=[c.split()[0] for c in INDEX.split(", ")])

        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                for i, url, ts, html, refers in zip(*[c.to_pylist() for c in whole.slice(lo, 256).columns]):
                    if out is None:
                        fs.create_dir(top, recursive=True)
                        name = f"run-{stem}-{runs}.warc.gz"
                        out, entries, at, runs = fs.open_output_stream(f"{top}/{name}", compression=None), [], 0, runs + 1
                    data = gzip.compress(record(i, url, ts, (html or "").encode("utf-8", "surrogatepass"), refers), 6, mtime=0)
                    out.write(data)
                    entries.append((url_key(url), ts, i, name, at, len(data)))
                    at += len(data)
                    if len(entries) == RUN_RECORDS:
                        yield finish()
                        out = None
        if out is not None:
            yield finish()

    return run


def revisits(rows: DataFrame, min_bytes: int) -> DataFrame:
    """``rows`` (id, url, ts, html) with ``refers_to``: null for responses."""
    keyed = rows.withColumn("same", F.when(F.octet_length("html") >= min_bytes, F.sha2("html", 256)))
    last = keyed.filter("same IS NOT NULL").groupBy("same").agg(F.max("id").alias("last"), F.count("*").alias("n"))
    last = last.filter("n > 1").drop("n")
    out = keyed.join(last, "same", "left")
    return out.select("id", "url", "ts", "html", F.when(~F.col("id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", ts: Column | None = None, min_bytes: int = 0) -> DataFrame:
    """Writes the archives; returns their index (``INDEX``), sorted within each run."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.lit(EPOCH) if ts is None else ts.cast("long"), F.lit(EPOCH)).cast("long").alias("ts"),
                     text_or_empty(F.col(payload_col).cast("string")).alias("html"))
    written = revisits(rows, min_bytes).mapInArrow(_write(folder), INDEX)
    return stored(written, "warc-index")


class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, the winner is on
    top; replacing the winner replays one path of log2(k) matches."""

    def __init__(self, runs: list[Iterator], key):
        self.key, self.runs = key, [iter(r) for r in runs]
        self.k = len(runs)
        self.heads = [self._pull(i) for i in range(self.k)]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _pull(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (self.key(row), row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x[0], a) < (y[0], b))

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            if self.tree[node] == -1:
                self.tree[node] = i
                return
            if self._beats(self.tree[node], i):
                self.tree[node], i = i, self.tree[node]
            node //= 2
        self.tree[0] = i

    def __iter__(self):
        while self.k and self.heads[self.tree[0]] is not None:
            i = self.tree[0]
            yield self.heads[i][1]
            self.heads[i] = self._pull(i)
            self._play(i)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's entries, run after run, each run sorted: merged."""
    runs: dict[str, list] = {}
    schema = None
    for b in batches:
        schema = b.schema
        for row in zip(*[c.to_pylist() for c in b.columns]):
            runs.setdefault(row[3], []).append(row)
    rows: list = []
    for row in LoserTree(list(runs.values()), _index_order):
        rows.append(row)
        if len(rows) == 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def merge_index(index: DataFrame) -> DataFrame:
    """The index in global order of (URL key, timestamp, id): partition after
    partition, row after row."""
    ranges = max(1, -(-index.count() // RANGE_ROWS))
    ordered = ["url_key", "ts", F.col("id").asc_nulls_first()]
    parts = index.repartitionByRange(ranges, *ordered)
    return parts.sortWithinPartitions("file", *ordered).mapInArrow(_merge, INDEX)


def _read(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(folder)
        name, source = None, None
        names = ["id", "url", "date", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                rows = []
                for file, offset, length in zip(*[c.to_pylist() for c in whole.slice(lo, 256).columns]):
                    if file != name:
                        name, source = file, fs.open_input_file(f"{top}/{file}")
                    r = parse(gzip.decompress(source.read_at(length, offset)))
                    rows.append(tuple(r[n] if payloads or n != "payload" else None for n in names))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def read_archives(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names, read back from the archives in ``folder``."""
    places = index.select("file", "offset", "length")
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return places.mapInArrow(_read(folder, payloads), (
        "id long, url string, date string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per page, written, indexed, merged and read back."""
    pages = read_table(spark, sf_dir, "pages")
    folder = work_path(spark, "warc")
    index = write_archives(pages, folder, ts=F.col("page_id") + EPOCH)
    merged = stored(merge_index(index), "warc-merged")
    return read_archives(merged, folder, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
