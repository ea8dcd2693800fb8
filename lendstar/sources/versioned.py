"""Versioned parquet publish: write a new version, readers see it only once
it is committed.

``base/v=N`` folders hold successive versions.  A version is current when it
is the highest one with the ``_SUCCESS`` marker Spark writes at job commit, so
a failed or interrupted write (lost executors, killed job) never replaces the
previous version and a re-run simply writes the next number.  Overwriting the
folder being read is never needed, which plain parquet cannot do safely.

A number is claimed before anything is written, by a file that only one writer
can create.  A writer that builds on a version names it (``after``): it stops
with ``ConcurrentPublish`` when a later version is there or under way, so its
result never hides another's.  A claim whose writer died is passed over after
``CLAIM_HOURS``.

Keyed tables are cut into a fixed number of buckets by a hash of the key
(``publish_buckets``).  A version then lists the folder of each bucket, in its
own folder or an earlier version's: an update writes the buckets it changes and
lists the others where they are.

Monthly tables are one dataset partitioned by ``yyyymm``; a filter on the
month prunes to that folder.
"""

from __future__ import annotations

import json
import time
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstar.session import COMPRESSION
from lendstar.sources.files import _fs

MARKER = "_SUCCESS"
LISTING = "_buckets.json"
CLAIMS = "_claims"
CLAIM_HOURS = 24
BUCKET = "bucket"
DEAL = "__deal"


class ConcurrentPublish(RuntimeError):
    """Another writer publishes, or has published, a version after the same one."""


def _versions(spark: SparkSession, base: str) -> tuple[list[int], list[int]]:
    """(all version numbers, committed version numbers) under ``base``."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return [], []
    every, done = [], []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            n = int(name[2:])
            every.append(n)
            if fs.exists(st.getPath().suffix("/" + MARKER)):
                done.append(n)
    return sorted(every), sorted(done)


def current_version(spark: SparkSession, base: str) -> int:
    """Highest committed version, 0 when there is none."""
    _, done = _versions(spark, base)
    return done[-1] if done else 0


def _claims(spark: SparkSession, base: str) -> dict[int, float]:
    """Version number -> hours since it was claimed."""
    fs, p = _fs(spark, f"{base.rstrip('/')}/{CLAIMS}")
    if not fs.exists(p):
        return {}
    now = time.time() * 1000
    return {int(st.getPath().getName()): (now - st.getModificationTime()) / 3.6e6 for st in fs.listStatus(p)}


def claim(spark: SparkSession, base: str, after: int | None = None) -> int:
    """The next version number, taken by this writer alone."""
    base = base.rstrip("/")
    while True:
        every, done = _versions(spark, base)
        claimed = _claims(spark, base)
        if after is not None:
            busy = [v for v, hours in claimed.items() if v > after and v not in done and hours < CLAIM_HOURS]
            if busy or (done and done[-1] > after):
                raise ConcurrentPublish(f"{base}: v={max([*busy, *done])} after v={after}")
        n = max([0, *every, *claimed]) + 1
        fs, p = _fs(spark, f"{base}/{CLAIMS}/{n}")
        try:
            fs.create(p, False).close()  # fails if the file is there
        except Exception:  # noqa: BLE001 - taken meanwhile, or no folder to write to
            if not fs.exists(p):
                raise
            continue
        if after is not None and any(after < v < n and h < CLAIM_HOURS and v not in _versions(spark, base)[1]
                                     for v, h in _claims(spark, base).items()):
            release(spark, base, n)
            raise ConcurrentPublish(f"{base}: another writer is under way after v={after}")
        return n


def release(spark: SparkSession, base: str, n: int) -> None:
    fs, p = _fs(spark, f"{base.rstrip('/')}/{CLAIMS}/{n}")
    fs.delete(p, False)


def publish(df: DataFrame, base: str, partition_by: list[str] | None = None, after: int | None = None) -> str:
    """Write ``df`` as the next version of ``base`` and return its path."""
    spark = df.sparkSession
    n = claim(spark, base, after)
    path = f"{base.rstrip('/')}/v={n}"
    w = df.write.mode("errorifexists").option("compression", COMPRESSION)
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.parquet(path)
    finally:
        release(spark, base, n)
    return path


# ----------------------------------------------------------------- buckets

class Buckets(NamedTuple):
    """What a version lists: the key, the number of buckets, the folder of each
    bucket that has rows (relative to the table's), the columns and, of a table
    kept up from another, that one's version."""

    version: int
    key: str
    count: int
    paths: dict[int, str]
    schema: T.StructType
    source: int | None = None


def bucket_of(key: str, count: int) -> Column:
    return F.coalesce((F.crc32(F.col(key).cast("string").cast("binary")) % count).cast("int"), F.lit(0))


def dealt(df: DataFrame, key: str, count: int, spread: list[str] | None = None) -> DataFrame:
    """``df`` with ``BUCKET`` and ``DEAL``, shuffled by them: a bucket in as many
    shares (by ``spread``, the key by default) as give each shuffle partition about
    one.  Windows and groups by ``DEALT`` and what the rows are spread by don't move
    them again, and tasks write few files."""
    shares = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // count)
    return (df.withColumn(BUCKET, bucket_of(key, count))
            .withColumn(DEAL, F.pmod(F.xxhash64(*(spread or [key])), F.lit(shares))).repartition(BUCKET, DEAL))


DEALT = [BUCKET, DEAL]
PASSES = 8  # a power of two
PASS_BYTES = 128 << 20  # of the files that a pass's rows come from
FEWER = PASSES // 2  # where each pass reads all files anew


def bytes_read(df: DataFrame) -> int:
    """Size of the files that ``df`` reads, as far as Spark knows it."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(s for s in sizes if s < 1 << 62)  # more: Spark doesn't know


def passes(buckets: list[int], count: int, *read: DataFrame, most: int = PASSES) -> list[list[int]]:
    """``buckets`` of ``count`` in the groups in which rows of ``read`` are shuffled, a
    group after the other: of a large table, shuffle files hold one part in ``most``
    of the rows at a time."""
    n, size = 1, sum(map(bytes_read, read))
    while n < most and count % (2 * n) == 0 and n * PASS_BYTES < size:
        n *= 2
    return [g for g in ([b for b in buckets if b % n == i] for i in range(n)) if g] or [[]]


def in_pass(df: DataFrame, key: str, count: int, group: list[int], groups: list[list[int]]) -> DataFrame:
    """The rows of a pass; all rows if it's the only one."""
    return df.filter(bucket_of(key, count).isin(group)) if len(groups) > 1 else df


def bucket_listing(spark: SparkSession, base: str, version: int | None = None) -> Buckets | None:
    """The listing of a version (the current one by default); ``None`` if it has none."""
    n = version or current_version(spark, base)
    fs, p = _fs(spark, f"{base.rstrip('/')}/v={n}/{LISTING}")
    if not n or not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        d = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Buckets(n, d["key"], d["count"], {int(k): v for k, v in d["paths"].items()},
                   T.StructType.fromJson(d["schema"]), d.get("source"))


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def publish_buckets(df: DataFrame, base: str, key: str, count: int, keep: Buckets | None = None,
                    buckets: list[int] | None = None, source: int | None = None,
                    more: list[DataFrame] | None = None) -> Buckets:
    """Write ``df`` as the next version, cut into ``count`` buckets.

    With ``keep`` the version builds on that one: ``df`` holds all rows of
    ``buckets``, which are written, and the others are listed where they are.
    Rows are gathered by bucket first, unless they are ``dealt`` and so carry their
    ``BUCKET``; REBALANCE lets a large bucket have many files.  Frames of ``more``
    hold rows of other buckets and are written after it, one at a time.  The marker
    comes last, so a failed write is never current.
    """
    spark, base, parts = df.sparkSession, base.rstrip("/"), [df, *(more or [])]
    df = df.drop(BUCKET)
    n = claim(spark, base, keep.version if keep else None)
    try:
        path = f"{base}/v={n}"
        for i, cut in enumerate(parts):
            if BUCKET not in cut.columns:
                cut = cut.withColumn(BUCKET, bucket_of(key, count)).hint("rebalance", BUCKET)
            (cut.write.mode("append" if i else "errorifexists")
             .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
             .option("compression", COMPRESSION).partitionBy(BUCKET).parquet(path))
        fs, p = _fs(spark, path)
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        paths = {int(x.split("=")[1]): f"v={n}/{x}" for x in names if x.startswith(f"{BUCKET}=")}
        if keep:
            paths = {**{b: x for b, x in keep.paths.items() if b not in (buckets or ())}, **paths}
        out = Buckets(n, key, count, paths, df.schema, source)
        _put(spark, f"{path}/{LISTING}", json.dumps({"key": key, "count": count, "schema": df.schema.jsonValue(),
                                                     "paths": paths, "source": source}))
        _put(spark, f"{path}/{MARKER}", "")
    finally:
        release(spark, base, n)
    return out


def read_buckets(spark: SparkSession, base: str, listing: Buckets, only: list[int] | None = None) -> DataFrame:
    """The rows of a listed version, of the buckets ``only`` if given."""
    paths = [f"{base.rstrip('/')}/{x}" for b, x in sorted(listing.paths.items()) if only is None or b in set(only)]
    reader = spark.read.schema(listing.schema)
    return reader.parquet(*paths) if paths else spark.createDataFrame([], listing.schema)


def _in_use(spark: SparkSession, base: str, versions: list[int]) -> set[str]:
    """Bucket folders that these versions list."""
    found = (bucket_listing(spark, base, v) for v in versions)
    return {x for b in found if b for x in b.paths.values()}


def retire(spark: SparkSession, base: str, keep: int) -> list[int]:
    """Remove all committed versions but the last ``keep``; a retired version's
    buckets that a kept one lists stay.  Returns the retired numbers."""
    _, done = _versions(spark, base)
    old, used = done[:-keep] if keep else [], _in_use(spark, base, done[-keep:])
    fs, p = _fs(spark, base)
    for v in old:
        folder = p.suffix(f"/v={v}")
        fs.delete(folder.suffix(f"/{MARKER}"), False)  # from here on no reader starts on it
        for st in fs.listStatus(folder):
            if f"v={v}/{st.getPath().getName()}" not in used:
                fs.delete(st.getPath(), True)
        if not fs.listStatus(folder):
            fs.delete(folder, True)
    return old


def remove_failed(spark: SparkSession, base: str) -> list[int]:
    """Delete the versions below the current one's number that never committed."""
    fs, p = _fs(spark, base)
    every, done = _versions(spark, base)
    failed = [v for v in every if v not in done and done and v < done[-1]]
    if failed:  # not those of a writer under way, nor retired ones whose buckets are listed
        used = {x.split("/")[0] for x in _in_use(spark, base, done)}
        busy = {v for v, hours in _claims(spark, base).items() if hours < CLAIM_HOURS}
        failed = [v for v in failed if v not in busy and f"v={v}" not in used]
    for v in failed:
        fs.delete(p.suffix(f"/v={v}"), True)
    return failed


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    v = current_version(spark, base)
    if not v:
        return None
    listing = bucket_listing(spark, base, v)
    if listing:
        df = read_buckets(spark, base, listing)
        return df.drop(*[c for c in df.columns if c.startswith("__")])
    return spark.read.parquet(f"{base.rstrip('/')}/v={v}")


def write_by_month(df: DataFrame, path: str, date_col: str, mode: str = "overwrite") -> None:
    """Dataset partitioned by ``yyyymm`` of ``date_col`` (dynamic overwrite:
    re-writing a month replaces that month only).

    Rows are gathered by month first, so a month has a few files instead of one
    per task; REBALANCE lets adaptive execution split a month that holds much.
    """
    (df.withColumn("yyyymm", F.date_format(F.col(date_col), "yyyyMM").cast("int"))
     .hint("rebalance", "yyyymm")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("yyyymm").parquet(path))


def read_month(spark: SparkSession, path: str, yyyymm: int) -> DataFrame:
    """Rows of one month; the partition filter prunes the other folders."""
    return spark.read.parquet(path).filter(F.col("yyyymm") == F.lit(int(yyyymm)))
