"""Repeated passages by bucket-pointer refinement of a sparse suffix array.

A byte goes when a ``window``-byte string that covers it also starts anywhere
else, in the same document or another one.  Strings never cross documents and
are judged on the input.

Bucket identifiers are hashes, so a bucket has the same identifier everywhere
without a global numbering: the identifier of a 2k-gram is made of the
identifiers of the k-gram at the same place and of the one k later, and every
length from 1 to ``window`` reuses the one before.

1. Initial buckets.  Of the q-grams that start in a window's reach, the one with
   the smallest identifier names the window's bucket.  Equal windows choose the
   same q-gram at the same offset, so they share a bucket; neighbouring windows
   choose the same occurrence, so a run of windows is one suffix-array entry
   (one in about 76 bytes).
2. Entries are sorted by (bucket, identifier of the run's whole string).  Equal
   neighbours are repeated in full.  Entries alone in their bucket are unique
   and leave.  What shares a bucket but not the string is refined again, with
   one entry or two for each repeated string of the bucket.
3. The refined entries fetch their bytes, and their single windows are sorted by
   the identifier of all ``window`` bytes, made from the identifiers at later
   offsets as above.  Equal neighbours are repeated.

Only neighbours in sort order are compared, so a bucket of any size costs no
more per entry: step 2 is a range partition over bucket, string, document and
place that may cut a bucket in two (each partition's first and last entry are
settled afterwards), and the same sort serves step 3 for buckets over
``HOT_RUNS`` entries; smaller ones are compared where their bytes meet.

Defined results: null text is empty; a text shorter than the window keeps all
its bytes.  A row repeated with the same id and text is a second place.  Rows
that share an id but not the text are told apart by a text tag; null ids too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstar.llm.common import fresh_names, read_table, stored
from lendstar.llm.minhash import mix64
from lendstar.llm.units import release_memory

WINDOW = 200
Q = 48
HOT_RUNS = 2000
CHUNK = 1 << 20

_U = np.uint64
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_KEY = "id long, tag int, start int, n int"


class Buckets:
    """Identifiers of the k-grams of a byte buffer, each length made from shorter ones."""

    def __init__(self, buf, seed: int = 0):
        self.seed = seed
        self.by_len = {1: mix64(_BYTE + _U(seed))[np.frombuffer(buf, dtype=np.uint8)]}

    def _factor(self, a: int, b: int) -> np.uint64:
        return mix64(np.array([a * 4096 + b + (self.seed << 32)], dtype=np.uint64))[0] | _U(1)

    def ids(self, k: int) -> np.ndarray:
        if k not in self.by_len:
            half = 1 << (k - 1).bit_length() - 1  # the largest power of two below k
            a, b = self.ids(half), self.ids(k - half)
            n = max(0, len(self.by_len[1]) - k + 1)
            self.by_len[k] = a[:n] * self._factor(half, k - half) + b[half:half + n]
        return self.by_len[k]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        x, k = np.minimum(x[:-k], x[k:]), 2 * k
    return np.minimum(x[:len(x) - (width - k)], x[width - k:]) if width > k else x


def _chunks(ids: list, texts: list) -> Iterator[tuple[list, bytes, np.ndarray, np.ndarray]]:
    """Documents gathered to about CHUNK bytes, longer ones cut with overlap:
    ((id, tag) list, buffer, each part's document, its length and place)."""
    keys, parts, size = [], [], 0
    for i, text in zip(ids, texts):
        b = (text or "").encode("utf-8", "surrogatepass")
        if len(b) < WINDOW:
            continue
        key = (i, text_tag(b))
        for at in range(0, len(b) - WINDOW + 1, CHUNK):
            part = b[at:at + CHUNK + WINDOW - 1]
            keys.append((*key, at))
            parts.append(part)
            size += len(part)
        if size >= CHUNK:
            yield keys, parts
            keys, parts, size = [], [], 0
    if parts:
        yield keys, parts


def text_tag(b: bytes) -> int:
    return int(np.uint32(xxhash.xxh32_intdigest(b)).view(np.int32))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, string, id, tag, start, n) of every run of n windows."""
    release_memory()
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            b = batch.slice(lo, 512)
            for keys, parts in _chunks(b.column(0).to_pylist(), b.column(1).to_pylist()):
                buf = b"".join(parts)
                lens = np.array([len(p) for p in parts])
                ends = np.cumsum(lens)
                q = mix64(Buckets(buf).ids(Q))
                m = sliding_min(q, WINDOW - Q + 1)
                n = len(m)
                part = np.repeat(np.arange(len(parts)), lens)[:n]
                valid = np.arange(n) + WINDOW <= ends[part]
                new = np.ones(n, dtype=bool)
                # another smallest q-gram, or its occurrence has left the window
                new[1:] = (m[1:] != m[:-1]) | (q[:n - 1] == m[:-1]) | (part[1:] != part[:-1])
                stops = np.flatnonzero(new | ~valid)
                first = np.flatnonzero(new & valid)
                last = np.append(stops, n)[np.searchsorted(stops, first) + 1]
                view = memoryview(buf)
                string = np.fromiter((xxhash.xxh3_64_intdigest(view[a:z + WINDOW - 1])
                                      for a, z in zip(first.tolist(), last.tolist())),
                                     dtype=np.uint64, count=len(first))
                at = first - (ends - lens)[part[first]] + np.array([k[2] for k in keys])[part[first]]
                pick = part[first].tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(m[first].view(np.int64)), pa.array(string.view(np.int64)),
                    pa.array([keys[p][0] for p in pick], pa.int64()), pa.array([keys[p][1] for p in pick], pa.int32()),
                    pa.array(at.astype(np.int32)), pa.array((last - first).astype(np.int32))],
                    names=["bucket", "string", "id", "tag", "start", "n"])


_FIRST, _LAST = 1, 2
_REPEATED, _REFINE = 1, 2


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, string).  kind has bit 1 if a neighbour is equal in
    both, bit 2 if one is equal in the bucket only: so of many equal strings the
    outermost stand for all when others of the bucket are refined.  The
    partition's first and last row are marked."""
    part = TaskContext.get().partitionId()
    held: pa.Table | None = None   # the last row so far
    before = None                  # (bucket, string) in front of it

    def judge(t: pa.Table, prev, nxt, edge_first: bool, edge_last: bool) -> pa.RecordBatch:
        k = np.column_stack([t["bucket"].to_numpy(), t["string"].to_numpy()])
        up = np.vstack([k[:1] if prev is None else [prev], k[:-1]])
        down = np.vstack([k[1:], k[-1:] if nxt is None else [nxt]])
        sb_u, sb_d = up[:, 0] == k[:, 0], down[:, 0] == k[:, 0]
        ss_u, ss_d = sb_u & (up[:, 1] == k[:, 1]), sb_d & (down[:, 1] == k[:, 1])
        if prev is None:
            sb_u[0] = ss_u[0] = False
        if nxt is None:
            sb_d[-1] = ss_d[-1] = False
        kind = (_REPEATED * (ss_u | ss_d) + _REFINE * ((sb_u & ~ss_u) | (sb_d & ~ss_d))).astype(np.int32)
        edge = np.zeros(len(k), dtype=np.int32)
        edge[0] |= _FIRST * edge_first
        edge[-1] |= _LAST * edge_last
        t = t.append_column("kind", pa.array(kind)).append_column("edge", pa.array(edge))
        t = t.append_column("part", pa.array(np.full(len(k), part, dtype=np.int32)))
        return t.filter(pa.array((kind > 0) | (edge > 0))).combine_chunks()

    first = True
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t])
        n = t.num_rows
        key = lambda i: (t["bucket"][i].as_py(), t["string"][i].as_py())  # noqa: E731, B023
        if n > 1:
            yield from judge(t.slice(0, n - 1), before, key(n - 1), first, False).to_batches()
            before, first = key(n - 2), False
        held = t.slice(n - 1)
    if held is not None:
        yield from judge(held, before, None, first, True).to_batches()


def sorted_neighbours(df: DataFrame) -> DataFrame:
    """(bucket, id, tag, start, n, kind) of the entries that equal another one."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["bucket", "string", "id", "tag", "start"]
    out = f"bucket long, string long, {_KEY}, kind int, edge int, part int"
    judged = stored(df.select("bucket", "string", "id", "tag", "start", "n")
                    .repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .mapInArrow(_neighbours, out), "neighbours")
    # Two rows a partition: compared with the next partition's first row here.
    edges = [r.asDict() for r in judged.filter("edge > 0").orderBy("part", "edge").collect()]
    for a, b in zip(edges, edges[1:]):
        if a["part"] != b["part"] and a["bucket"] == b["bucket"]:
            for r in (a, b):
                r["kind"] |= _REPEATED if a["string"] == b["string"] else _REFINE
    settled = spark.createDataFrame([r for r in edges if r["kind"]], out)
    keep = ["bucket", "id", "tag", "start", "n", "kind"]
    return judged.filter("edge = 0").select(*keep).unionByName(settled.select(*keep))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tag, compressed bytes): what the joins with spans move."""
    z = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            b = batch.slice(lo, 512)
            data = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([text_tag(d) for d in data], pa.int32()),
                 pa.array([z.compress(d) for d in data], pa.binary())], names=["id", "tag", "z"])


def _bytes_of(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the runs to refine; for hot buckets the windows' identifiers."""
    names = ["bucket", "string", "id", "tag", "start", "n", "raw"]
    kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary()]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = []
            for r in batch.slice(lo, 256).to_pylist():
                data = _bytes_of(r["z"])
                for s in r["spans"]:
                    raw = data[s["start"]:s["start"] + s["n"] + WINDOW - 1]
                    if not s["hot"]:
                        rows.append((s["bucket"], 0, r["id"], r["tag"], s["start"], s["n"], raw))
                        continue
                    one, two = (mix64(Buckets(raw, seed).ids(WINDOW)).view(np.int64).tolist() for seed in (1, 2))
                    rows += [(a, b, r["id"], r["tag"], s["start"] + i, 1, None)
                             for i, (a, b) in enumerate(zip(one, two))]
            for at in range(0, len(rows), 20_000):
                cols = list(zip(*rows[at:at + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by bucket, bytes at hand: the windows that occur twice."""
    held: list[pa.Table] = []

    def windows(t: pa.Table) -> Iterator[pa.RecordBatch]:
        raws = t["raw"].to_pylist()
        lens = np.array([len(r) for r in raws])
        buf = b"".join(raws)
        ids = mix64(Buckets(buf, 1).ids(WINDOW))
        run = np.repeat(np.arange(len(raws)), lens)[:len(ids)]
        begin = np.cumsum(lens) - lens
        ok = np.arange(len(ids)) + WINDOW <= (begin + lens)[run]
        at = np.flatnonzero(ok)
        order = at[np.argsort(ids[at], kind="stable")]
        same = ids[order][1:] == ids[order][:-1]
        twice = np.zeros(len(ids) + 1, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        # consecutive repeated windows of a run become one span
        on = twice[:-1]
        head = on & np.r_[True, ~on[:-1] | (run[1:] != run[:-1])] if len(on) else on
        first = np.flatnonzero(head)
        brk = np.flatnonzero(head | ~on)
        last = np.append(brk, len(on))[np.searchsorted(brk, first) + 1]
        src = t.select(["id", "tag"]).take(pa.array(run[first]))
        start = t["start"].to_numpy()[run[first]] + first - begin[run[first]]
        out = src.append_column("start", pa.array(start.astype(np.int32))).append_column(
            "n", pa.array((last - first).astype(np.int32)))
        yield from out.combine_chunks().to_batches()

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        buckets = t["bucket"].to_numpy()
        cut = int(np.searchsorted(buckets, buckets[-1]))  # the last bucket may go on
        if cut:
            yield from windows(pa.concat_tables([*held, t.slice(0, cut)]))
            held = []
        held.append(t.slice(cut))
    if held:
        yield from windows(pa.concat_tables(held))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, start, n): runs of n window starts whose strings are repeated."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = sorted_neighbours(src.mapInArrow(_runs, f"bucket long, string long, {_KEY}"))
    keep = ["id", "tag", "start", "n"]
    refine = found.filter(F.col("kind").bitwiseAND(_REFINE) > 0)
    full = F.col("kind").bitwiseAND(_REPEATED) > 0
    hot = refine.groupBy("bucket").count().filter(F.col("count") > HOT_RUNS).select("bucket", F.lit(True).alias("hot"))
    spans = refine.join(hot, "bucket", "left").groupBy("id", "tag").agg(F.collect_list(F.struct(
        "bucket", "start", "n", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("spans"))
    spans = spans.select(F.col("id").alias("sid"), F.col("tag").alias("stag"), "spans")
    packed = src.filter(F.octet_length("text") >= WINDOW).mapInArrow(_packed, "id long, tag int, z binary").distinct()
    fetched = packed.join(spans, F.col("id").eqNullSafe(F.col("sid")) & (F.col("tag") == F.col("stag")))
    fetched = stored(fetched.select("id", "tag", "z", "spans").mapInArrow(
        _fetch, f"bucket long, string long, {_KEY}, raw binary"), "refine")
    cold = (fetched.filter("raw IS NOT NULL").repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_compare, _KEY))
    single = sorted_neighbours(fetched.filter("raw IS NULL").drop("raw")).filter(full)
    return (found.filter(full).select(*keep)
            .unionByName(cold).unionByName(single.select(*keep)))


def covered(spans: list, size: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by the windows of ``spans``."""
    out: list[list[int]] = []
    for s, n in sorted(spans):
        end = min(size, s + n + WINDOW - 1)
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([s, end])
    return [(a, b) for a, b in out]


def _cut_out(others: int, names: list[str]):
    """Rows (others..., id, tag, z, spans) -> (others..., the four results)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                rows = []
                for z, spans in zip(b.column(others).to_pylist(), b.column(others + 1).to_pylist()):
                    data = _bytes_of(z)
                    gone = covered([(s["start"], s["n"]) for s in spans or ()], len(data))
                    kept, at = [], 0
                    for x, y in gone:
                        kept.append(data[at:x])
                        at = y
                    kept.append(data[at:])
                    rows.append((len(data), sum(y - x for x, y in gone), len(gone), b"".join(kept)))
                kinds = [pa.int64()] * 3 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:others], *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]], names=names)

    return run


def _packed_rows(others: list[int], i: int, t: int, names: list[str]):
    z = lambda d: zstandard.ZstdCompressor(level=3).compress(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                data = [(x or "").encode("utf-8", "surrogatepass") for x in b.column(t).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(k) for k in others], b.column(i).cast(pa.int64()),
                     pa.array([text_tag(d) for d in data], pa.int32()), pa.array([z(d) for d in data], pa.binary())],
                    names=names)

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without the text, with ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept``: the bytes that stay, concatenated (a cut may fall
    within a character).  Columns of these names are replaced."""
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    others = [f for f in df.schema.fields if f.name != text_col and f.name.lower() not in results]
    i, t, z, si, st, sp = fresh_names(df, "id", "tag", "z", "sid", "stag", "spans")
    spans = stored(repeated_spans(df, id_col, text_col), "spans").groupBy("id", "tag").agg(
        F.collect_list(F.struct("start", "n")).alias(sp)).withColumnsRenamed({"id": si, "tag": st})
    kinds = T.StructType([*others, T.StructField(i, T.LongType()), T.StructField(t, T.IntegerType()),
                          T.StructField(z, T.BinaryType())])
    at = {c: k for k, c in enumerate(df.columns)}
    packed = df.mapInArrow(_packed_rows([at[f.name] for f in others], at[id_col], at[text_col], kinds.names), kinds)
    joined = packed.join(spans, F.col(i).eqNullSafe(F.col(si)) & (F.col(t) == F.col(st)), "left")
    out = T.StructType([*others, *[T.StructField(c, T.LongType()) for c in results[:3]],
                        T.StructField("kept", T.BinaryType())])
    return joined.select(*[f.name for f in others], z, sp).mapInArrow(_cut_out(len(others), out.names), out)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without bytes covered by a repeated 200-byte string."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
