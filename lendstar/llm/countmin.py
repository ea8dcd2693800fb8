"""Removal of repeated word windows behind a count-min sketch.

A word goes when a window of ``WINDOW`` consecutive words that covers it also
starts in a document with a smaller id.  Windows are judged on the input.

Documents are gathered into chunks of about ``CHUNK`` bytes, stored compressed;
a window is named by 128 bits made of its words' 128-bit hashes.

1. Sketches.  The count-min sketch has two rows of cells; its cells are dealt to
   shards by the window's hash, ``SHARD`` windows a shard, so its width grows
   with the input and no task holds more than one shard.  A chunk's sketch is
   its nonempty cells, sorted, as compressed differences (under two bytes a
   window and row): a cell holds one, or "two and more".
2. Merge.  The chunks' sketches of a shard are added up; every chunk is told
   which of its cells hold two or more, one bit a cell.  A window's estimate is
   the smaller of its two cells and never too low, so a window in two documents
   is always told.
3. Exact groups.  Each chunk looks its windows up in the bits it was sent, and
   sends those estimated repeated, each window once with its smallest document,
   to the shard that groups it; the answer is the smallest document of all.
4. Cut.  Windows whose smallest document is smaller than their own cover the
   words that go.

A window that a third of the documents share travels once a chunk.  Long texts
are cut into words a megabyte at a time.

Defined results: null or empty text has no words; fewer words than a window
stay.  Rows that share an id are one document: none is smaller than the other.
Rows with a null id keep all words and count for no one.  An empty table gives
no rows.  Other columns are kept; columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

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

WINDOW = 13
CHUNK = 8 << 20
SHARD = 1 << 21
CELLS = 8 * SHARD        # cells of a row in a shard
WORD_BYTES = 6           # of a usual word and its space; two bytes at least, so a shard gets three times SHARD at most
PIECE = 1 << 20
RESULTS = ["n_words", "n_removed", "kept"]

_U = np.uint64
_SPACE = re.compile(rb"[ \t-\r]")
_MULT = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))


def pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut at white space into pieces of about PIECE bytes."""
    at = 0
    while len(data) - at > PIECE:
        cut = _SPACE.search(data, at + PIECE)
        if cut is None:
            break
        yield data[at:cut.start()]
        at = cut.end()
    yield data[at:] if at else data


def word_hashes(data: bytes) -> np.ndarray:
    """Two 64-bit hashes of every word."""
    digests = b"".join(d for piece in pieces(data) for d in map(xxhash.xxh3_128_digest, piece.split()))
    return np.frombuffer(digests, dtype=np.uint64).reshape(-1, 2)


def window_names(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of every window, each made of its own hashes of the words."""
    n = max(0, len(words) - size + 1)
    both = []
    for m, own in zip(_MULT, np.ascontiguousarray(words.T)):
        acc = np.zeros(n, dtype=np.uint64)
        for i in range(size if n else 0):
            acc = acc * m + own[i:i + n]
        both.append(mix64(mix64(acc) + m))
    return both[0], both[1]


def _squeezed(x: np.ndarray) -> bytes:
    """Sorted or small numbers: differences by byte planes, compressed."""
    step = np.diff(x, prepend=x[:1] * 0) if len(x) else x
    planes = step.view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _spread(z: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), dtype=np.uint8)
    step = np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(step, dtype=kind)


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=n).astype(bool)


class Chunk:
    """Windows of a chunk's documents: names, document ids, first word and places."""

    def __init__(self, ids: list, blob: bytes, lengths: list[int], size: int):
        data = zstandard.ZstdDecompressor().decompress(blob)
        ones, twos, docs, self.words, self.parts = [], [], [], [], []
        at = 0
        for i, n in zip(ids, lengths):
            part = data[at:at + n]
            at += n
            h = word_hashes(part)
            self.parts.append(part)
            self.words.append(len(h))
            one, two = window_names(h if i is not None else h[:0], size)
            ones.append(one)
            twos.append(two)
            docs.append(np.full(len(one), i or 0, dtype=np.int64))
        self.counts = [len(x) for x in ones]
        self.one, self.two, self.doc = (np.concatenate(x) for x in (ones, twos, docs))

    def shards(self, n: int) -> np.ndarray:
        return (self.one >> _U(32)) * _U(n) >> _U(32)

    def cells(self, n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each row of the sketch: sorted (shard << 32 | cell), where each
        window's is in it, and how often it occurs."""
        top = self.shards(n) << _U(32)
        return [np.unique(top | ((x & _U(0xFFFFFFFF)) * _U(CELLS) >> _U(32)), return_inverse=True, return_counts=True)
                for x in (self.one, self.two)]


def _shard_cuts(keys: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Shards of sorted keys and where each one begins and ends."""
    top = (keys >> _U(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(top)) + 1 if len(top) else np.empty(0, dtype=np.int64)
    return top[np.r_[0, cuts]] if len(top) else top, [0, *cuts.tolist(), len(top)]


def _chunked(id_at: int, text_at: int, others: list[int], names: list[str]):
    """Documents to chunks: number, bytes, ids, byte lengths, other columns, texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list[bytes] = []
        rest: list[pa.RecordBatch] = []
        held = 0

        def chunk() -> pa.RecordBatch:
            nonlocal made, held
            own = pa.Table.from_batches(rest).combine_chunks()
            struct = pa.StructArray.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in own.columns],
                                                fields=list(own.schema)) if own.num_columns else None
            cols = [pa.array([(part << 33) + made], pa.int64()), pa.array([held], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64()))]
            if struct is not None:
                cols.append(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), struct))
            cols.append(pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(texts))], pa.binary()))
            made, held = made + 1, 0
            ids.clear()
            texts.clear()
            rest.clear()
            return pa.RecordBatch.from_arrays(cols, names=names)

        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                for i, t in zip(b.column(id_at).to_pylist(), b.column(text_at).to_pylist()):
                    data = (t or "").encode("utf-8", "surrogatepass")
                    ids.append(i)
                    texts.append(data)
                    held += len(data)
                rest.append(b.select(others))
                if held >= CHUNK:
                    yield chunk()
        if ids:
            yield chunk()

    return run


def _sketched(shards: int, size: int):
    """A chunk's sketch: its cells by shard and row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(b.num_rows):
                c = Chunk(*(b.column(k)[n].as_py() for k in ("ids", "z", "lengths")), size)
                rows: dict[int, dict[str, bytes]] = {}
                for row, (keys, _, count) in enumerate(c.cells(shards)):
                    tops, at = _shard_cuts(keys)
                    for s, lo, hi in zip(tops.tolist(), at, at[1:]):
                        own = rows.setdefault(s, {})
                        own[f"cells{row}"] = _squeezed((keys[lo:hi] & _U(0xFFFFFFFF)).astype(np.uint32))
                        own[f"more{row}"] = _bits(count[lo:hi] > 1)
                number = b.column("chunk")[n].as_py()
                for lo in range(0, len(rows), 256):
                    some = list(rows.items())[lo:lo + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s for s, _ in some], pa.int32()), pa.array([number] * len(some), pa.int64()),
                         *[pa.array([r[k] for _, r in some], pa.binary()) for k in ("cells0", "more0", "cells1", "more1")]],
                        names=["shard", "chunk", "cells0", "more0", "cells1", "more1"])

    return run


def _merged(table: pa.Table) -> pa.Table:
    """The sketches of one shard: which of each chunk's cells hold two or more."""
    rows = table.to_pylist()
    told: list[list[bytes]] = []
    for row in (0, 1):
        count = np.zeros(CELLS, dtype=np.uint8)
        cells = [_spread(r[f"cells{row}"], np.uint32) for r in rows]
        for r, at in zip(rows, cells):  # a chunk has a cell once
            count[at] = np.minimum(count[at] + 1 + _flags(r[f"more{row}"], len(at)), 2)
        told.append([_bits(count[at] > 1) for at in cells])
    return pa.table({"shard": pa.array([r["shard"] for r in rows], pa.int32()),
                     "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                     "told0": pa.array(told[0], pa.binary()), "told1": pa.array(told[1], pa.binary())})


def _candidates(c: Chunk, told: list[dict] | None, shards: int) -> np.ndarray:
    """The chunk's windows whose cells hold two or more in both rows."""
    by = {t["shard"]: t for t in told or ()}
    both = np.ones(len(c.one), dtype=bool)
    for row, (keys, inverse, _) in enumerate(c.cells(shards)):
        tops, at = _shard_cuts(keys)
        flags = [_flags(by[s][f"told{row}"], hi - lo) for s, lo, hi in zip(tops.tolist(), at, at[1:])]
        if flags:
            both &= np.concatenate(flags)[inverse.ravel()]
    return np.flatnonzero(both)


class Groups:
    """The candidates of a chunk, each window once, sorted by shard and name."""

    def __init__(self, c: Chunk, told: list[dict] | None, shards: int):
        self.at = _candidates(c, told, shards)
        one, two, self.doc = c.one[self.at], c.two[self.at], c.doc[self.at]
        order = np.lexsort((self.doc, two, one))  # the shard is the top of the first name
        one, two = one[order], two[order]
        new = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])][:len(one)]
        self.one, self.two, self.least = one[new], two[new], self.doc[order][new]
        self.group = np.empty(len(order), dtype=np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.tops, self.cuts = _shard_cuts(((self.one >> _U(32)) * _U(shards) >> _U(32)) << _U(32))


def _asked(shards: int, size: int):
    """The chunk's windows estimated repeated, with their smallest document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "chunk", "one", "two", "least"]
        for b in batches:
            for n in range(b.num_rows):
                c = Chunk(*(b.column(k)[n].as_py() for k in ("ids", "z", "lengths")), size)
                g = Groups(c, b.column("told")[n].as_py(), shards)
                number = b.column("chunk")[n].as_py()
                rows = [(s, number, _squeezed(g.one[lo:hi]), g.two[lo:hi].tobytes(), _squeezed(g.least[lo:hi]))
                        for s, lo, hi in zip(g.tops.tolist(), g.cuts, g.cuts[1:])]
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 3]
                for lo in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(col, k) for col, k in zip(zip(*rows[lo:lo + 256]), kinds)], names=names)

    return run


def _answered(table: pa.Table) -> pa.Table:
    """The windows of one shard, grouped exactly: the smallest document of each."""
    rows = table.to_pylist()
    one = [_spread(r["one"], np.uint64) for r in rows]
    sizes = [len(x) for x in one]
    one = np.concatenate(one)
    two = np.frombuffer(b"".join(r["two"] for r in rows), dtype=np.uint64)
    least = np.concatenate([_spread(r["least"], np.int64) for r in rows])
    order = np.lexsort((least, two, one))
    a, b = one[order], two[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    answer = np.empty(len(order), dtype=np.int64)
    answer[order] = least[order][new][np.cumsum(new) - 1]
    ends = np.cumsum(sizes)
    return pa.table({"shard": pa.array([r["shard"] for r in rows], pa.int32()),
                     "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                     "first": pa.array([_squeezed(answer[hi - n:hi]) for hi, n in zip(ends, sizes)], pa.binary())})


def _cut(shards: int, size: int, others: int, names: list[str]):
    """Chunks with both answers to documents: other columns, counts, kept words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(b.num_rows):
                c = Chunk(*(b.column(k)[n].as_py() for k in ("ids", "z", "lengths")), size)
                g = Groups(c, b.column("told")[n].as_py(), shards)
                first = {r["shard"]: r["first"] for r in b.column("firsts")[n].as_py() or ()}
                least = [_spread(first[s], np.int64) for s in g.tops.tolist()]
                gone = np.zeros(len(c.one), dtype=bool)
                if least:
                    gone[g.at[g.doc > np.concatenate(least)[g.group]]] = True
                kept, removed, at = [], [], 0
                for part, words, count in zip(c.parts, c.words, c.counts):
                    cover = np.zeros(words + 1, dtype=np.int32)
                    starts = np.flatnonzero(gone[at:at + count])
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + size, -1)
                    stay = np.cumsum(cover[:-1]) == 0
                    at += count
                    removed.append(int(words - stay.sum()))
                    out, k = [], 0
                    for piece in pieces(part):
                        w = piece.split()
                        out += w if stay[k:k + len(w)].all() else [x for x, s in zip(w, stay[k:k + len(w)].tolist()) if s]
                        k += len(w)
                    kept.append(b" ".join(out))
                cols = [pa.array(c.words, pa.int64()), pa.array(removed, pa.int64())]
                rest = b.column("rest")[n].values.flatten() if others else []
                for lo in range(0, len(kept), 256):
                    some = [x.slice(lo, 256) for x in (*rest, *cols)]
                    text = pa.array([k.decode("utf-8", "replace") for k in kept[lo:lo + 256]], pa.string())
                    yield pa.RecordBatch.from_arrays([*some, text], names=names)

    return run


def remove_repeated_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            window: int = WINDOW) -> DataFrame:
    """The rows of ``df`` without the text, with ``n_words``, ``n_removed`` and
    ``kept``: the words that stay, joined by one space."""
    others = [f for f in df.schema.fields if f.name != text_col and f.name.lower() not in RESULTS]
    i, t = fresh_names(df, "id", "txt")
    src = df.select(*[f.name for f in others], F.col(id_col).cast("long").alias(i), F.col(text_col).cast("string").alias(t))
    n = len(others)
    kinds = [T.StructField("chunk", T.LongType()), T.StructField("size", T.LongType()),
             T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType()))]
    if n:
        kinds.append(T.StructField("rest", T.ArrayType(T.StructType(others))))
    kinds = T.StructType([*kinds, T.StructField("z", T.BinaryType())])
    chunks = stored(src.mapInArrow(_chunked(n, n + 1, list(range(n)), kinds.names), kinds), "chunks")
    total = chunks.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // (WORD_BYTES * SHARD)))

    texts = chunks.select("chunk", "ids", "lengths", "z")
    sketches = texts.mapInArrow(_sketched(shards, window), "shard int, chunk long, cells0 binary, more0 binary,"
                                                           " cells1 binary, more1 binary")
    told = stored(sketches.groupBy("shard").applyInArrow(_merged, "shard int, chunk long, told0 binary, told1 binary"), "told")
    told = told.groupBy("chunk").agg(F.collect_list(F.struct("shard", "told0", "told1")).alias("told"))
    asked = texts.join(told, "chunk").mapInArrow(_asked(shards, window), "shard int, chunk long, one binary, two binary,"
                                                                         " least binary")
    firsts = stored(asked.groupBy("shard").applyInArrow(_answered, "shard int, chunk long, first binary"), "firsts")
    firsts = firsts.groupBy("chunk").agg(F.collect_list(F.struct("shard", "first")).alias("firsts"))
    out = T.StructType([*others, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("kept", T.StringType())])
    return chunks.drop("size").join(told, "chunk", "left").join(firsts, "chunk", "left").mapInArrow(
        _cut(shards, window, n, out.names), out)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without words of 13-word windows of a smaller document."""
    found = remove_repeated_windows(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_sql() -> str:
    """The same with the windows' words themselves as keys."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d),
y AS (SELECT r, doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k FROM x),
f AS (SELECT k, min(doc_id) AS doc_id FROM y GROUP BY k),
c AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS i FROM y JOIN f ON f.k = y.k AND f.doc_id < y.doc_id),
g AS (SELECT r, list(i) AS gone FROM c GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
    sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
        list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""
