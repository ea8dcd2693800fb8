"""Embedding near-duplicates with randomised-rotation binary codes.

Every vector is normalised and turned by ``ROTATIONS`` random rotations; its
code is the signs of all turned components, with one correction factor per
rotation: the inner product of the vector and its code.  For a code o' of o and
a turned vector q, <o', q> / <o', o> is an unbiased estimate of the cosine, and
its error is bounded by ``EPSILON`` standard deviations of
sqrt(1 - <o', o>^2) / (<o', o> sqrt(d - 1)); the rotations' mean has a bound
smaller by the root of their number.

* The same sign bits give the index: ``BANDS`` keys of ``BITS`` bits.  At cosine
  0.93 two vectors share a bit with probability 0.881 and some key with 0.965;
  at 0.95 with 0.995.  Every row is indexed; nothing is fitted.
* Codes and factors are made once, stored, and moved with the candidates: keys
  and estimates rest on the same bits.  The estimate takes the code of one vector
  and the other one turned, so the vectors move as well.
* Vectors that share a key (and label and dimension) are compared by the
  estimate; only pairs whose upper bound reaches the threshold are computed
  again in double precision, and only pairs at or above it are links.
* A pair counts at the first key it shares, so counts need no distinct pairs.

Equal vectors of a label are one class with a weight, linked without comparing.
A key with many classes is compared in blocks of bounded size, pairs of blocks
spread over tasks.  A task returns counts per vector and a spanning set of its
links, never all pairs.

Defined results: a vector that's null, empty, zero or holds a null or non-finite
component, or whose label is null, links with nothing (n_links 0, its own
component, kept).  Vectors of different dimension are never linked.  Labels of
any type are compared as they are (by their text).  Rows that share an id are one
vector for components, and n_links counts a row's own links; a null id is kept
and its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.llm.common import read_table, stored
from lendstar.llm.components import components

THRESHOLD = 0.93
BANDS, BITS = 32, 18
EPSILON = 4.0
SEED = 7
BLOCK = 1024


@lru_cache(maxsize=8)
def rotations(dim: int) -> np.ndarray:
    """Enough random orthogonal matrices for BANDS * BITS signs: (r, dim, dim)."""
    rng = np.random.default_rng([SEED, dim])
    count = -(-BANDS * BITS // dim)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(count)])


def _turned(unit: np.ndarray) -> np.ndarray:
    """Every rotation of each row: (n, rotations * dim)."""
    dim = unit.shape[1]
    return unit @ rotations(dim).reshape(-1, dim).T


def _unit(vectors: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _bytes(rows: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype=kind).reshape(len(rows), -1)


class Codes:
    """Signs and correction factors of unit vectors of one dimension, as stored."""

    def __init__(self, signs: np.ndarray, factor: np.ndarray):
        self.signs, self.factor = signs, factor  # (n, rotations * dim) of 0 and 1; (n, rotations): <o', o>

    @classmethod
    def of(cls, unit: np.ndarray) -> "Codes":
        turned = _turned(unit)
        n, dim = unit.shape
        return cls((turned >= 0).astype(np.uint8), np.abs(turned).reshape(n, -1, dim).sum(axis=2) / np.sqrt(dim))

    @classmethod
    def read(cls, code: list[bytes], factor: list[bytes], dim: int) -> "Codes":
        count = rotations(dim).shape[0]
        return cls(np.unpackbits(_bytes(code, np.uint8), axis=1, count=count * dim), _bytes(factor, np.float64))

    def stored(self) -> tuple[list[bytes], list[bytes]]:
        return [r.tobytes() for r in np.packbits(self.signs, axis=1)], [r.tobytes() for r in self.factor]

    def keys(self) -> np.ndarray:
        bits = self.signs[:, :BANDS * BITS].reshape(-1, BANDS, BITS).astype(np.int64)
        return (bits << np.arange(BITS)).sum(axis=2)

    def bounds(self) -> np.ndarray:
        n, count = self.factor.shape
        dim = self.signs.shape[1] // count
        spread = np.sqrt(np.maximum(0.0, 1 - self.factor**2)) / (self.factor * np.sqrt(max(1, dim - 1)))
        return EPSILON * np.sqrt((spread**2).sum(axis=1)) / count

    def scaled(self) -> np.ndarray:
        """Rows whose products with turned vectors estimate the cosines."""
        n, count = self.factor.shape
        dim = self.signs.shape[1] // count
        signs = (self.signs.astype(np.float32) * 2 - 1).reshape(n, count, dim)
        return (signs / (self.factor * np.sqrt(dim) * count)[:, :, None].astype(np.float32)).reshape(n, -1)


def _by_dim(whole: pa.RecordBatch, column: int, size) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Slices of bounded size, each of rows of one dimension."""
    for lo in range(0, whole.num_rows, 2048):
        b = whole.slice(lo, 2048)
        dims = size(b.column(column))
        for d in np.unique(dims):
            yield b.take(pa.array(np.flatnonzero(dims == d))), int(d)


def _code_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, label, vec) to (cls, label, dim, code, factor)."""
    for whole in batches:
        for b, d in _by_dim(whole, 2, lambda c: pc.list_value_length(c).to_numpy(zero_copy_only=False)):
            code, factor = Codes.of(_unit(b.column(2), d)).stored()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.full(b.num_rows, d, np.int32)), pa.array(code, pa.binary()),
                 pa.array(factor, pa.binary())], names=["cls", "label", "dim", "code", "factor"])


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, label, dim, code, factor) to a row for each key of the code."""
    for whole in batches:
        for b, d in _by_dim(whole, 2, lambda c: c.to_numpy(zero_copy_only=False)):
            codes = Codes.read(b.column(3).to_pylist(), b.column(4).to_pylist(), d)
            key = (np.arange(BANDS, dtype=np.int64) << BITS)[None, :] | codes.keys()
            pick = pa.array(np.repeat(np.arange(b.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pick), b.column(1).take(pick), pa.array(np.full(len(pick), d, np.int32)),
                 pa.array(key.ravel())], names=["cls", "label", "dim", "key"])


GROUP = ["label", "dim", "key", "i", "j"]


def _marks(t: pa.Table) -> np.ndarray:
    """The group columns of each row."""
    return np.column_stack([t[c].to_pandas().to_numpy(dtype=object) for c in GROUP])


def _compare(threshold: float):
    """Rows sorted by (label, dim, key, i, j): links of each group of rows."""

    def links(t: pa.Table) -> Iterator[tuple]:
        first_block, second_block = t["i"][0].as_py(), t["j"][0].as_py()
        cls, weight = t["cls"].to_numpy(), t["weight"].to_numpy()
        own = t["own"].to_numpy()
        dim = t["dim"][0].as_py()
        unit = _unit(t["vec"], dim)
        codes = Codes.read(t["code"].to_pylist(), t["factor"].to_pylist(), dim)
        keys, turned, scaled, bound = codes.keys(), _turned(unit).astype(np.float32), codes.scaled(), codes.bounds()
        band = t["key"][0].as_py() >> BITS
        up = np.arange(len(cls))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        count = np.zeros(len(cls), dtype=np.int64)
        edges = []
        for lo in range(0, len(cls), 256):
            maybe = scaled[lo:lo + 256] @ turned.T + bound[lo:lo + 256, None] >= threshold
            a, b = np.nonzero(maybe)
            a += lo
            # either direction's bound may rule a pair out only together
            ok = a < b if first_block == second_block else (own[a] == first_block) & (own[b] == second_block)
            a, b = a[ok], b[ok]
            ok = np.argmax(keys[a] == keys[b], axis=1) == band if len(a) else np.zeros(0, dtype=bool)
            a, b = a[ok], b[ok]
            ok = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            for x, y in zip(a[ok].tolist(), b[ok].tolist()):
                count[x] += weight[y]
                count[y] += weight[x]
                rx, ry = root(x), root(y)
                if rx != ry:
                    up[rx] = ry
                    edges.append((x, y))
        for x in np.flatnonzero(count):
            yield int(cls[x]), None, int(count[x])
        for x, y in edges:
            yield int(cls[x]), int(cls[y]), 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def emit(t: pa.Table) -> Iterator[pa.RecordBatch]:
            g = _marks(t)
            cuts = np.flatnonzero((g[1:] != g[:-1]).any(axis=1)) + 1
            rows = [r for a, z in zip([0, *cuts], [*cuts, len(g)]) if z - a > 1 for r in links(t.slice(a, z - a))]
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            g = _marks(t)
            tail = np.flatnonzero((g != g[-1]).any(axis=1))
            cut = int(tail[-1]) + 1 if len(tail) else 0  # the last group may go on
            if cut:
                yield from emit(pa.concat_tables([*held, t.slice(0, cut)]).combine_chunks())
                held = []
            elif held and [held[-1][c][0].as_py() for c in GROUP] != g[-1].tolist():
                yield from emit(pa.concat_tables(held).combine_chunks())
                held = []
            held.append(t.slice(cut))
        if held:
            yield from emit(pa.concat_tables(held).combine_chunks())

    return run


def link_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component) for every row of ``df``."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                    F.col(vector_col).cast("array<double>").alias("vec"))
    big = F.lit(float("inf"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists("vec", lambda x: x != 0)
    valid = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & fine, F.lit(False))
    # -0.0 and 0.0 are one value
    same = F.transform("vec", lambda x: x + F.lit(0.0))
    src = stored(src.select("id", "label", F.when(valid, same).alias("vec")), "vectors")
    # numbered as they are written, so an id with several vectors has a class for each
    classes = stored(src.filter("vec IS NOT NULL").groupBy("label", "vec").agg(
        F.min("id").alias("node"), F.count("*").alias("weight")).withColumn("cls", F.monotonically_increasing_id()),
        "vector-classes")
    codes = stored(classes.select("cls", "label", "vec").mapInArrow(
        _code_rows, "cls long, label string, dim int, code binary, factor binary"), "vector-codes")
    keys = stored(codes.mapInArrow(_key_rows, "cls long, label string, dim int, key long"), "vector-keys")
    cell = ["label", "dim", "key"]
    shared = keys.groupBy(*cell).count().filter("count > 1").withColumn(
        "blocks", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count")
    placed = keys.join(shared, cell).withColumn("own", F.expr("pmod(xxhash64(cls), blocks)").cast("int"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cls", *cell, "own", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"))
    rows = placed.join(classes.select("cls", "weight", "vec").join(codes.select("cls", "code", "factor"), "cls"), "cls")
    found = (rows.select("cls", *GROUP, "own", "weight", "vec", "code", "factor").repartition(*GROUP).sortWithinPartitions(*GROUP)
             .mapInArrow(_compare(threshold), "a long, b long, n long"))
    found = stored(found, "vector-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    per_class = classes.join(counts, "cls", "left").select(
        "label", "vec", "cls", "node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    member = stored(src.join(per_class, ["label", "vec"], "left").select("id", "cls", "node", "n_links"), "vector-members")
    ends = [classes.select(F.col("cls").alias(c), F.col("node").alias(n)) for c, n in (("a", "x"), ("b", "y"))]
    edges = found.filter("b IS NOT NULL").select("a", "b").join(ends[0], "a").join(ends[1], "b").select("x", "y")
    several = member.groupBy("id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("id")
    edges = edges.unionByName(member.filter("cls IS NOT NULL").join(several, "id").select(
        F.col("node").alias("x"), F.col("id").alias("y")))
    reach = components(edges, "x", "y")
    return member.join(reach, "node", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "node", "id").alias("component"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``embeddings``, by label, at cosine 0.93."""
    out = link_vectors(read_table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))
