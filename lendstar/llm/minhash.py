"""MinHash near-duplicates by fast similarity sketching.

A document's set holds the hashes of its distinct word shingles.  The sketch
has ``COORDINATES`` coordinates, filled in rounds of hashed bin placement: in
each of the first rounds every element falls into one random bin, in the later
ones into a bin named by the round, so after twice as many rounds as bins no
coordinate can be empty.  A coordinate keeps its smallest (round, hash); the
share of equal coordinates estimates the Jaccard similarity, and concentrates
around it as for independent minima.  A set large against the bins fills them
in a round or two.

Candidates share a band of coordinates (30 bands of 5: a pair at similarity
0.8 is missed with probability 7e-6).  Links are then confirmed on full sets:

* documents with equal sets are one class, linked without comparing;
* each class is compared with its bucket's smallest class (one star per
  bucket), and the links are contracted to components;
* buckets that still hold several components are compared in full, in blocks
  of bounded size, so that no link of the candidates is lost.  A task holds two
  blocks and returns a spanning set of its links, never all pairs.

No bucket, class or component is collected into one task or to the driver.

Defined results: null, empty or wordless text has an empty set and links with
nothing.  Rows that share an id are one document.  A row with a null id is
linked with nothing and kept.  Other columns pass through ``near_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.llm.common import fresh_names, read_table, stored
from lendstar.llm.components import components
from lendstar.llm.units import release_memory

BANDS, ROWS = 30, 5
COORDINATES = BANDS * ROWS
SEED = 20240607
BLOCK_SHINGLES = 150_000

_U = np.uint64
_MIX1, _MIX2, _MULT = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles; A-Z count
    as a-z, words are runs of anything but ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(size, len(words))
    acc = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        acc = mix64(acc * _MULT + h[i:len(h) - k + 1 + i])
    return np.unique(acc)


def sketch(elements: np.ndarray, bins: int = COORDINATES, seed: int = SEED) -> np.ndarray:
    """``bins`` 64-bit coordinates of a non-empty set."""
    seeds = mix64(np.arange(1, 2 * bins + 1, dtype=np.uint64) * _MULT + _U(seed))
    out, open_ = np.zeros(bins, dtype=np.uint64), np.ones(bins, dtype=bool)
    step = max(1, -(-6 * bins // len(elements)))  # rounds looked at together; small sets need many
    at = 0
    while open_.any():
        rounds = np.arange(at, min(at + step, 2 * bins))
        v = mix64(elements[None, :] ^ seeds[rounds][:, None])
        bin_ = ((v >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
        later = rounds >= bins
        bin_[later] = (rounds[later] - bins)[:, None]
        bin_, v = bin_.ravel(), mix64(v ^ _MULT).ravel()
        rnd = np.repeat(rounds, len(elements))
        order = np.lexsort((v, rnd, bin_))
        b = bin_[order]
        first = order[np.r_[True, b[1:] != b[:-1]]]
        first = first[open_[bin_[first]]]
        out[bin_[first]] = mix64(v[first] + rnd[first].astype(np.uint64))
        open_[bin_[first]] = False
        at += step
    return out


def band_keys(coordinates: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = coordinates.reshape(bands, -1)
    acc = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        acc = mix64(acc * _MULT + rows[:, i])
    return acc.view(np.int64)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for b in (w.slice(lo, 512) for w in batches for lo in range(0, w.num_rows, 512)):
            n, digest, bands = [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(sketch(s)).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["id", "n_shingles", "digest", "bands"])
        release_memory()

    return run


def linked(a: int, b: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def _star(size: int, percent: int):
    """Rows (a, ta, b, tb), ordered so that b's text repeats: the linked (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in (w.slice(lo, 512) for w in batches for lo in range(0, w.num_rows, 512)):
            out = []
            for a, ta, b, tb in zip(*[c.to_pylist() for c in batch.columns]):
                if hub != (b, tb):
                    hub, hub_set = (b, tb), shingle_set(tb, size)
                s = shingle_set(ta, size)
                both = len(np.intersect1d(s, hub_set, assume_unique=True))
                if linked(len(s), len(hub_set), both, percent):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)],
                                             names=["a", "b"])

    return run


def _blocks(size: int, percent: int):
    """A group holds the documents of one or two blocks: links between their
    components, each followed by a merge, so at most one link per document."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["id", "component", "text"]).to_pylist()
        sets = [shingle_set(r["text"], size) for r in rows]
        sizes = np.array([len(s) for s in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        values, flat = np.unique(np.concatenate(sets), return_inverse=True)
        comp = np.unique(np.array([r["component"] for r in rows]), return_inverse=True)[1]
        mark = np.zeros(len(values), dtype=np.int64)
        out = []
        for i in range(len(rows)):
            if (comp == comp[i]).all():
                continue
            own = flat[starts[i]:starts[i] + sizes[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[flat], starts)
            mark[own] = 0
            near = (100 * both >= percent * (sizes + sizes[i] - both)) & (comp != comp[i])
            for j in np.flatnonzero(near):
                if comp[j] != comp[i]:
                    out.append((rows[i]["id"], rows[j]["id"]))
                    comp[comp == comp[j]] = comp[i]
        return pa.table({k: pa.array([x[n] for x in out], pa.int64()) for n, k in enumerate("ab")})

    return run


def link_components(df: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(id, n_shingles, component) for every row of ``df``."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    drawn = stored(src.mapInArrow(_sketches(shingle), "id long, n_shingles long, digest binary, bands array<long>"),
                   "sketches")
    classes = drawn.filter("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("id", "n_shingles", "bands")).alias("c")).select("digest", "c.*")
    classes = stored(classes, "classes")
    member = classes.select("id", "n_shingles", F.explode("bands").alias("key"))
    buckets = member.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("other"))
    member = stored(member.join(buckets.filter("hub < other").drop("other"), "key"), "buckets")

    # Texts of the candidates only, written once for both comparisons.
    wanted = member.select("id").distinct()
    texts = stored(src.join(wanted, "id").distinct(), "candidates")
    hub = texts.select(F.col("id").alias("hub"), F.col("text").alias("hub_text"))
    pairs = member.filter("id <> hub").select("id", "hub").distinct()
    star = (texts.join(pairs, "id").join(hub, "hub")
            .select("id", "text", "hub", "hub_text").mapInArrow(_star(shingle, percent), "a long, b long"))
    # Rows that share an id are one document: their classes are linked.
    who = F.coalesce(F.xxhash64("digest"), F.lit(0))
    several = drawn.filter("id IS NOT NULL").groupBy("id").agg(F.min(who).alias("lo"), F.max(who).alias("hi")).filter("lo < hi")
    own = drawn.select("id", "digest").join(several.select("id"), "id").join(
        classes.select("digest", F.col("id").alias("cls")), "digest").select("id", "cls")
    own = stored(own, "shared-ids")
    same = own.join(own.groupBy("id").agg(F.min("cls").alias("b")), "id").select(F.col("cls").alias("a"), "b").filter("a <> b")
    star = stored(star.unionByName(same), "links")
    first = components(star)

    # Buckets that still hold more than one component, each set of members once.
    known = member.join(first.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "n_shingles", F.coalesce("component", "id").alias("component"))
    known = stored(known, "known")
    mixed = known.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("n_shingles").alias("size"),
        F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("who")).filter("lo < hi")
    mixed = mixed.groupBy("n", "size", "who").agg(F.min("key").alias("key"))
    blocks = F.ceil(F.col("size") / F.lit(BLOCK_SHINGLES)).cast("int")
    placed = known.join(mixed.select("key", blocks.alias("blocks")), "key").withColumn(
        "own", F.expr("pmod(xxhash64(id), blocks)").cast("int"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "id", "component", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"))
    more = placed.join(texts, "id").groupBy("key", "i", "j").applyInArrow(
        _blocks(shingle, percent), "a long, b long")
    final = components(star.unionByName(stored(more, "links")))

    reach = classes.join(final.withColumnRenamed("node", "id"), "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component"))
    # A wordless row of an id with other rows goes where they are.
    others = own.join(final, F.col("cls") == F.col("node"), "left").groupBy("id").agg(
        F.min(F.coalesce("component", "cls")).alias("of_id"))
    linked_rows = drawn.join(reach, "digest", "left").join(others, "id", "left")
    return linked_rows.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.least(
        F.coalesce("component", "id"), "of_id")).alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """``df`` with ``n_shingles``, ``component_id`` (smallest id reachable by
    links) and ``kept`` (the row is its component's smallest id)."""
    kept = [c for c in df.columns if c.lower() not in ("n_shingles", "component_id", "kept")]
    found = link_components(df, id_col, text_col, shingle, percent)
    key, n, comp = fresh_names(df, "id", "n", "component")
    found = found.groupBy(F.col("id").alias(key)).agg(F.max("n_shingles").alias(n), F.min("component").alias(comp))
    return df.select(*kept).join(found, F.col(id_col).cast("long") == F.col(key), "left").select(
        *kept, F.coalesce(n, F.lit(0)).cast("long").alias("n_shingles"), F.col(comp).alias("component_id"),
        F.col(comp).eqNullSafe(F.col(id_col).cast("long")).alias("kept"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents`` on four-word shingles."""
    found = link_components(read_table(spark, sf_dir, "documents"), "doc_id", "text", 4, 80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))
