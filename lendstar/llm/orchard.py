"""Centroid clustering of integer vectors with Orchard's search.

Every centroid has the list of all centroids sorted by distance from it.  The
search for a vector starts at some centroid and walks that one's list; whenever
a closer centroid is found it goes on at the head of the closer one's list.
Visited centroids are marked and not measured again.  By the triangle
inequality the walk may stop where the list gets strictly beyond twice the
current distance; centroids at exactly twice may tie, so they are measured.
Ties go to the smaller number, also among equal centroids.

All arithmetic is exact: components are integers, distances are squares, and a
round's new centroid is the floor of sum over count.  The first assignment is
stored with the vectors, so later rounds start their search where the vector
was before.  A task adds up its own vectors, at most one row for each centroid
leaves it; the driver holds the centroids alone (``k`` times ``dim`` numbers),
whatever the number of vectors.

Defined results: a row is kept if its vector has ``dim`` components, none null
or non-finite, and |component| under ``LIMIT`` (beyond it a squared distance of
64 components doesn't fit into 64 bits); other rows are left out.  Rows that
share an id are vectors of their own; a null id is assigned but starts no
centroid.  Fewer kept ids than ``k`` give fewer centroids, an empty table or
one without a kept id gives no rows.  A sum of distances that doesn't fit into
64 bits is null.  Columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstar.llm.common import fresh_names, read_table, stored

CENTROIDS, ROUNDS, DIM, SCALE = 16, 3, 64, 64
LIMIT = 1 << 21
SLICE = 4096
RESULTS = ["cluster", "distance", "cluster_inertia", "inertia", "centroid"]


class Orchard:
    """Nearest of the ``centroids`` (k x dim integers) for many vectors at a time."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        gaps = ((centroids[:, None] - centroids[None]) ** 2).sum(axis=2)
        self.lists = np.argsort(gaps, axis=1, kind="stable")
        gaps = np.take_along_axis(gaps, self.lists, axis=1)
        self.reach = -(-gaps // 4)  # gap > 2 * distance, in squares: reach > distance ** 2
        self.measured = 0

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row of ``x``."""
        k = len(self.centroids)
        at, place = start.copy(), np.zeros(len(x), dtype=np.int64)
        dist = ((x - self.centroids[at]) ** 2).sum(axis=1)
        visited = np.zeros((len(x), k), dtype=bool)
        visited[np.arange(len(x)), at] = True
        self.measured += len(x)
        walking = np.arange(len(x))
        while len(walking):
            walking = walking[place[walking] < k]
            walking = walking[self.reach[at[walking], place[walking]] <= dist[walking]]
            found = self.lists[at[walking], place[walking]]
            place[walking] += 1
            new = ~visited[walking, found]
            rows, found = walking[new], found[new]
            visited[rows, found] = True
            d = ((x[rows] - self.centroids[found]) ** 2).sum(axis=1)
            self.measured += len(rows)
            closer = (d < dist[rows]) | ((d == dist[rows]) & (found < at[rows]))
            rows = rows[closer]
            at[rows], dist[rows], place[rows] = found[closer], d[closer], 0
        return at, dist


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in x.astype(np.int32)], pa.binary())


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int32).reshape(-1, dim).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(lo, SLICE) for b in batches for lo in range(0, b.num_rows, SLICE))


def _first(centroids: np.ndarray, scale: int, names: list[str]):
    """Rows (others..., vector) to (others..., packed integers, cluster)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for b in _slices(batches):
            flat = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.floor(scale * flat).astype(np.int64).reshape(b.num_rows, -1)
            at, _ = search.nearest(x, np.zeros(len(x), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _packed(x), pa.array(at, pa.int32())], names=names)

    return run


def _sums(centroids: np.ndarray | None, dim: int):
    """Rows (packed, cluster): count and sums of each cluster in this task, after
    another search from the given cluster if there are ``centroids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = None if centroids is None else Orchard(centroids)
        total: dict[int, np.ndarray] = {}
        for b in _slices(batches):
            x, at = _unpacked(b.column(0), dim), b.column(1).to_numpy().astype(np.int64)
            if search:
                at, _ = search.nearest(x, at)
            for c in np.unique(at).tolist():
                own = x[at == c]
                total[c] = total.get(c, 0) + np.concatenate([[len(own)], own.sum(axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))],
            names=["cluster", "sums"])

    return run


def _last(centroids: np.ndarray, dim: int, names: list[str]):
    """Rows (others..., packed, cluster) to (others..., cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for b in _slices(batches):
            n = b.num_columns
            x, start = _unpacked(b.column(n - 2), dim), b.column(n - 1).to_numpy().astype(np.int64)
            at, dist = search.nearest(x, start)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-2], pa.array(at, pa.int32()), pa.array(dist, pa.int64())], names=names)

    return run


def _moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Floor of sum over count for every centroid with vectors; k * (dim + 1) numbers reach the driver."""
    each = sums.select("cluster", F.posexplode("sums").alias("at", "v"))
    each = each.groupBy("cluster", "at").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v"))
    new = {}
    for r in each.collect():
        new.setdefault(r["cluster"], {})[r["at"]] = int(r["v"])
    out = centroids.copy()
    for c, v in new.items():
        out[c] = [v[i] // v[0] for i in range(1, out.shape[1] + 1)]
    return out


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS,
                    rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: str = "1") -> DataFrame:
    """The kept rows of ``df`` without the vector, with ``cluster``, ``distance``
    (squared, to the final centroid), ``cluster_inertia``, ``inertia`` and
    ``centroid`` (array of its components).  The ``k`` kept vectors with the
    smallest SHA-256 of ``salt:id`` start as centroids 0, 1, ..."""
    spark = df.sparkSession
    others = [f for f in df.schema.fields if f.name != vector_col and f.name.lower() not in RESULTS]
    v, z, c = fresh_names(df, "vec", "packed", "at")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT)) & (F.size(v) == dim)
    src = df.select(*[F.col(f.name) for f in others], F.col(vector_col).cast("array<double>").alias(v))
    src = src.filter(F.coalesce(fine, F.lit(False)))
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(id_col).cast("string")), 256)
    heads = src.filter(F.col(id_col).isNotNull()).select(mark.alias("mark"), v).orderBy("mark", v).limit(k).collect()
    names = [f.name for f in others]
    out = T.StructType([*others, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not heads:
        none = spark.createDataFrame([], out)
        return none.select(*none.columns, *[F.lit(None).cast("long").alias(x) for x in RESULTS[2:4]],
                           F.lit(None).cast("array<long>").alias("centroid"))
    centroids = np.floor(scale * np.array([h[v] for h in heads], dtype=np.float64)).astype(np.int64)

    start = T.StructType([*others, T.StructField(z, T.BinaryType()), T.StructField(c, T.IntegerType())])
    held = stored(src.mapInArrow(_first(centroids, scale, start.names), start), "clusters-first")
    for i in range(rounds):
        # The first assignment is stored already; the others are searched from it.
        step = _sums(centroids if i else None, dim)
        centroids = _moved(centroids, held.select(z, c).mapInArrow(step, "cluster int, sums array<long>"))
    found = stored(held.mapInArrow(_last(centroids, dim, out.names), out), "clusters-last")
    added = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("s"))
    added = {r["cluster"]: int(r["s"]) for r in added.collect()}  # at most k rows
    whole = sum(added.values())
    fits = lambda n: n if n < 1 << 63 else None
    rows = [(i, fits(added[i]), fits(whole), [int(x) for x in centroids[i]]) for i in sorted(added)]
    per = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(per), "cluster").select(*names, *RESULTS)


def op12_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` assigned to 16 centroids after three rounds."""
    found = cluster_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def op12_sql() -> str:
    """The same with every distance of every vector."""
    out = [f"""
WITH kept AS (SELECT vec_id, row_number() OVER () AS id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS k, q FROM kept
    WHERE vec_id IS NOT NULL ORDER BY k LIMIT {CENTROIDS})"""]
    for i in range(ROUNDS + 1):
        out.append(f"""
d{i} AS (SELECT v.id, v.vec_id, v.q, c.k, CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM kept v CROSS JOIN c{i} c),
a{i} AS (SELECT id, any_value(vec_id) AS vec_id, any_value(q) AS q, min(struct_pack(d := d, k := k)) AS m FROM d{i} GROUP BY id)""")
        if i < ROUNDS:
            out.append(f"""
s{i} AS (SELECT m.k AS k, unnest(q) AS x, unnest(range({DIM})) AS pos FROM a{i}),
t{i} AS (SELECT k, pos, sum(x) AS s, count(*) AS n FROM s{i} GROUP BY k, pos),
c{i + 1} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS q FROM t{i} GROUP BY k
    UNION ALL SELECT k, q FROM c{i} WHERE k NOT IN (SELECT k FROM t{i}))""")
    return ",".join(out) + f"""
SELECT vec_id, CAST(m.k AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.k) AS BIGINT) AS cluster_inertia,
    CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.k = a.m.k
"""
