"""Prefix trie of rebuilt conversations by composable fingerprints.

A sequence of turns has a fingerprint in a group: the product of its turns'
values, hash(a + b) = hash(a) * B ** len(b) + hash(b) modulo 2**127 - 1.  A
conversation is rebuilt from the first turns of its base and its own turns
behind its head, and products of both are known from their own prefixes:

    prefix(j) = own(j) + (base(h') - own(h)) * B ** (j - h)

so the whole rebuild is one difference for each conversation, and no text is
copied.  Path bytes compose in the same way, by addition.

1. Turns are range partitioned in order (conversation, turn, role, text) and
   scanned; products of a conversation that goes on in the next partition are
   composed from one row for each partition.  A conversation of any length is
   dealt over partitions.  The stored turns carry value, product and text.
2. Prefixes: heads from the base (under ``HEADS`` for a conversation), then
   the own turns, each with its product, its parent's, and a reference to the
   stored turn.  A node is a group of equal (depth, product).
3. Equality is verified.  In each node all members must have the same last
   turn's value and the same parent, and the stored turns that the references
   of a value name must all have one role and text.  By induction equal nodes
   are equal sequences.  A collision starts the work again with another seed.
4. Subtrees without walking them: along a conversation's path the smallest
   member grows, so it owns the tail of its path from its first own node on.
   With E the path's bytes up to there, a node's subtree saves the sum over its
   members of E minus the bytes above the node, and its leaves are the members
   whose own end has no child.  Both are sums over the members of a node.

Defined results: null role or text is empty; rows with a null conversation are
ignored; turns that tie (or are null) within a conversation are ordered by role
and text, and repeated rows are turns of their own.  Negative ids have their
base below (remainder 0 to 4).  An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.llm.common import read_table, stored

P = (1 << 127) - 1
LOW = (1 << 64) - 1
GROUP = 5           # conversations that share a base
HEADS = 9           # a head has 0 to HEADS - 1 turns
DIGEST_BYTES = 16
SEEDS = 8
END_BYTES = 1 << 16
NODE = ["depth", "s1", "s2"]


class Trie(NamedTuple):
    """``nodes``: one row for each node, with its key (depth, s1, s2), the results
    of the module; (conv_id, depth) refers to its last turn.
    ``ends``: (depth, s1, s2, conv) of every conversation's last node."""

    nodes: DataFrame
    ends: DataFrame


def _base(seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(b"base %d" % seed, digest_size=15).digest(), "big") * 2 + 3


def _value(role: bytes, text: bytes, seed: int, size: int) -> int:
    h = hashlib.blake2b(len(role).to_bytes(8, "big"), digest_size=size, key=b"turn %d" % seed)
    h.update(role)
    h.update(text)
    return int.from_bytes(h.digest(), "big") >> 1


def _pairs(values: list[int]) -> list[pa.Array]:
    """127-bit numbers as two columns of 64 bits."""
    both = np.frombuffer(b"".join(v.to_bytes(16, "little") for v in values), dtype=np.int64).reshape(-1, 2)
    return [pa.array(both[:, 1]), pa.array(both[:, 0])]


def _numbers(high: pa.Array, low: pa.Array) -> list[int]:
    return [(a << 64) | (b & LOW) for a, b in zip(high.to_pylist(), low.to_pylist())]


def _bytes(column: pa.Array) -> list[bytes]:
    return [s.encode("utf-8", "surrogatepass") for s in column.to_pylist()]


def _scan(seed: int, size: int):
    """Rows (conv, role, text) in order: products within this partition."""
    B = _base(seed)
    names = ["part", "conv", "here", "x1", "x2", "l1", "l2", "nbytes", "lbytes", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv = here = product = total = None
        for b in (w.slice(lo, 512) for w in batches for lo in range(0, w.num_rows, 512)):
            rows, xs, products = [], [], []
            for c, role, text in zip(b.column(0).to_pylist(), _bytes(b.column(1)), _bytes(b.column(2))):
                if c != conv:
                    conv, here, product, total = c, 0, 0, 0
                x = _value(role, text, seed, size)
                here, product, total = here + 1, (product * B + x) % P, total + len(text)
                xs.append(x)
                products.append(product)
                rows.append((part, c, here, len(text), total))
            cols = [pa.array(k, pa.int64()) for k in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*cols[:3], *_pairs(xs), *_pairs(products), *cols[3:],
                                              b.column(1), b.column(2)], names=names)

    return run


def _composed(seed: int):
    """Rows of the scan with the product (n, c1, c2, cb) in front of the partition."""
    B = _base(seed)
    back = pow(B, -1, P)
    names = ["conv", "pos", "x1", "x2", "s1", "s2", "p1", "p2", "nbytes", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            col = dict(zip(t.schema.names, t.columns))
            s = _numbers(col["l1"], col["l2"])
            here, n, total = (col[k].to_pylist() for k in ("here", "n", "lbytes"))
            for i, k in enumerate(n):
                if k is not None:
                    front = (col["c1"][i].as_py() << 64) | (col["c2"][i].as_py() & LOW)
                    s[i] = (front * pow(B, here[i], P) + s[i]) % P
                    here[i], total[i] = here[i] + k, total[i] + col["cb"][i].as_py()
            parent = [(v - x) * back % P for v, x in zip(s, _numbers(col["x1"], col["x2"]))]
            yield pa.RecordBatch.from_arrays(
                [col["conv"], pa.array(here, pa.int64()), col["x1"], col["x2"], *_pairs(s), *_pairs(parent),
                 col["nbytes"], pa.array(total, pa.int64())], names=names)

    return run


def _rebased(seed: int):
    """Own turns behind the head, with the products of the rebuilt prefixes."""
    B = _base(seed)
    back = pow(B, -1, P)
    names = ["conv", "depth", "s1", "s2", "p1", "p2", "x1", "x2", "nbytes", "b", "src", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            col = dict(zip(t.schema.names, t.columns))
            head = [u - v for u, v in zip(_numbers(col["t1"], col["t2"]), _numbers(col["h1"], col["h2"]))]
            s = [(v + d * pow(B, k, P)) % P if d else v for v, d, k in zip(
                _numbers(col["s1"], col["s2"]), head, col["behind"].to_pylist())]
            parent = [(v - x) * back % P for v, x in zip(s, _numbers(col["x1"], col["x2"]))]
            yield pa.RecordBatch.from_arrays(
                [col["conv"], col["depth"], *_pairs(s), *_pairs(parent), col["x1"], col["x2"],
                 col["nbytes"], col["b"], col["conv"], col["pos"]], names=names)

    return run


def _carries(scanned: DataFrame) -> list[tuple]:
    """(part, conv, n, c1, c2, cb) for partitions that go on with a conversation;
    one row of each partition is looked at here."""
    last = F.max(F.struct("conv", "here", "l1", "l2", "lbytes"))
    tails = scanned.groupBy("part").agg(last.alias("t"), F.min("conv").alias("first")).orderBy("part").collect()
    return [(r["part"], r["first"], *r["t"]) for r in tails]


def _joined(tails: list[tuple], seed: int) -> list[tuple]:
    B = _base(seed)
    out, run = [], None
    for part, first, conv, n, l1, l2, b in tails:
        s = (l1 << 64) | (l2 & LOW)
        if run and run[0] == first:
            out.append((part, run[0], run[1], run[2] >> 64, _signed(run[2]), run[3]))
            if conv == first:
                n, s, b = run[1] + n, (run[2] * pow(B, n, P) + s) % P, run[3] + b
        run = (conv, n, s, b)
    return out


def _signed(v: int) -> int:
    v &= LOW
    return v - (1 << 64) if v >> 63 else v


def head_length(conv: Column) -> Column:
    """Turns taken from the base conversation."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def _turns(df: DataFrame, columns: dict[str, str], seed: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The stored turns with their text, and their prefixes without."""
    spark = df.sparkSession
    src = df.select(F.col(columns["conv"]).cast("long").alias("conv"), F.col(columns["turn"]).alias("turn"),
                    F.coalesce(F.col(columns["role"]).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(columns["text"]).cast("string"), F.lit("")).alias("text"))
    # The last key parts equal rows, so that no number of them must meet in one task.
    src = src.filter("conv IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = ("part long, conv long, here long, x1 long, x2 long, l1 long, l2 long, nbytes long, lbytes long,"
             " role string, text string")
    scanned = stored(src.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .select("conv", "role", "text").mapInArrow(_scan(seed, size), kinds), "turns")
    carry = spark.createDataFrame(_joined(_carries(scanned), seed),
                                  "part long, conv long, n long, c1 long, c2 long, cb long")
    slim = scanned.drop("role", "text").join(F.broadcast(carry), ["part", "conv"], "left")  # a row for each partition
    prefixes = slim.mapInArrow(_composed(seed), "conv long, pos long, x1 long, x2 long, s1 long, s2 long, p1 long,"
                                                " p2 long, nbytes long, b long")
    return scanned, stored(prefixes, "prefixes")


def _paths(prefixes: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(every conversation's nodes, its end) as rebuilt, the root included."""
    zero = F.lit(0).cast("long")
    at = prefixes.withColumn("h", head_length(F.col("conv")))
    own_head = F.max(F.when(F.col("pos") == F.col("h"), F.col("s1"))), F.max(F.when(F.col("pos") == F.col("h"), F.col("s2")))
    convs = at.groupBy("conv", "h").agg(
        F.max("pos").alias("n"), *[F.coalesce(c, zero).alias(k) for c, k in zip(own_head, ("h1", "h2"))],
        F.coalesce(F.max(F.when(F.col("pos") == F.col("h"), F.col("b"))), zero).alias("hb"))
    convs = stored(convs.withColumn("base", F.col("conv") - F.expr(f"pmod(conv, {GROUP}L)")), "conversations")
    heads = prefixes.filter((F.col("pos") < HEADS) & (F.expr(f"pmod(conv, {GROUP}L)") == 0))
    head = convs.filter("h > 0").select(F.col("conv").alias("c"), "h", "base").join(
        heads, (F.col("base") == F.col("conv")) & (F.col("pos") <= F.col("h")))
    head = stored(head.select(F.col("c").alias("conv"), F.col("pos").alias("depth"), "s1", "s2", "p1", "p2", "x1", "x2",
                              "nbytes", "b", F.col("base").alias("src"), "pos"), "heads")
    # The deepest turn of the head: products of at most HEADS - 1 rows.
    top = head.groupBy("conv").agg(F.max(F.struct("depth", "s1", "s2", "b")).alias("t")).select("conv", "t.*")
    top = top.select("conv", F.col("depth").alias("hp"), F.col("s1").alias("t1"), F.col("s2").alias("t2"),
                     F.col("b").alias("tb"))
    facts = stored(convs.join(top, "conv", "left").fillna(0, ["hp", "t1", "t2", "tb"]), "rebuilt")
    own = at.drop("h").join(facts.filter("n > h"), "conv").filter(F.col("pos") > F.col("h")).select(
        "conv", "pos", (F.col("pos") - F.col("h")).alias("behind"), (F.col("hp") + F.col("pos") - F.col("h")).alias("depth"),
        "x1", "x2", "s1", "s2", "t1", "t2", "h1", "h2", "nbytes", (F.col("b") - F.col("hb") + F.col("tb")).alias("b"))
    kinds = ("conv long, depth long, s1 long, s2 long, p1 long, p2 long, x1 long, x2 long, nbytes long, b long,"
             " src long, pos long")
    none = F.lit(None).cast("long")
    root = convs.select("conv", zero.alias("depth"), zero.alias("s1"), zero.alias("s2"), none.alias("p1"), none.alias("p2"),
                        none.alias("x1"), none.alias("x2"), zero.alias("nbytes"), zero.alias("b"), none.alias("src"),
                        none.alias("pos"))
    paths = stored(root.unionByName(head).unionByName(own.mapInArrow(_rebased(seed), kinds)), "paths")
    long = facts.filter("n > h").select("conv", F.col("n").alias("pos"), F.col("conv").alias("src"))
    ends = paths.join(long, ["conv", "src", "pos"], "left_semi").select("conv", *NODE, "b")
    short = facts.filter("n <= h").select("conv", F.col("hp").alias("depth"), F.col("t1").alias("s1"),
                                          F.col("t2").alias("s2"), F.col("tb").alias("b"))
    return paths, stored(ends.unionByName(short), "ends")


def _verified(nodes: DataFrame, turns: DataFrame) -> bool:
    """Whether every node's members are one sequence of turns."""
    differ = nodes.filter("x1 <> x1_hi OR x2 <> x2_hi OR p1 <> p1_hi OR p2 <> p2_hi")
    if not differ.isEmpty():
        return False
    # Equal turns collapse before the shuffle, so a turn that many share moves once a task.
    texts = turns.select("x1", "x2", "role", "text").distinct()
    return texts.groupBy("x1", "x2").count().filter("count > 1").isEmpty()


def prefix_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                digest_bytes: int = DIGEST_BYTES) -> Trie:
    """The trie of the rebuilt conversations of ``df``."""
    columns = {"conv": conv, "turn": turn, "role": role, "text": text}
    for seed in range(SEEDS):
        turns, prefixes = _turns(df, columns, seed, digest_bytes)
        paths, ends = _paths(prefixes, seed)
        both = [f(c).alias(k) for c in ("x1", "x2", "p1", "p2") for f, k in ((F.min, c), (F.max, f"{c}_hi"))]
        nodes = stored(paths.groupBy(*NODE).agg(
            F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("nbytes").alias("nbytes"),
            F.min("b").alias("b"), *both), "nodes")
        if _verified(nodes, turns):
            break
    else:
        raise RuntimeError(f"turns of different texts had equal values under {SEEDS} seeds")

    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2")).agg(
        F.count("*").alias("n_children"))
    nodes = stored(nodes.select(*NODE, "conv_id", "n_convs", "nbytes", "b", "p1", "p2").join(
        children, NODE, "left").fillna(0, ["n_children"]), "nodes-children")
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.min("depth").alias("own"), F.min(F.col("b") - F.col("nbytes")).alias("e"),
        F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    members = ends.select("conv", F.col("b").alias("total")).join(owned, "conv", "left").select(
        "conv", "own", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("e", "total").alias("e"))
    above = F.col("b") - F.col("nbytes")
    shared = F.col("own").isNull() | (F.col("depth") < F.col("own"))
    below = paths.select("conv", *NODE, "b", "nbytes").join(members, "conv").groupBy(*NODE).agg(
        F.sum("leaf").cast("long").alias("n_leaves"),
        F.sum(F.when(shared, F.col("e") - above).otherwise(0)).alias("saved_tokens"))
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("s1").alias("p1"), F.col("s2").alias("p2"),
                      F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(below, NODE).join(up, ["depth", "p1", "p2"], "left")
    return Trie(out.select(*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"),
                ends.select(*NODE, "conv"))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (depth, s1, s2, conv): the digest of each node's list, or
    parts of the list where it's long or may go on in another partition."""
    out: list[tuple] = []
    key, first, ids, size, parted = None, None, [], 0, True

    def closed(last: bool) -> None:
        nonlocal parted
        if key is not None and ids:
            if parted or last:
                out.append((*key, first, ",".join(ids), None))
            else:
                out.append((*key, first, None, hashlib.sha256(",".join(ids).encode()).hexdigest()))

    def rows() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 6
        out.clear()
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=[*NODE, "first", "part", "digest"])

    for b in batches:
        for d, s1, s2, conv in zip(*[c.to_pylist() for c in b.columns]):
            if key != (d, s1, s2):
                before = key
                closed(False)
                key, ids, size, parted = (d, s1, s2), [], 0, before is None  # the first list may have begun earlier
            elif size >= END_BYTES:
                out.append((*key, first, ",".join(ids), None))
                ids, size, parted = [], 0, True
            if not ids:
                first = conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
            if len(out) >= 1024:
                yield rows()
    closed(True)
    yield rows()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by (depth, s1, s2, first): the digest of each list, streamed."""
    key, h, done = None, None, []
    for b in batches:
        for d, s1, s2, _, part in zip(*[c.to_pylist() for c in b.columns]):
            if key != (d, s1, s2):
                if key is not None:
                    done.append((*key, h.hexdigest()))
                key, h = (d, s1, s2), hashlib.sha256(part.encode())
            else:
                h.update(b"," + part.encode())
    if key is not None:
        done.append((*key, h.hexdigest()))
    cols = list(zip(*done)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.string()])],
                                     names=[*NODE, "digest"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, s1, s2, digest): SHA-256 of each node's ends, ascending, joined by
    commas.  Long lists are written out by many tasks; only the hashing of the
    joined parts, which can't be divided, is one task's."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*NODE, "conv"]
    made = stored(ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _listed, "depth long, s1 long, s2 long, first long, part string, digest string"), "end-lists")
    rest = made.filter("digest IS NULL").select(*NODE, "first", "part").repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return made.filter("digest IS NOT NULL").select(*NODE, "digest").unionByName(
        rest.mapInArrow(_digested, "depth long, s1 long, s2 long, digest string"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt ``conversations``."""
    trie = prefix_trie(read_table(spark, sf_dir, "conversations"))
    return trie.nodes.join(end_digests(trie.ends), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op11_sql() -> str:
    """The same with whole prefixes as keys; CRC-32 spelled out bit by bit."""
    byte = "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    crc = (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {byte}), lambda a, b: list_reduce("
           f"list_concat([xor(a, b)], list_transform(range(8), lambda i: CAST(0 AS BIGINT))), lambda c, z: {step})), 4294967295)")
    return f"""
WITH t AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce("text", ''))
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, {crc} % {HEADS} AS h, conv_id - ((conv_id % {GROUP}) + {GROUP}) % {GROUP} AS base FROM t),
r AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns
    FROM h LEFT JOIN t b ON b.conv_id = h.base),
p AS (SELECT conv_id, d, turns[1:d] AS k, d = len(turns) AS is_end FROM (
    SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(octet_length(encode(k[d].t)), 0) AS nbytes,
    sha256(coalesce(string_agg(CASE WHEN is_end THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM p GROUP BY k, d),
ch AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
w AS (SELECT n.k, n.d, n.conv_id, n.n_convs, n.ends_sha256, coalesce(ch.n_children, 0) AS n_children, (n.n_convs - 1) * n.nbytes AS saved
    FROM n LEFT JOIN ch ON ch.k = n.k AND ch.d = n.d),
u AS (SELECT k[1:a] AS k, a AS d, n_children, saved FROM (SELECT k, n_children, saved, unnest(range(d + 1)) AS a FROM w)),
s AS (SELECT k, d, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM u GROUP BY k, d)
SELECT w.conv_id, w.d AS depth, par.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM w JOIN s ON s.k = w.k AND s.d = w.d LEFT JOIN w par ON w.d > 0 AND par.d = w.d - 1 AND par.k = w.k[1:w.d - 1]
"""
