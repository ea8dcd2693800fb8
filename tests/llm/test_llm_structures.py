"""Prefix trie, centroid clustering and window dedup against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendstar.llm import countmin, orchard, prefixtrie

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def naive_trie(turns):
    convs = {}
    for c, turn, role, text in turns:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    nodes, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        own = sorted(ends.get(path, []))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p in below),
                    sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in below) for p in below),
                    sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                    hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(df, **kw):
    trie = prefixtrie.prefix_trie(df, **kw)
    nodes = trie.nodes.join(prefixtrie.end_digests(trie.ends), prefixtrie.NODE, "left")
    empty = hashlib.sha256(b"").hexdigest()
    return rows(nodes.withColumn("ends_sha256", F.coalesce("digest", F.lit(empty))).select(TRIE))


KINDS = "conv_id long, turn long, role string, text string"


def test_trie_brute_force(spark):
    rnd = random.Random(5)
    turns = []
    for c in [*range(0, 60), 64, 66, 67, 1001, 1004, -3, -5]:
        if c in (10, 15, 45):  # their groups have no base
            continue
        for t in range(rnd.choice([1, 2, 3, 5, 9, 12])):
            turns.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "é" * 3, "", None, "a"])))
    turns += [(7, None, "user", "b"), (7, None, "user", "a"), (7, None, "user", "a"), (8, 1, "user", "é"), (8, 1, "user", "a"),
              (None, 1, "user", "a"), (None, None, None, None)]
    # one conversation with a third of all turns, and copies of it
    long = [(t, "user" if t % 2 else "assistant", f"turn {t % 7}") for t in range(len(turns) // 2)]
    turns += [(c, *x) for c in (100, 101, 102) for x in long]
    rnd.shuffle(turns)
    got = trie_rows(spark.createDataFrame(turns, KINDS).withColumn("part", F.lit("x")).repartition(7))
    assert got == naive_trie(turns)
    turnless = [(c, 0, "user", "x") for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0]
    assert trie_rows(spark.createDataFrame(turnless, KINDS)) == naive_trie(turnless)
    assert trie_rows(spark.createDataFrame([], KINDS)) == []


def test_trie_long_list_of_ends(spark):
    turns = [(c, 0, "user", "same") for c in range(16_000)]
    got = trie_rows(spark.createDataFrame(turns, KINDS))
    want = hashlib.sha256(",".join(str(c) for c in range(16_000)).encode()).hexdigest()
    assert sum(len(str(c)) + 1 for c in range(16_000)) > prefixtrie.END_BYTES
    assert got[1] == (0, 1, 0, 16_000, 0, 1, 4 * 15_999, want) and len(got) == 2


def test_trie_starts_again_after_a_collision(spark):
    """Two turns whose short values collide under the first seed and not under the second."""
    value = lambda t, seed: prefixtrie._value(b"user", t.encode(), seed, 1)
    texts = [f"t{i}" for i in range(400)]
    pair = next((a, b) for a in texts for b in texts if a < b and value(a, 0) == value(b, 0) and value(a, 1) != value(b, 1))
    turns = [(5 * c, 0, "user", pair[c % 2]) for c in range(12)]
    assert trie_rows(spark.createDataFrame(turns, KINDS), digest_bytes=1) == naive_trie(turns)


def naive_clusters(vectors):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    mark = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in mark[:16]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(3):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for k, vs in own.items():
            centroids[k] = [sum(x) // len(vs) for x in zip(*vs)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, d, k in last:
        inertia[k] = inertia.get(k, 0) + d
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), centroids[k]) for i, d, k in last), key=repr)


CLUSTERED = ["vec_id", *orchard.RESULTS]


def test_clusters_brute_force(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(9, 64))
    vectors = [(i, [float(np.float32(x)) for x in centres[i % 9] * (i % 3) + rnd.normal(scale=0.2, size=64)]) for i in range(300)]
    one = vectors[0][1]
    vectors += [(400 + i, one) for i in range(90)] + [(3, one), (3, one), (None, one), (500, [0.0] * 64), (501, [-0.01] * 64)]
    bad = [(600, None), (601, []), (602, one[:63]), (603, [None, *one[1:]]), (604, [float("nan"), *one[1:]]),
           (605, [float("inf"), *one[1:]]), (606, [*one, 1.0]), (607, [1e30, *one[1:]])]
    df = spark.createDataFrame([(v, 1, i, "c") for i, v in vectors + bad],
                               "embedding array<float>, cluster int, vec_id long, packed string")
    out = orchard.cluster_vectors(df.repartition(6))
    assert out.columns == ["vec_id", "packed", *orchard.RESULTS]
    assert rows(out.select(CLUSTERED)) == naive_clusters(vectors)
    few = df.filter("vec_id < 5 OR vec_id > 599")
    assert rows(orchard.cluster_vectors(few).select(CLUSTERED)) == naive_clusters([v for v in vectors if v[0] is not None and v[0] < 5])
    for none in (df.limit(0), df.filter("vec_id > 599"), df.filter("vec_id IS NULL")):
        assert orchard.cluster_vectors(none).collect() == [] and orchard.cluster_vectors(none).columns == out.columns


def test_orchard_measures_few_and_breaks_ties():
    rnd = np.random.default_rng(1)
    centroids = rnd.integers(-1000, 1000, size=(16, 64))
    centroids[11] = centroids[4]
    x = np.concatenate([centroids[rnd.integers(0, 16, 2000)] + rnd.integers(-3, 4, size=(2000, 64)), (centroids[:8] + centroids[8:]) // 2])
    search = orchard.Orchard(centroids)
    at, dist = search.nearest(x, np.full(len(x), 15))
    every = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (at == every.argmin(axis=1)).all() and (dist == every.min(axis=1)).all() and 11 not in at
    again = orchard.Orchard(centroids)
    again.nearest(x, at)
    assert again.measured < search.measured < every.size


def naive_windows(docs, size=13):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        for k in range(len(w) - size + 1) if i is not None else ():
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - size + 1) if i is not None else ():
            if first[tuple(w[k:k + size])] < i:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [countmin.SHARD, 40])
def test_windows_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(countmin, "SHARD", shard)
    rnd = random.Random(8)
    passages = [" ".join(f"p{rnd.randrange(10**6)}" for _ in range(n)) for n in (12, 13, 14, 40, 90)]
    docs = []
    for i in range(60):
        part = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(20))) for _ in range(4)]
        docs.append((i, rnd.choice(["\n", "\t ", " "]).join(rnd.sample(part + [rnd.choice(passages)] * 2, 6))))
    docs += [(100, None), (101, ""), (102, " \n "), (103, passages[4]), (104, passages[4]), (104, passages[4] + " more"),
             (None, passages[3]), (None, passages[3] + " x"), (-4, passages[2]), (105, passages[1].replace(" ", "\x0b", 3)),
             (106, "a " * 100), (107, "a " * 50), (108, "É " + passages[1]), (109, passages[1].upper())]
    rnd.shuffle(docs)
    df = spark.createDataFrame([(t, 1, i, "c") for i, t in docs], "text string, n_words int, doc_id long, txt string")
    out = countmin.remove_repeated_windows(df.repartition(5))
    assert out.columns == ["doc_id", "txt", *countmin.RESULTS]
    assert rows(out.drop("txt")) == naive_windows(docs)
    assert countmin.remove_repeated_windows(df.limit(0)).collect() == []


def test_windows_of_very_long_texts(spark):
    rnd = random.Random(4)
    long = " ".join(str(rnd.randrange(10**9)) for _ in range(400_000))
    docs = [(1, long), (2, "x" * (3 << 20) + " " + long[1_000_000:3_000_000]), (3, "y" * (5 << 20)), (4, long + " end")]
    assert len(list(countmin.pieces(long.encode()))) > 3
    assert b" ".join(countmin.pieces(long.encode())) == long.encode()
    out = countmin.remove_repeated_windows(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
    assert rows(out) == naive_windows(docs)
