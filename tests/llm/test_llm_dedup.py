"""Line, near-duplicate, suffix and embedding dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendstar.llm import embeddings, linededup, minhash, suffixes
from lendstar.llm.components import components


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    edges += [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(50)]
    u = Union()
    for a, b in edges:
        if a is not None and a != b:
            u.join(a, b)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: u.root(x) for x in u.up}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def one_edit(x, y):
    if abs(len(x) - len(y)) > 1:
        return False
    i = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    return x == y or x[i + 1:] == y[i + 1:] or x[i + 1:] == y[i:] or x[i:] == y[i + 1:]


def test_line_dedup_brute_force(spark, monkeypatch):
    rnd = random.Random(11)
    base = ["".join(rnd.choice("ab é") for _ in range(rnd.choice([9, 10, 11, 15, 16, 17, 33, 64, 65, 100, 300]))) for _ in range(25)]

    def edited(s):
        i, c = rnd.randrange(len(s)), rnd.choice("abXé")
        return rnd.choice([s, s.upper(), s[:i] + c + s[i + 1:], s[:i] + s[i + 1:], s[:i] + c + s[i:], s[:i] + c + s[i:] + "b"])

    docs = [(i, "\n".join(edited(rnd.choice(base)) for _ in range(rnd.randrange(6)))) for i in range(80)]
    docs += [(200, None), (201, ""), (202, "short\nshort"), (203, "page 1 of the book\npage 2 of the book"), (204, "z" * 9000),
             (205, "z" * 4000 + "y" + "z" * 4999)]
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(" "))
    places = [(i, p, low(x)) for i, t in docs for p, x in enumerate((t or "").split("\n")) if low(x)]
    near = lambda x, y: x == y or min(len(x), len(y)) >= 10 and one_edit(x, y)
    gone = {(i, p) for i, p, x in places if any((j, q) < (i, p) and near(x, y) for j, q, y in places)}
    assert len(gone) > 50
    df = spark.createDataFrame([(t, 0, i, 1) for i, t in docs], "text string, id int, doc_id long, kept int")
    out = linededup.dedup_lines(df.repartition(3))
    assert out.columns == df.columns
    for r in out.collect():
        t = dict(docs)[r["doc_id"]]
        want = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (r["doc_id"], p) not in gone)
        assert r["text"] == want


def test_line_dedup_edges(spark):
    df = spark.createDataFrame([(None, "a line of text"), (None, "a line of text"), (1, "a line of text"), (1, "a line of text")],
                               "doc_id long, text string")
    assert sorted((tuple(r) for r in linededup.dedup_lines(df).collect()), key=repr) == sorted(
        (tuple(r) for r in df.collect()), key=repr)
    assert linededup.dedup_lines(df.limit(0)).collect() == []


def naive_components(docs, size, percent):
    sets = {}
    for i, t in docs:
        w = tuple((t or "").encode().lower().split())
        sets[i] = frozenset(w[k:k + size] for k in range(max(1, len(w) - size + 1))) if w else frozenset()
    u = Union()
    for i in sets:
        u.root(i)
    ids = list(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                u.join(i, j)
    return {i: (len(sets[i]), u.root(i)) for i in ids}


def family(rnd, words, n, edits, start):
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        out.append((start + k, " ".join(w)))
    return out


@pytest.mark.parametrize("block", [minhash.BLOCK_SHINGLES, 2000])
def test_near_duplicates_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    rnd = random.Random(2)
    docs = family(rnd, 150, 60, 7, 100) + family(rnd, 40, 20, 2, 300) + family(rnd, 800, 12, 30, 400) + family(rnd, 3, 4, 1, 500)
    docs += [(1, None), (2, ""), (3, " \n "), (4, "Hello"), (5, "hello "), (6, "a b c"), (7, "a b c d"), (8, "a b c d"),
             (9, "x y " * 20_000), (10, "x y " * 15_000)]
    rnd.shuffle(docs)
    want = naive_components(docs, 4, 80)
    df = spark.createDataFrame([(t, 1, i, 2) for i, t in docs], "text string, id int, doc_id long, component int")
    out = minhash.near_duplicates(df.repartition(5), shingle=4)
    assert out.columns == [*df.columns, "n_shingles", "component_id", "kept"]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def test_near_duplicate_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    got = sorted((tuple(r)[2:] for r in minhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(0, None, True), (2, 3, True), (2, 3, True)], key=repr)
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_sketch_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 2**63, n - n // 2).astype(np.uint64)]))
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        same = (minhash.sketch(a) == minhash.sketch(b)).mean()
        assert abs(same - j) < 0.17 if n > 10 else minhash.sketch(a).all()
        assert (minhash.sketch(a) == minhash.sketch(a[::-1].copy())).all()


def naive_repeats(docs, w):
    data = {i: (t or "").encode() for i, t in docs}
    c = Counter(b[s:s + w] for b in data.values() for s in range(len(b) - w + 1))
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for s in range(len(b) - w + 1):
            if c[b[s:s + w]] > 1:
                gone[s:s + w] = b"\1" * w
        out[i] = (len(b), sum(gone), bytes(gone).replace(b"\0", b" ").split().__len__(), bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeats_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_RUNS", hot)
    monkeypatch.setattr(suffixes, "CHUNK", 5000)
    rnd = random.Random(4)
    noise = lambda n: "".join(rnd.choice("abcdefgh é") for _ in range(n))
    shared = [noise(n) for n in (150, 199, 200, 201, 260, 450, 900)]
    docs = [(i, noise(rnd.randrange(120)) + rnd.choice(shared)[rnd.randrange(40):] + noise(rnd.randrange(300)) + rnd.choice(shared))
            for i in range(60)]
    docs += [(100, None), (101, ""), (102, "a" * 5000), (103, "ab" * 300 + "c"), (104, noise(20_000)), (105, shared[6]), (106, shared[6])]
    want = naive_repeats(docs, 200)
    df = spark.createDataFrame([(t, 3, i, "x") for i, t in docs], "text string, id int, doc_id long, z string")
    out = suffixes.remove_repeats(df.repartition(4))
    assert out.columns == ["id", "doc_id", "z", "n_bytes", "n_removed", "n_spans", "kept"]
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect()} == want


def test_repeats_edges(spark):
    text = "".join(random.Random(1).choice("abcdef") for _ in range(300))
    df = spark.createDataFrame([(1, text), (1, text), (2, "q" + text[:150]), (None, text[:250]), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_removed"]) for r in suffixes.remove_repeats(df).collect()), key=repr)
    assert got == sorted([(1, 300), (1, 300), (2, 0), (None, 250), (None, 0)], key=repr)
    assert suffixes.remove_repeats(df.limit(0)).collect() == []


def test_op6_on_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = naive_repeats(docs, 200)
    for r in suffixes.op6_suffix_dedup(spark, sf_dir).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == want[r["doc_id"]][:3]


def test_op7_on_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.op7_minhash(spark, sf_dir).collect()} == \
        naive_components(docs, 4, 80)


def naive_vectors(data):
    ok = [(i, np.array(v, dtype=float), lab) for i, v, lab in data
          if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    u, n = Union(), Counter()
    for k, (i, v, lab) in enumerate(ok):
        for j, w, lab2 in ok[:k]:
            if lab == lab2 and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93:
                u.join(i, j)
                n[i] += 1
                n[j] += 1
    return {i: (n[i], u.root(i)) for i, _, _ in data if i is not None}


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(6)
    data = [(i, rng.standard_normal(64).astype(np.float32).tolist(), int(i % 3)) for i in range(150)]
    for g in range(3):
        c = rng.standard_normal(64)
        data += [(1000 * (g + 1) + k, (c + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.25])).astype(np.float32).tolist(), g)
                 for k in range(40)]
    data += [(5000 + k, data[-1][1], 2) for k in range(25)]
    data += [(9001, None, 1), (9002, [0.0] * 64, 1), (9003, [1.0, None] * 32, 1), (9004, [float("nan")] * 64, 1), (9005, [], 1),
             (9006, data[0][1], None), (9007, [1.0] * 8, 1), (9008, [2.0] * 8, 1), (9009, [float("inf")] * 64, 1)]
    want = naive_vectors(data)
    df = spark.createDataFrame([(v, i, lab, 1) for i, v, lab in data], "embedding array<float>, vec_id long, label int, id int")
    got = {r["id"]: (r["n_links"], r["component"]) for r in embeddings.link_vectors(df.repartition(3)).collect()}
    links = sum(n for n, _ in want.values())
    assert got.keys() == want.keys() and all(got[i][0] <= want[i][0] for i in got)
    assert sum(n for n, _ in got.values()) >= 0.9 * links
    assert sum(got[i][1] == want[i][1] for i in got) >= 0.9 * len(got)
    assert all(got[i] == (0, i) for i in got if i >= 9001 and i not in (9007, 9008)) and got[9007] == got[9008] == (1, 9007)
    assert embeddings.link_vectors(df.limit(0)).collect() == []


def test_op9_recall(spark, tmp_path):
    """Recall against brute force on vectors in clusters around the threshold."""
    rng = np.random.default_rng(8)
    c = rng.standard_normal((60, 64))
    data = [(k, (c[k % 60] + 0.27 * rng.standard_normal(64)).astype(np.float32).tolist(), 0) for k in range(900)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    x = np.array([v for _, v, _ in data], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = int((np.triu(x @ x.T, 1) >= 0.93).sum())
    found = embeddings.link_vectors(df).agg(F.sum("n_links")).first()[0] // 2
    assert links > 300 and links >= found >= 0.95 * links


def test_op9_labels_of_any_type_and_repeated_ids(spark, tmp_path):
    """Labels are compared as they are; an id with several vectors joins their groups and each row has its own links."""
    rng = np.random.default_rng(4)
    a, b, c = (rng.standard_normal(64).astype(np.float32).tolist() for _ in range(3))
    data = [(1, a, "x"), (2, a, "x"), (3, a, "y"), (4, b, "x"), (2, b, "x"), (5, b, "x "), (6, c, "1.2"), (7, c, "1.7"), (8, c, "1.7"),
            (7, c, "1.7"), (9, None, "x"), (None, a, "x"), (2, None, "x")]
    want = sorted([(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 1, 1), (2, 1, 1), (5, 0, 5), (6, 0, 6), (7, 2, 7), (8, 2, 7), (7, 2, 7),
                   (9, 0, 9), (None, 0, None), (2, 0, 2)], key=repr)
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label string").repartition(3)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in embeddings.op9_embeddings(spark, str(tmp_path)).collect()]
    assert sorted((r[:3] for r in got), key=repr) == want and all(r[3] == (r[0] == r[2]) for r in got)
    halves = df.filter("label LIKE '1%'").withColumn("label", F.col("label").cast("double"))
    assert sorted(tuple(r) for r in embeddings.link_vectors(halves).collect()) == [(6, 0, 6), (7, 2, 7), (7, 2, 7), (8, 2, 7)]


def test_op9_query_against_brute_force(spark, sf_dir):
    """The whole table of the smallest data: no link below the threshold, recall of at least 0.9."""
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = naive_vectors(data)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.op9_embeddings(spark, sf_dir).collect()}
    assert got.keys() == want.keys() and all(got[i][0] <= want[i][0] for i in got)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values())
    assert sum(got[i][1] == want[i][1] for i in got) >= 0.9 * len(got)


def test_estimates_are_bounded():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 64))
    x[200:] = x[:200] + rng.standard_normal((200, 64)) * 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    made = embeddings.Codes.of(x)
    codes = embeddings.Codes.read(*made.stored(), 64)
    assert (codes.keys() == made.keys()).all() and (codes.factor == made.factor).all()
    up = codes.scaled() @ embeddings._turned(x).T + codes.bounds()[:, None]
    assert (up >= x @ x.T).mean() > 0.9999
    est = up - codes.bounds()[:, None]
    assert abs((est - x @ x.T)[:200, :200][~np.eye(200, dtype=bool)].mean()) < 0.01


def test_op7_null_and_repeated_ids(spark, tmp_path):
    """Rows of one id are one document, also where their texts differ; null ids are linked with nothing."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    docs = [(None, a), (None, a), (1, a), (3, a), (3, b), (5, b + " more"), (7, c), (7, c), (8, ""), (5, None), (None, None), (9, "c0 c1")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in minhash.op7_minhash(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted([(None, 57, None, True), (None, 57, None, True), (1, 57, 1, True), (3, 57, 1, False), (3, 57, 1, False),
                          (5, 58, 1, False), (7, 57, 7, True), (7, 57, 7, True), (8, 0, 8, True), (5, 0, 1, False),
                          (None, 0, None, True), (9, 1, 9, True)], key=repr)


def test_line_dedup_of_very_long_lines(spark):
    """Lines of a megabyte one edit apart, on both sides of the length where keys are made another way."""
    rnd = random.Random(6)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(1 << 20)).strip() + "z"
    edge = "".join(rnd.choice("abcdefgh ") for _ in range(linededup.LONG)).replace(" ", "x")
    k = 700_001
    docs = [(1, long), (2, long[:k] + "Z" + long[k + 1:]), (3, long[:k] + long[k + 1:]), (4, long[:40] + "Q" + long[40:]),
            (5, long[:9] + "QQ" + long[9:]), (6, edge), (7, edge[:-1]), (8, "y" + edge), (9, edge[:77] + "q" + edge[78:]),
            (10, edge[:5] + "qq" + edge[7:]), (11, edge[:-1] + "w"), (12, "ok\n\nok\nhm\n ok \n"), (13, "hm\n\nhmm")]
    out = linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert {i for i, t in got.items() if t == ""} == {2, 3, 4, 7, 8, 9, 11}
    assert got[1] == long and got[5] == docs[4][1] and got[6] == edge and got[10] == docs[9][1]
    assert got[12] == "ok\n\nhm\n" and got[13] == "\nhmm"
