"""Large tables go in passes: the same rows as in one, with a share of the shuffle files at a time; nothing stays
on disk that isn't read again."""

import datetime as dt
import decimal
import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstar.plans import buckets, kept, pipeline, queries
from lendstar.sources import versioned
from lendstar.specs import TableSpec

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("o", T.IntegerType()), T.StructField("x", T.StringType()),
                       T.StructField("n", T.StringType())])
SPEC = TableSpec(name="t", schema=SCHEMA, key="k", order_col="o", identity_col="id", amount_cols=("n",))


def delivered(spark, scratch, name, rows):
    """Read from files: their size is known."""
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{scratch}/{name}")
    return spark.read.parquet(f"{scratch}/{name}")


def rows_of(spark, base, *cols):
    return sorted((tuple(r) for r in versioned.read_current(spark, base).select(*cols).collect()), key=str)


@pytest.mark.parametrize("odd", [False, True])
def test_passes_give_the_rows_of_one(spark, scratch, monkeypatch, odd):
    nulls = repeated = odd
    rng = random.Random(1)
    first = [(k, 1, f"x{k % 7}", rng.choice(["1,5", "NULL", "-2"])) for k in range(-150, 150) if k % 5]
    second = [(k, rng.choice([0, 1, 2]), f"x{k % 7}" if k % 9 else "new", "1,5") for k in range(-150, 200, 3)] + [(4000, 1, "a", "bad")]
    if repeated:
        first, second = (r + [(k, o, f"{x}!", n) for k, o, x, n in r[::4]] for r in (first, second))
    if nulls:
        first, second = first + [(None, 1, "none", "1")], second + [(None, 2, "none", "2")]
    deliveries = [delivered(spark, scratch, i, r) for i, r in enumerate((first, second, first))]
    writes, publish = [], buckets.publish_buckets

    def noted(df, *a, more=None, **k):
        writes.append(1 + len(more or []))
        return publish(df, *a, more=more, **k)

    monkeypatch.setattr(buckets, "publish_buckets", noted)
    tables, logs = [], []
    for size in (1 << 40, versioned.bytes_read(deliveries[0]) // 4):
        monkeypatch.setattr(versioned, "PASS_BYTES", size)
        base = f"{scratch}/to{size}"
        done = [pipeline.run_table_etl(d, SPEC, base, f"2025-06-0{i} 08:00:00") for i, d in enumerate(deliveries, 1)]
        logs.append([{k: v for k, v in r.items() if k != "output_name"} for r in done])
        tables.append(rows_of(spark, base, "id", "k", "o", "x", "n", "CreatedDate", "UpdatedDate"))
    assert tables[0] == tables[1] and logs[0] == logs[1]
    half = len(writes) // 2
    assert set(writes[:half]) == {1} and min(writes[half:]) > 1
    want = {}  # the latest by o, a later delivery's of equal ones, then the smallest text
    for r in (first, second, first):
        for k in {x[0] for x in r if x[3] != "bad"}:
            best = min((x for x in r if x[0] == k and x[3] != "bad"), key=lambda x: (-x[1], x[2]))
            if k not in want or best[1] >= want[k][0]:
                want[k] = best[1:3]
    got = {r[1]: r[2:4] for r in tables[1]}
    assert {k: got[k] for k in want if k is not None} == {k: v for k, v in want.items() if k is not None}


def transactions(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([1, None, *range(1, 40)]) if i % 3 else 1, rng.choice([None, dt.date(2025, rng.randint(1, 4), 3)]),
             rng.randint(1, 3), rng.choice([None, decimal.Decimal(rng.randint(-900, 900)) / 8])) for i in range(n)]


def test_sums_kept_in_passes(spark, scratch, monkeypatch):
    kinds = "LoanAccountTransactionId long, LoanAccountId long, TransactionDate date, TransactionTypeId int, TransactionAmount decimal(15,5)"
    cols = ["LoanAccountId", "TransactionDate", "TransactionTypeId", "TransactionAmount"]
    marts = []
    for size in (1 << 40, 3000):
        monkeypatch.setattr(versioned, "PASS_BYTES", size)
        base, mart, seen = f"{scratch}/t{size}", f"{scratch}/mart{size}", []
        for i, data in enumerate((transactions(300, 1), transactions(60, 2) + transactions(350, 3)[300:])):
            path = f"{scratch}/in{size}-{i}"
            spark.createDataFrame(data, kinds).write.parquet(path)
            buckets.upsert_buckets(spark.read.parquet(path), base, "LoanAccountTransactionId", "id", cols)
            done = kept.keep_transactions_by_type(spark, base, mart)
            seen.append((done, rows_of(spark, f"{mart}/cells", "*"), rows_of(spark, f"{mart}/totals", "*")))
            assert sum(r[3] for r in seen[-1][2]) == versioned.read_current(spark, base).count()
        marts.append(seen)
    assert marts[0] == marts[1]


def test_passes_are_whole_groups(spark, scratch):
    spark.range(5000).write.parquet(f"{scratch}/r")
    df = spark.read.parquet(f"{scratch}/r")
    size = versioned.bytes_read(df)
    assert size >= sum(os.path.getsize(f"{scratch}/r/{f}") for f in os.listdir(f"{scratch}/r") if f.endswith(".parquet"))
    old, versioned.PASS_BYTES = versioned.PASS_BYTES, size // 3
    try:
        assert versioned.passes([*range(8)], 8, df) == [[0, 4], [1, 5], [2, 6], [3, 7]]
        assert versioned.passes([1, 5, 6], 8, df) == [[1, 5], [6]] and versioned.passes([], 8, df) == [[]]
        assert versioned.passes([*range(6)], 6, df) == [[0, 2, 4], [1, 3, 5]] and versioned.passes([0], 1, df) == [[0]]
        assert versioned.passes([*range(8)], 8, spark.createDataFrame([(1,)], "k long")) == [[*range(8)]]
    finally:
        versioned.PASS_BYTES = old


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_files_go_when_they_are_read(spark, scratch, monkeypatch):
    """Shuffle files after each action, conformed rows before the merge is written."""
    raw = [delivered(spark, scratch, i, [(k, 1, f"{k % 50 and i}", "1") for k in range(400)]) for i in range(2)]
    there, publish = [], buckets.publish_buckets
    conformed = lambda: [d for d, _, _ in os.walk(folder[0]) if d.endswith("/conformed")]
    folder, work = [], pipeline.work_path
    monkeypatch.setattr(pipeline, "work_path", lambda *a: (folder.append(os.path.dirname(p := work(*a).removeprefix("file:"))), p)[1])
    monkeypatch.setattr(buckets, "publish_buckets", lambda *a, **k: (there.append(bool(conformed())), publish(*a, **k))[1])
    before = shuffle_files(spark)
    pipeline.run_table_etl(raw[0], SPEC, f"{scratch}/t", "2025-06-01 08:00:00")
    folder.clear()
    pipeline.run_table_etl(raw[1], SPEC, f"{scratch}/t", "2025-06-02 08:00:00")
    assert there == [True, False]
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_mart_query_keeps_current_versions_only(spark, scratch, sf_dir, monkeypatch):
    monkeypatch.setattr(queries, "work_path", lambda s, *parts: f"{scratch}/{'/'.join(parts)}")
    out = queries.mart_kept_by_changes(spark, sf_dir)
    got = {r[0]: r[1] for r in out.groupBy("delivery").agg(F.sum("transactions")).collect()}
    base = f"{scratch}/deliveries/{queries.TRANSACTION.name}"
    assert set(got) == {1, 2, 3} and got[3] == versioned.read_current(spark, base).count()
    assert versioned._versions(spark, base) == ([3], [3]) and versioned._versions(spark, f"{scratch}/kept/cells")[1] == [3]
    assert versioned._versions(spark, f"{scratch}/kept/totals")[1] == [1, 2, 3]  # what the query returns
