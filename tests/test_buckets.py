"""Bucketed tables: only changed buckets are written, writers don't hide each other, old versions go."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendstar.plans.buckets import DIGEST, row_digest, upsert_buckets
from lendstar.sources import versioned

KINDS = "k long, x string, d date, o int"


def frame(spark, n, **changed):
    return spark.createDataFrame([(i, changed.get(f"k{i}", f"x{i}"), None, 1) for i in range(n)], KINDS)


def test_only_changed_buckets_are_written(spark, scratch):
    base = f"{scratch}/t"
    run = lambda df, ts: upsert_buckets(df, base, "k", "id", ["x", "d", "o"], "o", ts, count=8)
    first = run(frame(spark, 100), "2025-06-01 08:00:00")
    assert first == {"message": "first load", "row_count": 100, "buckets": 8}
    one = versioned.bucket_listing(spark, base)
    assert run(frame(spark, 100), "2025-06-02 08:00:00")["message"] == "no changes"
    assert versioned.current_version(spark, base) == 1
    changed = frame(spark, 100, k7="new").filter("k < 50").unionByName(spark.createDataFrame([(7000, "in", None, 1)], KINDS))
    done = run(changed, "2025-06-03 08:00:00")
    want = {r[0] for r in spark.sql("SELECT explode(array(7L, 7000L)) AS k").select(versioned.bucket_of("k", 8)).collect()}
    assert done == {"message": "changes merged", "row_count": 2, "buckets": len(want)}
    two = versioned.bucket_listing(spark, base)
    assert {b for b in two.paths if two.paths[b] != one.paths[b]} == want
    rows = {r["k"]: r for r in versioned.read_current(spark, base).collect()}
    assert len(rows) == 101 and rows[7]["x"] == "new" and rows[7]["id"] == 8 and rows[7000]["id"] == 101
    assert rows[7]["CreatedDate"] < rows[7000]["CreatedDate"] and rows[7]["UpdatedDate"] == dt.date(2025, 6, 3)
    assert DIGEST not in versioned.read_current(spark, base).columns
    older = frame(spark, 100, k9="late").withColumn("o", F.lit(0))
    assert run(older, "2025-06-04 08:00:00")["message"] == "no changes"
    # The work of a small delivery: other buckets aren't read.
    only = versioned.read_buckets(spark, base, two, [3])
    assert len(only.inputFiles()) == 1 and only.count() < 101


def test_old_versions_go_and_listed_buckets_stay(spark, scratch):
    base = f"{scratch}/t"
    for i in range(4):
        upsert_buckets(frame(spark, 60, **{f"k{i}": f"new{i}"} if i else {}), base, "k", "id", ["x"], count=4)
    assert versioned.current_version(spark, base) == 4
    before = sorted(map(tuple, versioned.read_current(spark, base).collect()))
    assert versioned.retire(spark, base, 2) == [1, 2]
    assert versioned._versions(spark, base)[1] == [3, 4]
    versioned.remove_failed(spark, base)
    assert sorted(map(tuple, versioned.read_current(spark, base).collect())) == before
    assert versioned.retire(spark, base, 2) == []


def test_a_table_without_buckets_is_cut_once(spark, scratch):
    base = f"{scratch}/t"
    versioned.publish(frame(spark, 20).select((F.col("k") + 1).alias("id"), "k", "x"), base)
    assert upsert_buckets(frame(spark, 20), base, "k", "id", ["x"], count=4)["message"] == "no changes"
    assert upsert_buckets(frame(spark, 21), base, "k", "id", ["x"], count=4)["row_count"] == 1
    assert versioned.read_current(spark, base).filter("k = 20 AND id = 21").count() == 1


def test_writers_after_one_version(spark, scratch):
    base = f"{scratch}/t"
    upsert_buckets(frame(spark, 10), base, "k", "id", ["x"], count=4)
    start = versioned.bucket_listing(spark, base)
    rows = versioned.read_buckets(spark, base, start, [0])
    # one under way: the other fails cleanly and leaves no claim
    n = versioned.claim(spark, base, start.version)
    with pytest.raises(versioned.ConcurrentPublish):
        versioned.publish_buckets(rows, base, "k", 4, start, [0])
    versioned.release(spark, base, n)
    versioned.publish_buckets(rows, base, "k", 4, start, [0])
    with pytest.raises(versioned.ConcurrentPublish):
        versioned.publish_buckets(rows, base, "k", 4, start, [0])
    assert versioned._claims(spark, base) == {} and versioned.read_current(spark, base).count() == 10
    # whole tables: both land, each under its own number
    other = f"{scratch}/u"
    a = versioned.claim(spark, other)
    assert versioned.publish(rows, other).endswith(f"v={a + 1}")


def test_digest_tells_rows_apart(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 'a', 'b', 0.0D), (2, 'ab', '', 0.0D), (3, NULL, 'b', 0.0D), (4, '', 'b', 0.0D),
        (5, 'a', 'b', -0.0D), (6, '-', 'b', 0.0D), (7, 'a', NULL, 0.0D), (8, 'a1:b', '', 0.0D) AS t(k, x, y, z)""")
    got = {r["k"]: bytes(r["d"]) for r in df.select("k", row_digest(df, ["x", "y", "z"]).alias("d")).collect()}
    assert got[1] == got[5] and len(set(got.values())) == 7


def exchanges(df):
    """Shuffles of rows by bucket, and by key, in the plan of a frame that isn't run yet."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning(bucket"), plan.count("Exchange hashpartitioning(k#")


def test_whole_rows_move_once(spark, scratch, monkeypatch):
    """Identities are made of keys alone; a publish deals whole rows to their buckets, and nothing else moves them."""
    from lendstar.plans import buckets
    ranked, moved = [], []
    identity, publish = buckets.assign_dense_identity, buckets.publish_buckets
    monkeypatch.setattr(buckets, "assign_dense_identity", lambda df, *a, **k: (ranked.append(df.columns), identity(df, *a, **k))[1])
    monkeypatch.setattr(buckets, "publish_buckets", lambda df, *a, **k: (moved.append((df.columns, exchanges(df))), publish(df, *a, **k))[1])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = f"{scratch}/t"
        upsert_buckets(frame(spark, 40), base, "k", "id", ["x", "d", "o"], count=4)
        assert ranked == [["k"]]
        upsert_buckets(frame(spark, 50, k7="new"), base, "k", "id", ["x", "d", "o"], count=4)
        assert all(versioned.BUCKET in cols for cols, _ in moved)
        assert [n for _, n in moved] == [(1, 0), (1, 0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    got = {r["k"]: r for r in versioned.read_current(spark, base).collect()}
    assert len(got) == 50 and got[7]["x"] == "new" and [got[k]["id"] for k in range(50)] == list(range(1, 51))


def test_repeated_and_null_keys(spark, scratch):
    """Rows of repeated keys: the latest of each stays, whether keys are frequent or not; a NULL key has a row."""
    import dataclasses

    from pyspark.sql import types as T

    from lendstar.plans import pipeline
    from lendstar.specs import TableSpec
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("o", T.IntegerType()), T.StructField("x", T.StringType())])
    spec = TableSpec(name="t", schema=schema, key="k", order_col="o", identity_col="id")
    rows = [(k, o, f"{k}.{o}") for k in (3, 5, 8, 13) for o in (2, 1, 3)[:1 + k % 3]] + [(21, None, "b"), (21, None, "a")]
    want = [(1, 3, "3.2"), (2, 5, "5.3"), (3, 8, "8.3"), (4, 13, "13.2"), (5, 21, "a")]
    read = lambda base: sorted(tuple(r) for r in versioned.read_current(spark, base).select("id", "k", "x").collect())
    for i, frequent in enumerate((1000, 1)):
        pipeline.FREQUENT, usual = frequent, pipeline.FREQUENT
        try:
            done = pipeline.run_table_etl(spark.createDataFrame(rows, schema), spec, f"{scratch}/{i}", "2025-06-01 08:00:00")
            more = rows + [(5, 4, "5.4"), (5, 0, "5.0"), (34, 1, "34.1")]
            again = pipeline.run_table_etl(spark.createDataFrame(more, schema), spec, f"{scratch}/{i}", "2025-06-02 08:00:00")
        finally:
            pipeline.FREQUENT = usual
        assert (done["row_count"], done["duplicate_rows"], again["row_count"]) == (5, len(rows) - 5, 2)
        assert read(f"{scratch}/{i}") == [want[0], (2, 5, "5.4"), *want[2:], (6, 34, "34.1")]
    null = dataclasses.replace(spec, name="n")
    pipeline.run_table_etl(spark.createDataFrame([*rows, (None, 1, "n1"), (None, 2, "n2")], schema), null, f"{scratch}/n", "2025-06-01 08:00:00")
    assert [r[2] for r in sorted(read(f"{scratch}/n"), key=lambda r: r[0])] == ["n2", *[w[2] for w in want]]
