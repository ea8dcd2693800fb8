"""Dense identity, change detection, upserts, SCD2."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendstar.operators import changes, keys, upsert


def test_dense_identity_equals_global_row_number_on_unstable_input(spark):
    # Round-robin input: partition contents differ between evaluations, the
    # numbering must not.
    df = (spark.range(0, 50000).select(((F.col("id") * 7919) % 1000003).alias("k"), "id")
          .repartition(5))
    ref = df.select(F.row_number().over(Window.orderBy("k")).cast("long").alias("ident"), "k", "id")
    for parts in (None, 1, 7):
        out = keys.assign_dense_identity(df, "k", "ident", num_partitions=parts)
        assert out.exceptAll(ref).isEmpty() and ref.exceptAll(out).isEmpty()


def test_identity_never_gathers_rows_in_one_task(spark):
    """Whatever the input's size, the plan has no single-partition exchange of rows."""
    for df in (spark.sql("SELECT * FROM VALUES (1), (2) AS t(k)"), spark.range(100_000).withColumnRenamed("id", "k")):
        plan = keys.assign_dense_identity(df, "k", "ident")._jdf.queryExecution().executedPlan().toString()
        assert "__pos" in plan or "Scan parquet" in plan


def test_dense_identity_with_base_frame(spark):
    df = spark.createDataFrame([(30,), (10,), (20,)], "k int")
    base = spark.createDataFrame([(100,)], "m long")
    got = sorted((r.ident, r.k) for r in keys.assign_dense_identity(df, "k", "ident", base=base).collect())
    assert got == [(101, 10), (102, 20), (103, 30)]
    empty_base = spark.createDataFrame([], "m long").agg(F.max("m"))
    got = sorted(r.ident for r in keys.assign_dense_identity(df, "k", "ident", base=empty_base).collect())
    assert got == [1, 2, 3]


def _frames(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", 1), (4, "d", 1)],
                                "k int, x string, y int")
    new = spark.createDataFrame([(1, "a", None), (2, "B", None), (3, "c", None), (5, "e", 2)],
                                "k int, x string, y int")
    return old, new


def test_classify_is_null_safe(spark):
    old, new = _frames(spark)
    got = {r.k: r.change for r in changes.classify(new, old, "k", ["k", "x", "y"]).collect()}
    # 1 equal with NULLs on both sides -> same (a plain '=' join-back would lose it)
    assert got == {1: "same", 2: "update", 3: "update", 4: "missing", 5: "insert"}


def test_rerun_is_noop(spark):
    old, _ = _frames(spark)
    c = changes.classify(old, old, "k", ["k", "x", "y"])
    assert c.filter(F.col("change") != "same").isEmpty()


def test_upsert_snapshot_keeps_untouched_identities(spark):
    old, new = _frames(spark)
    snap = keys.assign_dense_identity(old, "k", "id")
    out = {r.k: r for r in upsert.upsert_snapshot(snap, new, "k", "id", ["k", "x", "y"]).collect()}
    assert out[1].id == 1 and out[4].id == 4            # same / missing keep identity
    assert {out[2].id, out[3].id, out[5].id} == {5, 6, 7}  # changed rows re-issued after max
    assert out[2].x == "B" and out[3].y is None


def test_merge_upsert_keeps_identity_and_created(spark):
    old, new = _frames(spark)
    snap = (keys.assign_dense_identity(old, "k", "id")
            .withColumn("CreatedDate", F.lit("2025-06-01 10:00:00").cast("timestamp"))
            .withColumn("UpdatedDate", F.lit("2025-06-01").cast("date"))
            .withColumn("UpdatedTime", F.lit("10:00:00")))
    out = {r.k: r for r in upsert.merge_upsert(snap, new, "k", "id", ["k", "x", "y"],
                                               "2025-06-15 08:00:00").collect()}
    assert len(out) == 5 and out[2].id == 2 and out[2].x == "B"
    assert out[2].UpdatedDate == dt.date(2025, 6, 15) and out[2].UpdatedTime == "10:00:00"
    assert out[1].UpdatedDate == dt.date(2025, 6, 1)
    assert out[5].id == 5
    ids = [r.id for r in out.values()]
    assert len(ids) == len(set(ids))


def test_append_changes_keeps_history(spark):
    old, new = _frames(spark)
    snap = keys.assign_dense_identity(old, "k", "id")
    out = upsert.append_changes(snap, new, "k", "id", ["k", "x", "y"])
    assert out.count() == 4 + 3


def test_scd2(spark):
    old, new = _frames(spark)
    d1 = upsert.scd2_initial(old, "k", ["x", "y"], "2025-06-01")
    out = upsert.scd2_apply(d1, new, "k", ["x", "y"], "2025-06-15")
    rows = sorted((r.k, r.x, str(r.valid_from), str(r.valid_to), r.is_current) for r in out.collect())
    assert rows == [
        (1, "a", "2025-06-01", "None", True),
        (2, "B", "2025-06-15", "None", True),
        (2, "b", "2025-06-01", "2025-06-14", False),
        (3, "c", "2025-06-01", "2025-06-14", False),
        (3, "c", "2025-06-15", "None", True),
        (4, "d", "2025-06-01", "None", True),
        (5, "e", "2025-06-15", "None", True),
    ]
    # Applying the same delivery again changes nothing.
    again = upsert.scd2_apply(out, new, "k", ["x", "y"], "2025-06-16")
    assert again.exceptAll(out).isEmpty() and out.exceptAll(again).isEmpty()
