"""Properties: results do not depend on partitioning, hot keys, or delivery splits."""

from pyspark.sql import functions as F

from lendstar.fixtures import Fixtures
from lendstar.operators import changes, cleanse, keys, upsert
from lendstar.specs import ACCOUNT, TRANSACTION



def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_cleansing_independent_of_partitioning(spark, sf_dir):
    txn = Fixtures(spark, sf_dir).txn
    one = cleanse.clean(txn.repartition(1), TRANSACTION)
    many = cleanse.clean(txn.repartition(7, "TransactionReference"), TRANSACTION)
    assert _same(one, many)


def test_hot_key_holding_a_third_of_rows(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("int").alias("k"),
        (F.col("id") % 1000).cast("int").alias("d"), F.col("id").alias("payload"))
    latest = cleanse.dedup_latest(df, "k", "d")
    hot = latest.filter("k = -1").collect()
    assert len(hot) == 1 and hot[0].d == 999 and hot[0].payload == 999  # max d, smallest payload on tie
    assert latest.count() == n - n // 3 + 1
    assert cleanse.duplicate_keys(df, "k").collect()[0].n == n // 3


def test_split_delivery_equals_single_delivery_for_inserts(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    old = keys.assign_dense_identity(cleanse.clean(fx.acc, ACCOUNT), ACCOUNT.key, ACCOUNT.identity_col)
    new = cleanse.clean(fx.acc2, ACCOUNT)
    inserts = changes.new_keys(new, old, ACCOUNT.key).join(new, ACCOUNT.key)
    biz = ACCOUNT.business_cols
    whole = upsert.append_changes(old, inserts, ACCOUNT.key, ACCOUNT.identity_col, biz)
    first = inserts.filter(F.col(ACCOUNT.key) % 2 == 0)
    second = inserts.filter(F.col(ACCOUNT.key) % 2 != 0)  # keys may be negative
    step1 = upsert.append_changes(old, first, ACCOUNT.key, ACCOUNT.identity_col, biz)
    step2 = upsert.append_changes(step1, second, ACCOUNT.key, ACCOUNT.identity_col, biz)
    # Same rows; identities are dense either way (1..N), only their order of issue differs.
    assert _same(whole.drop(ACCOUNT.identity_col), step2.drop(ACCOUNT.identity_col))
    ids = [r[0] for r in step2.select(ACCOUNT.identity_col).collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_upsert_keys_unique(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    old = keys.assign_dense_identity(cleanse.clean(fx.acc, ACCOUNT), ACCOUNT.key, ACCOUNT.identity_col)
    snap = upsert.upsert_snapshot(old, cleanse.clean(fx.acc2, ACCOUNT), ACCOUNT.key,
                                  ACCOUNT.identity_col, ACCOUNT.business_cols)
    assert snap.groupBy(ACCOUNT.key).count().filter("count > 1").isEmpty()
    assert snap.groupBy(ACCOUNT.identity_col).count().filter("count > 1").isEmpty()
