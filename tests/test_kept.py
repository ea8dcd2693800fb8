"""Marts kept up by changes equal a full rebuild; exact quartiles equal a sort."""

import decimal
import math
import random

import pytest
from pyspark.sql import functions as F

from lendstar.operators import marts
from lendstar.plans import kept
from lendstar.plans.buckets import upsert_buckets
from lendstar.sources import versioned

KINDS = ("LoanAccountTransactionId long, LoanAccountId long, TransactionDate date, TransactionTypeId int, "
         "TransactionAmount decimal(15,5)")
COLS = ["LoanAccountId", "TransactionDate", "TransactionTypeId", "TransactionAmount"]


def rows(n, seed):
    import datetime as dt
    rng = random.Random(seed)
    # account 1 holds a third of the rows; some have no account, date or amount
    return [(i, rng.choice([1, None, *range(1, 12)]) if i % 3 else 1,
             rng.choice([None, dt.date(2025, rng.randint(1, 4), 3)]), rng.randint(1, 3),
             rng.choice([None, decimal.Decimal(rng.randint(-900, 900)) / 8])) for i in range(n)]


def deliver(spark, data, base):
    return upsert_buckets(spark.createDataFrame(data, KINDS), base, "LoanAccountTransactionId", "id", COLS, count=8)


def kept_rows(spark, mart):
    return sorted(map(str, versioned.read_current(spark, f"{mart}/totals").collect()))


def rebuilt(spark, base):
    from lendstar.functions.dates import month_key
    t = versioned.read_current(spark, base)
    cell = F.struct("LoanAccountId")  # an account that isn't named counts as one
    out = t.groupBy(month_key("TransactionDate").alias("month"), F.col("TransactionTypeId").alias("transaction_type_id")).agg(
        F.count_distinct(cell).alias("accounts"), F.count(F.lit(1)).alias("transactions"),
        F.coalesce(F.sum("TransactionAmount"), F.lit(0)).cast("decimal(38,5)").alias("amount"))
    return sorted(map(str, out.collect()))


def test_three_deliveries_equal_full_rebuilds(spark, scratch):
    base, mart = f"{scratch}/t", f"{scratch}/mart"
    for delivery in (rows(200, 1), rows(40, 2) + rows(260, 3)[200:], [r for r in rows(260, 4) if r[0] % 50 == 5]):
        deliver(spark, delivery, base)
        done = kept.keep_transactions_by_type(spark, base, mart)
        assert done["totals"]["message"] != "no changes"
        assert kept_rows(spark, mart) == rebuilt(spark, base)
        again = kept.keep_transactions_by_type(spark, base, mart)
        assert {r["message"] for r in again.values()} == {"no changes"}


def test_only_differing_buckets_are_read_and_written(spark, scratch):
    base, mart = f"{scratch}/t", f"{scratch}/mart"
    data = rows(200, 1)
    deliver(spark, data, base)
    kept.keep_transactions_by_type(spark, base, mart)
    one = versioned.bucket_listing(spark, base)
    deliver(spark, [(7, 5, None, 9, decimal.Decimal(1))], base)
    old, new = kept._differing(spark, base, one, versioned.bucket_listing(spark, base))
    assert len(old.inputFiles()) == len(new.inputFiles()) == 1
    done = kept.keep_transactions_by_type(spark, base, mart)
    assert done["cells"]["buckets"] <= 2 and done["totals"]["row_count"] == 2
    assert kept_rows(spark, mart) == rebuilt(spark, base)
    changed = kept.changed_rows(spark, base, 1, COLS).collect()
    assert [r["LoanAccountTransactionId"] for r in changed] == [7]
    assert changed[0]["before"]["LoanAccountId"] == data[7][1] and changed[0]["after"]["TransactionTypeId"] == 9
    first = kept.changed_rows(spark, base, 1, ["TransactionAmount"], until=1)
    assert first.count() == 0


def test_a_run_that_stopped_between_cells_and_totals_goes_on(spark, scratch, monkeypatch):
    base, mart = f"{scratch}/t", f"{scratch}/mart"
    deliver(spark, rows(100, 1), base)
    kept.keep_transactions_by_type(spark, base, mart)
    real, calls = kept.keep_sums, []

    def stops(*a, **k):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return real(*a, **k)

    monkeypatch.setattr(kept, "keep_sums", stops)
    deliver(spark, rows(120, 2), base)
    with pytest.raises(RuntimeError):
        kept.keep_transactions_by_type(spark, base, mart)
    monkeypatch.setattr(kept, "keep_sums", real)
    deliver(spark, rows(130, 3), base)
    kept.keep_transactions_by_type(spark, base, mart)
    assert kept_rows(spark, mart) == rebuilt(spark, base)


def test_retired_source_and_empty_change_and_doubles(spark, scratch):
    base, mart = f"{scratch}/t", f"{scratch}/mart"
    deliver(spark, rows(60, 1), base)
    kept.keep_transactions_by_type(spark, base, mart)
    deliver(spark, rows(60, 2), base)
    versioned.retire(spark, base, 1)
    assert kept.keep_transactions_by_type(spark, base, mart)["cells"]["message"] == "built"
    assert kept_rows(spark, mart) == rebuilt(spark, base)
    # a change of columns that the sums don't use moves the note alone
    sums = lambda: kept.keep_sums(spark, base, f"{mart}/n", {"TransactionTypeId": F.col("TransactionTypeId")},
                                  "TransactionTypeId", {"n": F.lit(1)})
    sums()
    deliver(spark, [(*r[:4], decimal.Decimal(5)) for r in rows(60, 2)], base)
    before = sorted(versioned.read_current(spark, f"{mart}/n").collect())
    assert sums() == {"message": "changes merged", "row_count": 0, "buckets": 0}
    assert sorted(versioned.read_current(spark, f"{mart}/n").collect()) == before
    assert sums()["message"] == "no changes"
    with pytest.raises(ValueError, match="cancel"):
        kept.keep_sums(spark, base, f"{mart}/x", {"t": F.col("TransactionTypeId")}, "t", {"n": F.lit(1.5)})
    with pytest.raises(ValueError, match="bucketed"):
        kept.changed_rows(spark, base, 99, COLS)


def disc(values, p):
    s = sorted(values)
    return s[max(1, math.ceil(p * len(s))) - 1] if s else None


def test_exact_quartiles_with_ties_and_few_values(spark, monkeypatch):
    rng = random.Random(3)
    cols = {"even": [rng.randint(0, 10**6) for _ in range(3000)], "ties": [rng.choice([1, 1, 1, 2, 9]) for _ in range(3000)],
            "edge": [1] * 1500 + [2] * 1500, "few": [None] * 2999 + [5], "none": [None] * 3000,
            "huge": [2**62 + rng.randint(0, 50) for _ in range(3000)]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} long" for c in cols)).repartition(3)
    probs = [0.01, 0.25, 0.5, 0.75, 1.0]
    want = {c: [disc([v for v in x if v is not None], p) for p in probs] for c, x in cols.items()}
    assert marts.exact_quantiles(df, {c: probs for c in cols}) == want
    # a summary this coarse is wrong at first; the rounds still end at the exact ranks
    monkeypatch.setattr(marts, "SUMMARY_ACCURACY", 10)
    assert marts.exact_quantiles(df, {c: probs for c in cols}) == want


def test_numeric_profile(spark):
    df = spark.sql("SELECT CAST(id AS DECIMAL(9,2)) AS `a b`, 'x' AS t, CAST(NULL AS DOUBLE) AS n FROM range(1, 5)")
    got = {r["column_name"]: tuple(r)[1:] for r in marts.numeric_profile(df).collect()}
    assert got == {"a b": (4, 2.5, 1.291, 1.0, 2.0, 3.0), "n": (0, None, None, None, None, None)}
    assert marts.numeric_profile(df.filter("false")).filter("non_null > 0").count() == 0
    assert marts.numeric_profile(df.select("t")).count() == 0
