"""End-to-end: table pipeline with versioned publish, run log, driver contract."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lendstar.fixtures import Fixtures
from lendstar.plans import pipeline
from lendstar.sources import versioned
from lendstar.specs import ACCOUNT, BALANCE



def test_table_pipeline_first_load_rerun_and_changes(spark, scratch, sf_dir):
    fx = Fixtures(spark, sf_dir)
    base = os.path.join(scratch, "acc")
    first = pipeline.run_table_etl(fx.acc, ACCOUNT, base, "2025-06-01 08:00:00")
    assert first["message"] == "first load" and first["row_count"] > 0
    again = pipeline.run_table_etl(fx.acc, ACCOUNT, base, "2025-06-02 08:00:00")
    assert again["message"] == "no changes" and versioned.current_version(spark, base) == 1
    day2 = pipeline.run_table_etl(fx.acc2, ACCOUNT, base, "2025-06-15 08:00:00")
    assert day2["message"] == "changes merged" and versioned.current_version(spark, base) == 2
    snap = versioned.read_current(spark, base)
    # Keys stay unique; identities of accounts present on day 1 do not move.
    assert snap.groupBy(ACCOUNT.key).count().filter("count > 1").isEmpty()
    v1 = spark.read.parquet(f"{base}/v=1").select(ACCOUNT.key, F.col(ACCOUNT.identity_col).alias("i1"))
    moved = v1.join(snap.select(ACCOUNT.key, F.col(ACCOUNT.identity_col).alias("i2")), ACCOUNT.key) \
        .filter("i1 <> i2")
    assert moved.isEmpty()


def test_run_all_isolates_failures(spark, scratch, sf_dir):
    fx = Fixtures(spark, sf_dir)
    broken = fx.bal.drop("Balance")
    log = pipeline.run_all(spark, {
        "account": (fx.acc, ACCOUNT, os.path.join(scratch, "a")),
        "balance": (broken, BALANCE, os.path.join(scratch, "b")),
    }, "2025-06-01 08:00:00")
    status = {r.step: r.status for r in log.collect()}
    assert status == {ACCOUNT.name: "ok", BALANCE.name: "error"}


def test_profit_run_log_warns_on_fallback_rate(spark, scratch, sf_dir):
    fx = Fixtures(spark, sf_dir)
    inputs = (fx.interest_rates, fx.energy_class_margin, fx.credit_risk_tier, fx.depreciation_rates)
    log = {r.step: r for r in pipeline.publish_profit_month(fx.cars, *inputs, "2025-06-15", scratch).collect()}
    assert log["rate_lookup"].status == "warning"
    assert "2025-05-01" in log["rate_lookup"].message
    assert log["estimates"].output_name == "LoanProfitEstimates_202506"
    assert log["estimates"].row_count == pipeline.read_profit_month(spark, scratch, "2025-06-15").count() > 0
    assert spark.sql("SELECT * FROM LoanProfitEstimates_202506").count() == log["estimates"].row_count
    with pytest.raises(pipeline.SourceMissing, match="CarInformation for 2025-08 not found"):
        pipeline.publish_profit_month(fx.cars, *inputs, "2025-08-15", scratch)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_any_split_and_order_of_deliveries_gives_one_result(spark, scratch, sf_dir):
    """Late rows never replace newer ones; raw = accepted + rejected in every log."""
    fx = Fixtures(spark, sf_dir)
    raw = fx.acc.filter("LoanAccountId % 10 = 0")
    rows = raw.collect()
    rnd = random.Random(3)
    want = None
    for k in range(3):
        rnd.shuffle(rows)
        base = os.path.join(scratch, f"split{k}")
        parts = [rows] if k == 0 else [rows[i::k + 1] for i in range(k + 1)]
        for i, part in enumerate(parts):
            rec = pipeline.run_table_etl(spark.createDataFrame(part, raw.schema), ACCOUNT, base, f"2025-06-0{i + 1} 08:00:00")
            assert rec["raw_rows"] == rec["accepted_rows"] + rec["rejected_rows"] == len(part)
        got = sorted((r[ACCOUNT.key], r["OpenDateId"]) for r in versioned.read_current(spark, base).collect())
        want = want or got
        assert got == want and len(got) == len({k for k, _ in got})


def test_rejects_are_kept_and_work_folder_is_removed(spark, scratch, sf_dir):
    from lendstar.session import ensure_checkpoint_dir
    fx = Fixtures(spark, sf_dir)
    base = os.path.join(scratch, "bal")
    work = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "lendstar-work")
    before = set(os.listdir(work)) if os.path.isdir(work) else set()
    for _ in range(2):  # a repeated run replaces its own rejects
        rec = pipeline.run_table_etl(fx.bal, BALANCE, base, "2025-06-01 08:00:00")
    rejects = spark.read.parquet(pipeline.rejects_path(base))
    assert rejects.count() == rec["rejected_rows"] > 0
    assert rejects.filter("reject_reason LIKE '%BalanceDateId is no date%'").count() > 0
    assert set(os.listdir(work)) == before


def test_star_keeps_keys_and_isolates_failures(spark, scratch, sf_dir):
    from lendstar.functions.audit import with_audit
    from lendstar.operators import cleanse
    from lendstar.specs import TRANSACTION
    fx = Fixtures(spark, sf_dir)
    acc, bal, txn = (with_audit(cleanse.clean(df, s), "2025-06-01 08:00:00") for df, s in (
        (fx.acc.filter("LoanAccountId > 20"), ACCOUNT), (fx.bal, BALANCE), (fx.txn, TRANSACTION)))
    log = {r.step: r.status for r in pipeline.run_star(spark, acc, bal.drop("BalanceSek"), txn, scratch, "2025-06-01").collect()}
    assert log.pop("fact_balance") == "error" and log.pop("fact_transaction_orphans") == "warning"
    assert set(log.values()) == {"ok"}
    old = versioned.read_current(spark, f"{scratch}/dim_account").select("account_id", F.col("account_key").alias("k"))
    pipeline.run_star(spark, cleanse.clean(fx.acc, ACCOUNT), bal, txn, scratch, "2025-06-02")
    new = versioned.read_current(spark, f"{scratch}/dim_account")
    assert new.join(old, "account_id").filter("k <> account_key").isEmpty()
    assert new.select("account_key").distinct().count() == new.count() > old.count()
    runs = spark.read.parquet(f"{scratch}/run_log").withColumn("waits", F.col("step").endswith("_orphans"))
    assert runs.filter("NOT waits").count() == 18
    waiting = {str(r["run_ts"])[:10]: r["row_count"] for r in runs.filter("step = 'fact_transaction_orphans'").collect()}
    assert waiting["2025-06-01"] > waiting["2025-06-02"]  # those of accounts that came later are loaded


def test_star_logs_dates_outside_the_calendar(spark):
    days = spark.createDataFrame([("9999-12-31",), ("9999-12-31",), ("1889-01-01",), ("2024-02-29",), (None,)], "d string")
    bal = days.select(F.col("d").cast("date").alias("BalanceDate"))
    acc = bal.filter("BalanceDate = '2024-02-29'").withColumnRenamed("BalanceDate", "OpenDate")
    log = pipeline._calendar_warnings(((bal, "BalanceDate"), (acc, "OpenDate")), "dim_date")
    assert [(r["step"], r["status"], r["row_count"], r["message"]) for r in log] == [
        ("calendar_check", "warning", 3, "BalanceDate: 2 dates outside 1990-01-01..2060-12-31, from 1889-01-01 to 9999-12-31")]


def test_star_run_stores_calendar_warnings(spark, scratch, sf_dir):
    from lendstar.functions.audit import with_audit
    from lendstar.operators import cleanse
    from lendstar.specs import TRANSACTION
    fx = Fixtures(spark, sf_dir)
    acc, bal, txn = (with_audit(cleanse.clean(df.limit(50), s), "2025-06-01 08:00:00") for df, s in (
        (fx.acc, ACCOUNT), (fx.bal, BALANCE), (fx.txn, TRANSACTION)))
    acc = acc.withColumn("OpenDate", F.lit("9999-12-31").cast("date"))
    log = pipeline.run_star(spark, acc, bal, txn, scratch, "2025-06-01").filter("step = 'calendar_check'").collect()
    assert [(r["status"], r["row_count"]) for r in log] == [("warning", acc.count())]
    stored = spark.read.parquet(f"{scratch}/run_log").filter("step = 'calendar_check'")
    assert stored.count() == 1


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from lendstar import session
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    cluster = SimpleNamespace(conf=conf, sparkContext=sc)
    with pytest.raises(RuntimeError, match="shared|all executors share"):
        session.ensure_checkpoint_dir(cluster)
    with pytest.raises(RuntimeError, match="outlives"):
        session.lasting_path(cluster, "streams")
