"""File-source stream: each new delivery is merged once; re-runs pick up nothing."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from lendstar.fixtures import Fixtures
from lendstar.sources import files, versioned
from lendstar.specs import ACCOUNT
from lendstar.streaming import ingest_deliveries



def test_stream_ingests_new_files_once(spark, scratch, sf_dir):
    fx = Fixtures(spark, sf_dir)
    src = os.path.join(scratch, "incoming")
    target = os.path.join(scratch, "acc")
    ckpt = os.path.join(scratch, "ckpt")
    files.write_delimited(fx.acc.coalesce(1), os.path.join(scratch, "d1"))
    files.write_delimited(fx.acc2.coalesce(1), os.path.join(scratch, "d2"))

    def deliver(name, folder):
        os.makedirs(src, exist_ok=True)
        part = [f for f in os.listdir(os.path.join(scratch, folder)) if f.endswith(".csv")][0]
        os.replace(os.path.join(scratch, folder, part), os.path.join(src, name))

    deliver("day1.csv", "d1")
    log = ingest_deliveries(spark, src, ACCOUNT, target, "2025-06-01 08:00:00", checkpoint=ckpt)
    assert [r["message"] for r in log] == ["first load"]
    assert ingest_deliveries(spark, src, ACCOUNT, target, "2025-06-02 08:00:00", checkpoint=ckpt) == []
    deliver("day2.csv", "d2")
    log = ingest_deliveries(spark, src, ACCOUNT, target, "2025-06-15 08:00:00", checkpoint=ckpt)
    assert [r["message"] for r in log] == ["changes merged"]
    snap = versioned.read_current(spark, target)
    assert snap.groupBy(ACCOUNT.key).count().filter(F.col("count") > 1).isEmpty()
    assert snap.filter(F.col(ACCOUNT.key) < 0).count() > 0


_APP = """
import sys
sys.path.insert(0, sys.argv[1])
from lendstar.session import build_session
from lendstar.specs import ACCOUNT
from lendstar.streaming import ingest_deliveries
spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": sys.argv[2] + "/shared"})
log = ingest_deliveries(spark, sys.argv[2] + "/in/*", ACCOUNT, sys.argv[2] + "/acc", "2025-06-01 08:00:00")
print("LOG", [(r["message"], r["raw_rows"], r["rejected_rows"]) for r in log])
"""


def test_two_applications_share_the_default_checkpoint(spark, scratch, sf_dir):
    """A second application reads nothing again; a broken line is rejected, not lost."""
    fx = Fixtures(spark, sf_dir)
    rows = fx.acc.filter("LoanAccountId <= 20")
    n = rows.count()
    files.write_delimited(rows.coalesce(1), os.path.join(scratch, "out"))
    part = next(f for f in os.listdir(os.path.join(scratch, "out")) if f.endswith(".csv"))
    os.makedirs(os.path.join(scratch, "in", "d1"))
    with open(os.path.join(scratch, "out", part)) as src, open(os.path.join(scratch, "in", "d1", "day1.csv"), "w") as dst:
        dst.write(src.read() + "no;such;line\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = [subprocess.run([sys.executable, "-c", _APP, root, scratch], capture_output=True, text=True, timeout=300).stdout
            for _ in range(2)]
    assert f"LOG [('first load', {n + 1}, " in said[0] and "LOG []" in said[1]
    rejects = spark.read.parquet(os.path.join(scratch, "acc_rejects"))
    assert rejects.filter("reject_reason = 'malformed line'").count() == 1


def test_rejects_of_every_batch_of_a_run_are_kept(spark, scratch, sf_dir):
    """Two files with a broken line each, a file per batch, one run time."""
    fx = Fixtures(spark, sf_dir)
    files.write_delimited(fx.acc.filter("LoanAccountId <= 20").coalesce(1), os.path.join(scratch, "out"))
    part = next(f for f in os.listdir(os.path.join(scratch, "out")) if f.endswith(".csv"))
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for name in ("day1", "day2"):
        with open(os.path.join(scratch, "out", part)) as rows, open(os.path.join(src, f"{name}.csv"), "w") as dst:
            dst.write(rows.read() + f"no;such;{name}\n")
    target = os.path.join(scratch, "acc")
    log = ingest_deliveries(spark, src, ACCOUNT, target, "2025-06-01 08:00:00",
                            checkpoint=os.path.join(scratch, "ckpt"), max_files_per_batch=1)
    rejects = spark.read.parquet(f"{target}_rejects")
    assert len(log) == 2 and rejects.count() == sum(r["rejected_rows"] for r in log)
    assert {r["batch_id"]: r["count"] for r in rejects.filter("reject_reason = 'malformed line'")
            .groupBy("batch_id").count().collect()} == {0: 1, 1: 1}
