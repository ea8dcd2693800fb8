"""Session helpers: building a local session for tests/bench and resolving the
shared work folder (``spark.checkpoint.dir``) used for checkpoints and
intermediate tables.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A folder of our own is set only when the
setting is absent (local runs and tests).
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
COMPRESSION = "zstd"  # of stored and published tables
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scope = threading.local()


def build_session(master: str = "local[8]", app: str = "lendstar",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A session configured the way the pipelines expect (AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Loan tables are 16-27 columns wide and cleansing filters touch most
        # of them; inferring constraints through the renaming projections costs
        # seconds of planning per query and adds no filter the pipelines need.
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"{CHECKPOINT_CONF} isn't set: {sc.master} needs a folder that all executors share")
        # Local runs / tests only: the cluster names its shared folder itself.
        conf_dir = tempfile.mkdtemp(prefix="lendstar-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder for intermediate tables."""
    base = getattr(_scope, "folder", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts) if parts else ""
    tail = uuid.uuid4().hex if getattr(_scope, "folder", None) else f"lendstar-work/{uuid.uuid4().hex}"
    return f"{base}/{tail}/{leaf}" if leaf else f"{base}/{tail}"


def stored(df: DataFrame, name: str, more: list[DataFrame] | None = None, path: str | None = None) -> DataFrame:
    """``df`` written once below the shared folder and read back: computed once
    however often it's used, and safe from lost executors.  The rows of ``more``
    are written after it, one frame at a time."""
    path = path or work_path(df.sparkSession, name)
    for part in [df, *(more or [])]:
        part.write.mode("append").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def lasting_path(spark: SparkSession, *parts: str) -> str:
    """The same path in every application, below the configured shared folder
    (Spark's own checkpoint folder is a new one for each application)."""
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        raise RuntimeError(f"{CHECKPOINT_CONF} isn't set: name a folder that outlives the application")
    return "/".join([conf_dir.rstrip("/"), *parts])


@contextmanager
def work_folder(spark: SparkSession):
    """Within it ``work_path`` hands out folders below one that is removed at the
    end: what a publish read has been copied by then.  Each action's shuffle files go
    when it ends, not when the driver happens to collect its garbage: an action
    writes what later ones read."""
    outer = getattr(_scope, "folder", None)
    _scope.folder = folder = work_path(spark)
    cleanup = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield folder
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, cleanup)
        _scope.folder = outer
        remove(spark, folder)
