"""Surrogate keys: dense, gap-free identity numbers in key order, at scale.

``row_number() over (order by k)`` moves every row into one task.  Instead:

1. range-partition on the key and sort inside each partition;
2. in the same job, tag every row with its partition id and its position in
   the partition, and write the tagged rows as a parquet table in the shared
   work folder (``spark.checkpoint.dir``).  Range bounds are sampled once per
   job; a retried task re-sends the same rows to the same partition (bounds
   fixed, key unique) and the sort gives them the same positions, so the
   stored tags are consistent even when executors are lost;
3. count rows per partition from the stored table - one tiny aggregate;
4. prefix-sum those counts (one row per partition) and broadcast the offsets;
5. identity = offset of the partition + position + 1 (+ base).

The result equals the global ``row_number`` over the key, which must be
unique.  The written table cuts the lineage: later stages never re-sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendstar.session import COMPRESSION, work_path

_POS_BITS = 33  # monotonically_increasing_id keeps the in-partition row number in the low 33 bits


def _with_base(ident, base):
    if isinstance(base, DataFrame):
        # One-row frame -> scalar subquery, evaluated once.
        bcol = base.columns[0]
        return ident + base.select(F.coalesce(F.col(bcol).cast("long"), F.lit(0).cast("long"))).scalar()
    if base:
        return ident + F.lit(int(base))
    return ident


def assign_dense_identity(df: DataFrame, key, identity_col: str, base=None,
                          num_partitions: int | None = None) -> DataFrame:
    """Prepend ``identity_col`` = rank of ``key`` (1-based) + ``base``.

    ``key``: column name or list of names (lexicographic order, NULLs first).
    ``base``: None, an int, or a one-row DataFrame holding one numeric column
    (e.g. the current maximum identity of the target table).
    Inputs of every size take the same path; ``num_partitions`` (the session's
    shuffle partitions by default) may be 1 for a code table.
    """
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    ordered = [F.col(k).asc_nulls_first() for k in keys]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered)
    pid = F.spark_partition_id()
    tagged = ranged.select("*", pid.alias("__pid"),
                           (F.monotonically_increasing_id()
                            - F.shiftleft(pid.cast("long"), _POS_BITS)).alias("__pos"))
    path = work_path(spark, "identity")
    tagged.write.option("compression", COMPRESSION).parquet(path)
    stored = spark.read.parquet(path)

    counts = stored.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # Window over at most one row per partition: bounded by the partition count.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))

    ident = _with_base(F.col("__off") + F.col("__pos") + F.lit(1), base)
    out = stored.join(F.broadcast(offsets), "__pid")  # one row per partition
    return out.select(ident.cast("long").alias(identity_col), *df.columns)


def max_identity(df: DataFrame, identity_col: str, alias: str = "max_id") -> DataFrame:
    """One row: the largest identity, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(identity_col).cast("long"), F.lit(0).cast("long")).alias(alias))


def key_range(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))
