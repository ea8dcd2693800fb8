"""Delimited files, parquet, versioned publish, month partitions, JDBC (Derby)."""

import os

import pytest
from pyspark.sql import functions as F

from lendstar.sources import files, versioned


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_declared_schema_quarantines_bad_lines(spark, scratch):
    p = os.path.join(scratch, "d", "part-0.csv")
    _write(p, "a;b;c\n1;x;2,5\nnot-a-number;y;1\n3;z;0\n")
    schema = "a int, b string, c string"
    from pyspark.sql.types import _parse_datatype_string
    df = files.read_delimited(spark, os.path.dirname(p), _parse_datatype_string(schema))
    good, bad = files.split_corrupt(df, os.path.join(scratch, "parsed"))
    assert good.count() == 2 and bad.count() == 1
    assert sorted(r.a for r in good.collect()) == [1, 3]
    assert [r.raw_line for r in bad.collect()] == ["not-a-number;y;1"]


def test_csv_inferred_schema(spark, scratch):
    p = os.path.join(scratch, "d", "x.csv")
    _write(p, "a;b\n1;x\n2;y\n")
    df = files.read_delimited(spark, os.path.dirname(p))
    assert dict(df.dtypes)["a"] == "int"


def test_missing_or_empty_source_is_none(spark, scratch):
    assert files.read_delimited(spark, os.path.join(scratch, "nope")) is None
    p = os.path.join(scratch, "e", "x.csv")
    _write(p, "a;b\n")
    assert files.read_delimited(spark, os.path.dirname(p)) is None
    assert files.read_parquet(spark, os.path.join(scratch, "nope")) is None


def test_versioned_publish_and_failed_write_keeps_current(spark, scratch):
    base = os.path.join(scratch, "tbl")
    assert versioned.read_current(spark, base) is None
    versioned.publish(spark.range(3), base)
    versioned.publish(spark.range(5), base)
    assert versioned.current_version(spark, base) == 2
    assert versioned.read_current(spark, base).count() == 5
    # A write that fails mid-way leaves no commit marker: version 2 stays current.
    bad = spark.range(10).select((F.lit(1) / (F.col("id") - 7)).cast("int").alias("id")) \
        .select(F.assert_true(F.col("id") != -1).alias("x"))
    with pytest.raises(Exception):
        versioned.publish(bad, base)
    assert versioned.current_version(spark, base) == 2
    assert versioned.read_current(spark, base).count() == 5
    # The next publish takes a fresh number, never the failed folder.
    assert versioned.publish(spark.range(1), base).endswith("v=4")


def test_month_partitions_prune(spark, scratch):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.date(2025, 5, 3)), (2, dt.date(2025, 6, 1)), (3, dt.date(2025, 6, 30))],
                               "id int, d date")
    path = os.path.join(scratch, "bym")
    versioned.write_by_month(df, path, "d")
    one = versioned.read_month(spark, path, 202506)
    assert sorted(r.id for r in one.collect()) == [2, 3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "yyyymm" in plan
    # Re-writing one month replaces only that month.
    versioned.write_by_month(df.filter("id = 2"), path, "d")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_roundtrip_with_embedded_derby(spark):
    url = "jdbc:derby:memory:lendstar;create=true"
    df = spark.range(1, 101).select(F.col("id").cast("int").alias("LoanAccountId"),
                                    F.col("id").cast("int").alias("LoanAccountIdentityId"),
                                    (F.col("id") * 2).cast("int").alias("Amount"))
    files.write_jdbc(df, url, "LOAN_ACCOUNT", DERBY)
    assert files.jdbc_table_exists(spark, url, "LOAN_ACCOUNT", DERBY)
    assert not files.jdbc_table_exists(spark, url, "NO_SUCH_TABLE", DERBY)
    back = files.read_jdbc(spark, url, "LOAN_ACCOUNT", DERBY, partition_column="LoanAccountId",
                           lower_bound=1, upper_bound=100, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert "LoanAccountIdentityId".upper() not in [c.upper() for c in back.columns]
    assert back.count() == 100 and back.filter("Amount > 150").count() == 25
    chosen = files.first_available(
        (lambda: files.jdbc_table_exists(spark, url, "LOAN_ACCOUNT", DERBY),
         lambda: files.read_jdbc(spark, url, "LOAN_ACCOUNT", DERBY)),
        (lambda: False, lambda: None))
    assert chosen.count() == 100
    assert files.first_available((lambda: False, lambda: None)) is None
