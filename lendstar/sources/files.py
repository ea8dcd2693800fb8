"""Reading and writing deliveries: delimited text, parquet and JDBC tables.

Existence is checked on the file system (Hadoop ``FileSystem`` of the path, so
the same code serves local disks, HDFS and object stores) and on the catalog,
never by catching a failed read of the data.
"""

from __future__ import annotations

import csv
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_data_files(spark: SparkSession, path: str) -> bool:
    """Path exists and holds at least one non-hidden file (part-*, *.parquet, *.csv)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    if fs.getFileStatus(p).isFile():
        return True
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The non-hidden files of a file, folder or glob pattern."""
    fs, p = _fs(spark, path)
    out = []
    for st in fs.globStatus(p) or []:
        it = fs.listFiles(st.getPath(), True)
        while it.hasNext():
            f = it.next().getPath()
            if not any(part.startswith(("_", ".")) for part in f.toString()[len(st.getPath().toString()):].split("/")[1:]):
                out.append(f.toString())
    return sorted(out)


def header_of(spark: SparkSession, path: str, sep: str = ";") -> tuple[str, ...]:
    """Column names in a delimited file's first line (compressed files too)."""
    fs, p = _fs(spark, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    raw = fs.open(p)
    try:
        stream = codec.createInputStream(raw) if codec else raw
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        raw.close()
    if not line:
        return ()
    return tuple(c.strip() for c in next(csv.reader([line.lstrip("\ufeff")], delimiter=sep)))


class Layout(NamedTuple):
    """Files with one header, and how it differs from the declared columns."""

    header: tuple[str, ...]
    files: list[str]
    missing: list[str]
    extra: list[str]
    reordered: bool


def delivery_layouts(spark: SparkSession, paths: list[str], schema: T.StructType, sep: str = ";") -> list[Layout]:
    """The distinct headers of the files; files without any line are left out.
    One line of each file is read here."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in paths:
        header = header_of(spark, f, sep)
        if header:
            groups.setdefault(header, []).append(f)
    declared = {f.name.lower(): i for i, f in enumerate(schema.fields)}
    out = []
    for header, files in sorted(groups.items()):
        at = [declared[h.lower()] for h in header if h.lower() in declared]
        if not at:
            raise ValueError(f"no declared column in the header of {files[0]}: {sep.join(header)}")
        if len(at) > len(set(at)):
            raise ValueError(f"a column twice in the header of {files[0]}: {sep.join(header)}")
        out.append(Layout(header, files, [f.name for i, f in enumerate(schema.fields) if i not in at],
                          [h for h in header if h.lower() not in declared], at != sorted(at)))
    return out


def read_layouts(spark: SparkSession, layouts: list[Layout], schema: T.StructType, sep: str = ";",
                 keep_corrupt: bool = True) -> DataFrame | None:
    """Files of any declared-by-name layouts as one table of the declared columns:
    a reordered column is found by its name, a missing one is NULL (conformance
    gives it its default or rejects the row), an extra one is left out."""
    declared = {f.name.lower(): f for f in schema.fields}
    marker = [T.StructField(CORRUPT, T.StringType(), True)] if keep_corrupt else []
    out = None
    for one in layouts:
        fields, names = [], {}
        for i, h in enumerate(one.header):
            f = declared.get(h.lower())
            fields.append(T.StructField(f"__{i}", f.dataType if f else T.StringType(), True))
            if f:
                names[f.name] = f"__{i}"
        reader = spark.read.option("header", True).option("sep", sep).schema(T.StructType(fields + marker))
        if keep_corrupt:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        df = reader.csv(one.files).select(
            *[F.col(names[f.name]).alias(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name)
              for f in schema.fields], *[m.name for m in marker])
        out = df if out is None else out.unionByName(df)
    return out


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   sep: str = ";", keep_corrupt: bool = True) -> DataFrame | None:
    """Delimited files with headers; ``None`` when missing or without rows.

    With a declared schema, columns are taken by the names in each file's header
    (``read_layouts``), and malformed lines are kept in ``_corrupt_record``
    (PERMISSIVE) so they can be quarantined with ``split_corrupt``; without a
    schema the types are inferred (exploration only: it reads the data twice).
    """
    files = data_files(spark, path)
    if not files:
        return None
    if schema is not None:
        df = read_layouts(spark, delivery_layouts(spark, files, schema, sep), schema, sep, keep_corrupt)
    else:
        df = spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)
    return None if df is None or df.isEmpty() else df


def split_corrupt(df: DataFrame, staged_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without the marker column, malformed raw lines).

    Spark refuses queries on raw delimited files that reference only the
    corrupt-record column (e.g. a count of good rows prunes everything else),
    so the parsed delivery is first stored as parquet in the shared work
    folder - parsed once, then split and read column-pruned any number of
    times.
    """
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    spark = df.sparkSession
    if staged_path is None:
        from lendstar.session import work_path
        staged_path = work_path(spark, "parsed")
    df.write.parquet(staged_path)
    parsed = spark.read.parquet(staged_path)
    good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw_line"))
    return good, bad


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet dataset; ``None`` when the path has no data files or no rows."""
    if not has_data_files(spark, path):
        return None
    df = spark.read.parquet(path)
    return None if df.isEmpty() else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None) -> DataFrame:
    """JDBC table; with a numeric ``partition_column`` the read is split into
    ``num_partitions`` parallel range queries instead of one connection."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()


def jdbc_table_exists(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> bool:
    """Ask the database's metadata (driver side, no data read)."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        if k != "driver":
            props.setProperty(k, str(v))
    if properties and "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        md = conn.getMetaData()
        for name in {table, table.upper(), table.lower()}:
            rs = md.getTables(None, None, name, None)
            try:
                if rs.next():
                    return True
            finally:
                rs.close()
        return False
    finally:
        conn.close()


def drop_columns_like(df: DataFrame, pattern: str) -> DataFrame:
    """``df`` without the columns whose name contains ``pattern``."""
    return df.drop(*[c for c in df.columns if pattern in c])


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", drop_pattern: str | None = "IdentityId",
               batch_size: int = 10000) -> None:
    """Append to a database table; columns whose name contains ``drop_pattern``
    are left out (the database assigns its own identity)."""
    if drop_pattern:
        df = drop_columns_like(df, drop_pattern)
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def first_available(*candidates):
    """First candidate that exists, as a DataFrame; ``None`` if none does.

    Each candidate is ``(exists_fn, load_fn)``: the existence test runs
    first, the load only for the chosen source.
    """
    for exists_fn, load_fn in candidates:
        if exists_fn():
            df = load_fn()
            if df is not None:
                return df
    return None
