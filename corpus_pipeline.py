"""Corpus pipeline: documents to packed training sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's ``docs``.  All but the last return the columns of documents,
``n_chars`` brought up to date where the text changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.llm.common import stored
from lendstar.llm.langid import drop_rejected
from lendstar.llm.linededup import dedup_lines
from lendstar.llm.minhash import near_duplicates
from lendstar.llm.packing import pack
from lendstar.llm.suffixes import remove_repeats


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a text in any language go."""
    return drop_rejected(docs, declared=F.col("lang"), host=F.col("source"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines within one edit of an earlier one go; a document without any other goes with them."""
    return _recounted(dedup_lines(docs)).filter(r"text RLIKE '[^\\x20\\x09-\\x0D]'")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, 0.8."""
    return near_duplicates(docs, shingle=5, percent=80).filter("kept").select(*docs.columns)


def _whole_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = pa.array([k.decode("utf-8", "ignore") for k in b.column(b.num_columns - 1).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], text], names=[*b.schema.names[:-1], "text"])


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes that occur twice go; what's left of a character
    that a cut went through goes with them."""
    kept = remove_repeats(docs).select(*[c for c in docs.columns if c != "text"], "kept")
    text = kept.withColumnRenamed("kept", "text")
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in text.columns)
    return _recounted(text.mapInArrow(_whole_characters, kinds).select(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids."""
    return pack(docs, memo_units=300_000)  # beside what earlier stages left in the JVM


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("packing", packing),
]

# Language ID and packing need a trained model and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
