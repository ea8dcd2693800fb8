"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

``encode`` adds a column with the ids of every whole text, ``decode`` a column
with the raw bytes of every id list.  Both run one Arrow pass per partition
without a shuffle and keep all other columns.  Long texts are cut at places
where the pre-split pattern can never match across (``units``), so no text is
handed to the library whole; the ids are those of the whole text.

Null text gives an empty id list, a null id list gives empty bytes.  A column
of the output's name that is there already is replaced.  Special tokens are
ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstar.llm.common import read_table
from lendstar.llm.units import UnitMemo

RANK_FILE = "byte_bpe_50k.tiktoken"
ROWS_AT_ONCE = 256  # rows whose ids are Python objects at a time


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def _memo(path: str, pattern: str) -> UnitMemo:
    return UnitMemo(_encoding(path, pattern).encode_ordinary, max_units=300_000)


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> dict[int, bytes]:
    return {rank: tok for tok, rank in read_ranks(path).items()}


def _with_column(df: DataFrame, name: str, kind: T.DataType, src: str, make) -> DataFrame:
    """``make(array) -> array`` over Arrow batches, some rows at a time; other
    columns pass through."""
    keep = [f for f in df.schema.fields if f.name.lower() != name.lower()]
    schema = T.StructType([*keep, T.StructField(name, kind)])
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() != name.lower()]
    at, names = df.columns.index(src), [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(start, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([b.column(i) for i in kept] + [make(b.column(at))], names=names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, text_col: str = "text", out_col: str = "ids",
           rank_path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with ``out_col``: array<int>, the ids of each whole text."""
    path = rank_path or public_tokenizers.path(RANK_FILE)

    def make(texts: pa.Array) -> pa.Array:
        memo = _memo(path, pattern)
        ids = [memo.encode(t) for t in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
        flat = np.frombuffer(b"".join(ids), dtype="<i4")
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return _with_column(df, out_col, T.ArrayType(T.IntegerType(), False), text_col, make)


def decode(df: DataFrame, ids_col: str = "ids", out_col: str = "decoded", rank_path: str | None = None) -> DataFrame:
    """``df`` with ``out_col``: binary, the bytes that the ids stand for (not
    cleaned up as UTF-8: an id may end within a character)."""
    path = rank_path or public_tokenizers.path(RANK_FILE)

    def make(lists: pa.Array) -> pa.Array:
        table = _token_bytes(path).__getitem__
        return pa.array([b"".join(map(table, x)) if x else b"" for x in lists.to_pylist()], type=pa.binary())

    return _with_column(df, out_col, T.BinaryType(), ids_col, make)


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text of ``documents``, decode the ids, digest both."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode(docs, "text", "ids").select("doc_id", "ids")
    return decode(ids, "ids", "decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
