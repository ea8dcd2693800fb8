"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.session import stored

__all__ = ["ascii_lower", "fresh_names", "read_table", "stored", "text_or_empty"]

# Words of lower-cased text, as the licence scan and the fingerprints use them.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column | str) -> Column:
    """A-Z to a-z; every other character stays (same in every SQL engine)."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores in front until no column has that name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
