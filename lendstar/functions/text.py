"""Text normalisation for code-table keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_key(c) -> Column:
    """Upper-case with surrounding spaces removed (spaces only, like LTRIM/RTRIM)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(c))
