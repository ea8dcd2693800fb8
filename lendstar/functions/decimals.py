"""European decimal strings ("1234,56", padded, or NULL tokens) to DECIMAL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendstar.specs import AMOUNT_PRECISION, AMOUNT_SCALE

# Raw tokens that mean "no amount" and become 0.
NULL_TOKENS = ("", "NULL", "null")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_null_token(c) -> Column:
    c = _col(c)
    return c.isNull() | c.isin(*NULL_TOKENS)


# Whitespace stripped around amounts (the characters of regex \s).
WHITESPACE = " \t\n\r\f\u000b"


def _normalised(c) -> Column:
    # Strip surrounding whitespace, then comma -> dot (character ops, no regex).
    return F.translate(F.trim(_col(c), F.lit(WHITESPACE)), ",", ".")


def european_decimal(c, precision: int = AMOUNT_PRECISION, scale: int = AMOUNT_SCALE) -> Column:
    """NULL tokens -> 0, otherwise parsed; unparseable text -> NULL (never an error)."""
    dtype = f"decimal({precision},{scale})"
    return (
        F.when(is_null_token(c), F.lit(0).cast(dtype))
        .otherwise(_normalised(c).try_cast(dtype))
    )


def is_unparseable(c, precision: int = AMOUNT_PRECISION, scale: int = AMOUNT_SCALE) -> Column:
    """True when the raw value is present but does not parse as a decimal.

    Equivalent to ``european_decimal(c) IS NULL``: NULL tokens give 0.
    """
    return european_decimal(c, precision, scale).isNull()
