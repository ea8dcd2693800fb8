"""Column-level building blocks (all JVM-side built-in expressions)."""

from lendstar.functions.audit import audit_values, with_audit
from lendstar.functions.dates import date_from_key, date_key, month_key, us_week_of_year
from lendstar.functions.decimals import european_decimal, is_null_token, is_unparseable
from lendstar.functions.text import norm_key

__all__ = [
    "audit_values", "with_audit", "date_from_key", "date_key", "month_key", "us_week_of_year",
    "european_decimal", "is_null_token", "is_unparseable", "norm_key",
]
