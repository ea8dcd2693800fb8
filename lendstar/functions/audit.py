"""Audit columns in local (Stockholm) time from an explicit run timestamp.

``run_ts`` is a UTC wall-clock timestamp (string or datetime).  Conversion uses
``convert_timezone`` on TIMESTAMP_NTZ so the result does not depend on the
session time zone.  Nothing here reads the clock: re-running with the same
``run_ts`` gives the same rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_TZ = "Europe/Stockholm"


def _ts_literal(run_ts) -> Column:
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp_ntz")
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def audit_values(run_ts, tz: str = LOCAL_TZ) -> tuple[Column, Column, Column]:
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), _ts_literal(run_ts))
    return (
        local.alias("CreatedDate"),
        local.cast("date").alias("UpdatedDate"),
        F.date_format(local, "HH:mm:ss").alias("UpdatedTime"),
    )


def with_audit(df: DataFrame, run_ts, tz: str = LOCAL_TZ) -> DataFrame:
    """Append CreatedDate / UpdatedDate / UpdatedTime."""
    return df.select("*", *audit_values(run_ts, tz))
