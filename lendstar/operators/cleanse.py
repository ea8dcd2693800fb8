"""Raw delivery -> cleansed table.

``conform`` types the amounts, fills declared defaults and checks NOT NULL /
length constraints, splitting rows into accepted and rejected (with a reason)
instead of silently nulling or aborting.  ``clean`` then nulls the -1
sentinels, keeps the latest row per business key and adds computed columns.

Keep-latest is ``row_number() = 1`` over the key: Spark plans it as a
WindowGroupLimit that also runs *before* the shuffle, so a key holding a large
share of the rows is cut to one row per map partition before it moves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendstar.functions.dates import date_from_key
from lendstar.functions.decimals import european_decimal, is_unparseable
from lendstar.specs import TableSpec

REASON = "reject_reason"


def _checks(spec: TableSpec) -> list[tuple[Column, str]]:
    """(violated?, reason) per rule, over the conformed columns.

    A conformed amount is NULL exactly when its raw text was present but not a
    number (NULL tokens became 0), so no rule re-reads the raw text.
    """
    checks = [(F.col(c).isNull(), f"{c} unparseable") for c in spec.amount_cols]
    checks += [(F.col(c).isNull(), f"{c} is null")
               for c in spec.not_null_cols if c not in spec.amount_cols]
    checks += [(F.length(F.col(c)) != n, f"{c} length <> {n}")
               for c, n in spec.length_checks.items()]
    checks += [(F.col(k).isNotNull() & date_from_key(k).isNull(), f"{k} is no date")
               for k in spec.date_keys.values()]
    return checks


def _typed(df: DataFrame, spec: TableSpec, keep: list[str] | None = None) -> DataFrame:
    """Declared defaults filled and amounts parsed, in one projection."""
    def conformed(f):
        c = F.col(f.name)
        if f.name in spec.amount_cols:
            return european_decimal(c)
        if f.name in spec.defaults:
            return F.coalesce(c, F.lit(spec.defaults[f.name]).cast(f.dataType))
        return c
    return df.select(*[conformed(f).alias(f.name) for f in spec.schema.fields], *(keep or []))


def _violated(spec: TableSpec) -> Column:
    # A NULL comparison (e.g. length of NULL) is not a violation by itself;
    # NOT NULL is its own rule.
    return reduce(lambda a, b: a | b, [F.coalesce(v, F.lit(False)) for v, _ in _checks(spec)],
                  F.lit(False))


def _reason(spec: TableSpec) -> Column:
    return F.concat_ws("; ", *[F.when(v, F.lit(r)) for v, r in _checks(spec)])


def conform(df: DataFrame, spec: TableSpec, keep: list[str] | None = None) -> DataFrame:
    """Typed, defaulted frame plus a ``reject_reason`` column ('' = accepted) and
    the columns of ``keep`` as they are."""
    typed = _typed(df, spec, keep)
    return typed.select("*", _reason(spec).alias(REASON))


def accepted(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows passing every rule: a boolean filter, no reason text is built."""
    return _typed(df, spec).filter(~_violated(spec))


def rejected(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, order column and the reasons of every row failing some rule."""
    typed = _typed(df, spec)
    return typed.filter(_violated(spec)).select(spec.key, spec.order_col, _reason(spec).alias(REASON))


def unparseable_amounts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per (row, amount column) whose text is present but not a number."""
    items = F.array(*[
        F.when(is_unparseable(F.col(c)),
               F.struct(F.lit(c).alias("column_name"), F.col(c).alias("raw_value")))
        for c in spec.amount_cols])
    return (df.select(spec.key, spec.order_col, F.explode(items).alias("bad"))
            .filter(F.col("bad").isNotNull())
            .select(spec.key, spec.order_col, "bad.column_name", "bad.raw_value"))


def null_sentinels(df: DataFrame, cols, sentinel: int = -1) -> DataFrame:
    cols = set(cols)
    return df.select(*[
        (F.when(F.col(c) == sentinel, F.lit(None)).otherwise(F.col(c)).alias(c)
         if c in cols else F.col(c)) for c in df.columns])


def latest_order(order_col: str, tiebreak: list[str]) -> list[Column]:
    """Newest first; remaining columns break ties so the winner is deterministic."""
    return [F.col(order_col).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]


def dedup_latest(df: DataFrame, key: str, order_col: str, tiebreak: list[str] | None = None,
                 within: list[str] | None = None) -> DataFrame:
    """Keep one row per ``key``: the one with the greatest ``order_col``.  Rows that
    are shuffled by ``within``, which follows from the key, don't move again."""
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in (key, order_col)]
    w = Window.partitionBy(*(within or []), key).orderBy(*latest_order(order_col, tiebreak))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def key_counts(ok: DataFrame, key: str) -> tuple[int, int, bool]:
    """Number of different keys, rows of the most frequent one, and whether one is
    NULL.  Only keys move."""
    n = ok.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    keys, most, nulls = n.agg(F.count(F.lit(1)), F.max("__n"), F.count(F.when(F.col(key).isNull(), 1))).first()
    return keys, most or 0, bool(nulls)


def with_computed(df: DataFrame, spec: TableSpec) -> DataFrame:
    extra = [date_from_key(k).alias(d) for d, k in spec.date_keys.items()]
    if spec.is_active_from:
        extra.append(F.col(spec.is_active_from).isNull().cast("int").alias("IsActive"))
    return df.select("*", *extra)


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """accepted rows -> sentinels to NULL -> latest per key -> computed columns."""
    return clean_accepted(accepted(df, spec), spec)


def clean_accepted(ok: DataFrame, spec: TableSpec) -> DataFrame:
    ok = null_sentinels(ok, spec.sentinel_cols)
    ok = dedup_latest(ok, spec.key, spec.order_col)
    return with_computed(ok, spec)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
