"""Idempotent upserts of a new delivery into a snapshot, in four styles.

All of them start from one ``changes.classify`` pass (a single full-outer
join on the unique key).  New identities come from ``keys.assign_dense_identity``
continuing after the current maximum, so identities of untouched rows never
move and a re-run with unchanged input produces an identical snapshot.

* ``upsert_snapshot``: untouched rows keep identity; inserted and updated rows
  are re-issued with fresh identities (delete + insert).
* ``merge_upsert``: MERGE semantics; matched rows keep identity and
  CreatedDate, updated rows take new values and UpdatedDate/Time.
* ``append_changes``: history by appending every changed version.
* ``scd2_apply``: slowly changing dimension type 2 (valid_from / valid_to /
  is_current); ``scd2_merge`` the same for deliveries in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendstar.functions.audit import audit_values
from lendstar.operators.changes import (CHANGE, INSERT, MISSING, SAME, STALE, UPDATE, classify,
                                        new_col, old_col, old_extra, side)
from lendstar.operators.keys import assign_dense_identity, max_identity
from lendstar.session import stored
from lendstar.specs import AUDIT_COLS


def upsert_snapshot(old: DataFrame, new: DataFrame, key: str, identity_col: str,
                    business_cols: list[str], order_col: str | None = None) -> DataFrame:
    c = classify(new, old, key, business_cols, old_extra=[identity_col], order_col=order_col)
    kept = (c.filter(F.col(CHANGE).isin(SAME, MISSING, STALE))
            .select(old_extra(identity_col).alias(identity_col), key,
                    *[old_col(x).alias(x) for x in business_cols if x != key]))
    changed = side(c, key, business_cols, new_col, (INSERT, UPDATE))
    fresh = assign_dense_identity(changed, key, identity_col, base=max_identity(old, identity_col))
    cols = [identity_col] + business_cols
    return kept.select(*cols).unionByName(fresh.select(*cols))


def merge_upsert(old: DataFrame, new: DataFrame, key: str, identity_col: str,
                 business_cols: list[str], run_ts, order_col: str | None = None) -> DataFrame:
    c = stored(classify(new, old, key, business_cols, old_extra=[identity_col] + AUDIT_COLS,
                        order_col=order_col), "classified")
    return merge_classified(c, old, key, identity_col, business_cols, run_ts)


def merge_classified(c: DataFrame, old: DataFrame, key: str, identity_col: str,
                     business_cols: list[str], run_ts) -> DataFrame:
    """``merge_upsert`` from a classified frame that is stored already."""
    created, upd_date, upd_time = audit_values(run_ts)
    is_upd = F.col(CHANGE) == UPDATE
    matched = c.filter(F.col(CHANGE).isin(UPDATE, SAME, MISSING, STALE)).select(
        old_extra(identity_col).alias(identity_col), key,
        *[F.when(is_upd, new_col(x)).otherwise(old_col(x)).alias(x)
          for x in business_cols if x != key],
        old_extra("CreatedDate").alias("CreatedDate"),
        F.when(is_upd, upd_date).otherwise(old_extra("UpdatedDate")).alias("UpdatedDate"),
        F.when(is_upd, upd_time).otherwise(old_extra("UpdatedTime")).alias("UpdatedTime"),
    )
    inserted = side(c, key, business_cols, new_col, (INSERT,))
    inserted = assign_dense_identity(inserted, key, identity_col,
                                     base=max_identity(old, identity_col))
    inserted = inserted.select("*", created, upd_date, upd_time)
    cols = [identity_col] + business_cols + AUDIT_COLS
    return matched.select(*cols).unionByName(inserted.select(*cols))


def append_changes(old: DataFrame, new: DataFrame, key: str, identity_col: str,
                   business_cols: list[str], order_col: str | None = None) -> DataFrame:
    c = classify(new, old, key, business_cols, order_col=order_col)
    changed = side(c, key, business_cols, new_col, (INSERT, UPDATE))
    fresh = assign_dense_identity(changed, key, identity_col, base=max_identity(old, identity_col))
    cols = [identity_col] + business_cols
    return old.select(*cols).unionByName(fresh.select(*cols))


def scd2_initial(snapshot: DataFrame, key: str, tracked: list[str], valid_from) -> DataFrame:
    vf = F.lit(valid_from).cast("date") if isinstance(valid_from, str) else valid_from
    return snapshot.select(key, *[c for c in tracked if c != key],
                           vf.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
                           F.lit(True).alias("is_current"))


def scd2_apply(dim: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], as_of) -> DataFrame:
    """Close changed current rows the day before ``as_of`` and open new ones.

    A row opened on ``as_of`` itself is replaced, not closed (a second delivery
    of the day); one opened later is left alone: ``as_of`` is then too late.

    ``dim`` holds key, tracked columns, valid_from, valid_to, is_current.  Keys
    missing from the snapshot stay current (deliveries do not delete).  Only
    current rows take part in the join; closed history passes through.
    """
    as_of_c = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    cols = [c for c in tracked if c != key]
    history = dim.filter(~F.col("is_current"))
    current = dim.filter(F.col("is_current"))
    c = classify(snapshot, current, key, [key] + cols, old_extra=["valid_from", "valid_to"])
    begun = old_extra("valid_from")
    late = (F.col(CHANGE) == UPDATE) & (begun > as_of_c)
    is_upd = (F.col(CHANGE) == UPDATE) & (begun < as_of_c)
    replaced = (F.col(CHANGE) == UPDATE) & (begun == as_of_c)
    old_rows = c.filter(F.col(CHANGE).isin(UPDATE, SAME, MISSING) & ~F.coalesce(replaced, F.lit(False))).select(
        key, *[old_col(x).alias(x) for x in cols],
        old_extra("valid_from").alias("valid_from"),
        F.when(is_upd, F.date_sub(as_of_c, 1)).otherwise(old_extra("valid_to")).alias("valid_to"),
        (~is_upd).alias("is_current"))
    new_rows = c.filter(F.col(CHANGE).isin(INSERT, UPDATE) & ~F.coalesce(late, F.lit(False))).select(
        key, *[new_col(x).alias(x) for x in cols],
        as_of_c.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"))
    out_cols = [key] + cols + ["valid_from", "valid_to", "is_current"]
    return (history.select(*out_cols).unionByName(old_rows.select(*out_cols))
            .unionByName(new_rows.select(*out_cols)))


def scd2_merge(versions: DataFrame, delivery: DataFrame, key: str, tracked: list[str], as_of,
               seen: DataFrame | None = None) -> DataFrame:
    """All versions of the keys whose history the delivery of ``as_of`` changes.

    The delivery may be older than versions that are there.  A version lasts
    until the next delivery that holds the key shows something else, so with the
    days on which each key was delivered (``seen``: key, as_of) any order of
    deliveries gives one history.  At ``as_of`` a version begins, replaces one
    that begins there, or joins an equal one before or behind; where it falls
    inside a version, that one goes on from the key's next delivery.  Without
    ``seen`` the next delivery is taken to be the next version's first.

    ``versions``: key, tracked columns, valid_from.  Result: key, tracked columns,
    valid_from, valid_to, is_current.
    """
    cols, t = [c for c in tracked if c != key], F.lit(str(as_of)).cast("date")
    begun = F.col("valid_from")
    was = versions.select(key, "valid_from", F.struct(*cols).alias("was"))
    now = delivery.select(key, F.struct(*cols).alias("now"))
    row = F.struct("valid_from", "was")
    around = was.join(now.select(key), key, "left_semi").groupBy(key).agg(
        F.max(F.when(begun <= t, row)).alias("cur"), F.max(F.when(begun < t, row)).alias("prev"),
        F.min(F.when(begun > t, row)).alias("nxt"))
    at = now.join(around, key, "left").filter(F.col("cur").isNull() | ~F.col("cur.was").eqNullSafe(F.col("now")))
    if seen is not None:  # no folder of a later day: nothing is read
        later = seen.filter(F.col("as_of") > t).groupBy(key).agg(F.min("as_of").alias("next_seen"))
        at = at.join(later, key, "left")
    else:
        at = at.withColumn("next_seen", F.lit(None).cast("date"))
    after = F.least("next_seen", "nxt.valid_from")
    none = F.lit(None).cast(was.schema["was"].dataType)
    starts = F.array(
        F.when(F.col("prev").isNull() | ~F.col("prev.was").eqNullSafe(F.col("now")),
               F.struct(t.alias("valid_from"), F.col("now").alias("was"))),
        F.when(after.isNotNull() & (F.col("nxt").isNull() | (F.col("nxt.valid_from") > after)),
               F.struct(after.alias("valid_from"), F.coalesce(F.col("cur.was"), none).alias("was"))))
    fresh = at.select(key, F.explode(starts).alias("s")).filter(F.col("s").isNotNull()).select(key, "s.*")
    joins = at.select(key, F.when(F.col("nxt.was").eqNullSafe(F.col("now")) & (F.col("nxt.valid_from") == after),
                                  F.col("nxt.valid_from")).alias("joined"))
    stay = was.join(joins, key).filter((begun != t) & ~begun.eqNullSafe(F.col("joined"))).drop("joined")
    w = Window.partitionBy(key).orderBy("valid_from")  # the versions of one key
    until = F.lead("valid_from").over(w)
    return stay.unionByName(fresh).select(
        key, *[F.col("was").getField(c).alias(c) for c in cols], "valid_from",
        F.date_sub(until, 1).alias("valid_to"), until.isNull().alias("is_current"))
