"""Keyed upsert into a bucketed table: only buckets with changes are written.

Every row carries a digest of its compared columns.  Key, digest and order column
of a delivery are joined with those of the buckets that its keys fall into (no
other column moves, no other bucket is read).  What differs is stored; its buckets
are read once more in full, merged and written as the next version, which lists
all other buckets where they are.  Whole rows move once, dealt to their buckets;
identities come to them there.  The work follows the delivery and the changed
buckets, not the table.

Large tables go bucket group by bucket group (``passes``), both in the comparison
and in the write, so that shuffle files never hold all rows at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendstar.functions.audit import audit_values
from lendstar.operators.keys import assign_dense_identity, max_identity
from lendstar.session import stored
from lendstar.sources.versioned import (BUCKET, DEALT, FEWER, Buckets, bucket_listing, bucket_of, dealt, in_pass, passes,
                                        publish_buckets, read_buckets, read_current, remove_failed)
from lendstar.specs import AUDIT_COLS

BUCKETS = 16  # of a table that doesn't say; size it for a few hundred MB to a few GB a bucket
DIGEST = "__digest"


def row_digest(df: DataFrame, cols: list[str]) -> Column:
    """128 bits of the columns' values; NULL differs from every value, and a value
    is told from its neighbours by its length."""
    parts = []
    for c in cols:
        kind = df.schema[c].dataType.typeName()
        v = F.col(c)
        if kind in ("float", "double"):
            v = v + F.lit(0.0)  # -0.0 and 0.0 are one value
        elif kind in ("timestamp", "timestamp_ntz"):
            v = F.unix_micros(v.cast("timestamp"))
        elif kind in ("array", "map", "struct"):
            v = F.to_json(v)
        parts.append(F.hex(v) if kind == "binary" else v.cast("string"))
    # one expression for all texts: with one for each, a wide table's code is too long to be compiled
    marked = F.transform(F.array(*parts), lambda t: F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")))
    return F.unhex(F.md5(F.array_join(marked, "") if parts else F.lit("")))


def touched(df: DataFrame, key: str, count: int) -> list[int]:
    """Numbers of the buckets that the keys fall into, ``count`` at most."""
    return sorted(r[0] for r in df.select(bucket_of(key, count)).distinct().collect())


def upsert_buckets(new: DataFrame, base: str, key: str, identity_col: str, cols: list[str],
                   order_col: str | None = None, run_ts=None, count: int = BUCKETS, unique: bool | None = None,
                   latest: Callable[[DataFrame, list[str]], DataFrame] | None = None,
                   read: Callable[[], None] | None = None) -> dict:
    """Merge ``new`` (unique by ``key``, stored) into the table at ``base``.
    ``unique`` says that no key is repeated or NULL; it's found out if not given.
    With ``latest`` keys may be repeated: it keeps a row of each key, of rows that
    are shuffled by the columns it is given.  ``read`` is called when changes are
    stored and ``new`` isn't read again.

    Known keys keep identity and CreatedDate, new ones get identities after the
    largest; a row older by ``order_col`` doesn't replace its key's; keys that
    aren't delivered stay.  ``run_ts`` adds the audit columns.  An unchanged
    delivery publishes nothing.  Returns message, rows and written buckets.
    """
    spark, cols = new.sparkSession, [c for c in cols if c != key]
    new = new.select(key, *cols)
    audit = AUDIT_COLS if run_ts is not None else []
    made = list(audit_values(run_ts)) if audit else []
    layout = [identity_col, key, *cols, *audit]
    digest = row_digest(new, cols).alias(DIGEST)
    listing = bucket_listing(spark, base)
    if unique is None:
        odd = (F.col("__n") > 1) | F.col(key).isNull()
        unique = new.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(odd).isEmpty()
    if listing is None:
        current = read_current(spark, base)
        if current is not None:  # a table of an earlier layout: cut into buckets once
            whole = current.select(*layout)
            listing = publish_buckets(whole.select("*", row_digest(whole, cols).alias(DIGEST)), base, key, count)
        else:
            if unique:
                names = new.select(key).distinct() if latest else new.select(key)
                ids = assign_dense_identity(names, key, "__identity")

                def first(group: list[int]) -> DataFrame:
                    rows, keys = (in_pass(df, key, count, group, groups) for df in (new, ids))
                    rows = dealt(rows.unionByName(keys, allowMissingColumns=True), key, count)  # a row of each key's identity
                    rows = (rows.withColumn(identity_col, F.max("__identity").over(Window.partitionBy(*DEALT, key)))
                            .filter(F.col("__identity").isNull()).drop("__identity"))
                    rows = latest(rows, DEALT) if latest else rows
                    return rows.select("*", *made).select(*layout, digest, BUCKET)
            else:
                whole = assign_dense_identity(new, key, identity_col).select("*", *made).select(*layout, digest)

                def first(group: list[int]) -> DataFrame:
                    return in_pass(whole, key, count, group, groups)
            groups = passes([*range(count)], count, new, most=FEWER)
            n, listing = _counted([first(g) for g in groups], base, key, count)
            return {"message": "first load", "row_count": n, "buckets": len(listing.paths)}
    count = listing.count
    narrow = unique and not latest
    groups = passes(touched(new, key, count), count, new, most=FEWER)

    def differing(group: list[int]) -> DataFrame:
        was = read_buckets(spark, base, listing, group).select(
            key, F.col(DIGEST).alias("__was"), F.col(identity_col).alias("__identity"),
            *([F.col("CreatedDate").alias("__created")] if audit else []),
            *([F.col(order_col).alias("__order")] if order_col else []))
        rows = in_pass(new, key, count, group, groups)
        compared = (rows.select(key, digest, *([order_col] if order_col and order_col != key else [])) if narrow
                    else (latest(rows, []) if latest else rows).select("*", digest))
        c = compared.join(was, key, "left").filter(~F.col(DIGEST).eqNullSafe(F.col("__was")))
        if order_col:
            late = F.col("__order").isNotNull() & (F.col(order_col).isNull() | (F.col(order_col) < F.col("__order")))
            c = c.filter(F.col("__was").isNull() | ~late)
        return c

    def stored_parts(part: Callable[[list[int]], DataFrame], name: str) -> DataFrame:
        first, *more = [part(g) for g in groups]
        return stored(first, name, more)

    c = stored_parts(differing, "changes")
    if narrow:
        names = c.drop(*cols)
        c = stored_parts(lambda g: in_pass(new, key, count, g, groups).join(in_pass(names, key, count, g, groups), key),
                         "changed rows")
    changed = touched(c, key, count)
    if not changed:
        return {"message": "no changes", "row_count": 0, "buckets": 0}
    if read:
        read()
    known = c.filter(F.col("__was").isNotNull())
    updated = known.select(F.col("__identity").alias(identity_col), key, *cols, DIGEST,
                           *([F.col("__created").alias("CreatedDate"), *made[1:]] if audit else []))
    top = max_identity(read_buckets(spark, base, listing), identity_col)
    fresh = assign_dense_identity(c.filter(F.col("__was").isNull()).select(key, *cols, DIGEST), key, identity_col, base=top)
    fresh = fresh.select("*", *made)
    out = [*layout, DIGEST]
    now = updated.select(*out).unionByName(fresh.select(*out)).withColumn("__new", F.lit(True))
    groups = passes(changed, count, read_buckets(spark, base, listing, changed))
    one_key = Window.partitionBy(*DEALT, key)  # its row as it was and as it is

    def merged(group: list[int]) -> DataFrame:
        was = read_buckets(spark, base, listing, group).select(*out, F.lit(False).alias("__new"))
        rows = dealt(was.unionByName(in_pass(now, key, count, group, groups)), key, count)
        return (rows.withColumn("__replaced", F.max("__new").over(one_key))
                .filter(F.col(key).isNull() | (F.col("__new") == F.col("__replaced"))).select(*out, BUCKET))

    _counted([merged(g) for g in groups], base, key, count, listing, changed)
    return {"message": "changes merged", "row_count": c.count(), "buckets": len(changed)}


def _counted(parts: list[DataFrame], base: str, key: str, count: int, keep: Buckets | None = None,
             buckets: list[int] | None = None) -> tuple[int, Buckets]:
    """Publish; the rows that the writes counted, and the new listing."""
    seen = [Observation() for _ in parts]
    first, *more = [df.observe(obs, F.count(F.lit(1)).alias("rows")) for df, obs in zip(parts, seen)]
    out = publish_buckets(first, base, key, count, keep, buckets, more=more)
    remove_failed(first.sparkSession, base)
    return sum(int(obs.get["rows"]) for obs in seen), out
