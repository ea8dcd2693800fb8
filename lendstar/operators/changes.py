"""Change detection between a new delivery and the current snapshot.

One full-outer join on the business key (both sides are deduplicated, so the
key is unique per side and the join cannot fan out or skew on a hot key)
classifies every key in a single pass:

* ``insert``  - key only in the new delivery
* ``update``  - key in both, some business column differs (NULL-safe)
* ``same``    - key in both, all business columns equal (NULL-safe)
* ``stale``   - key in both, the delivered row is older by ``order_col``: a late
  delivery, the snapshot's row stays.  With equal order the delivered row is a
  correction and counts as an update (or same).
* ``missing`` - key only in the snapshot (kept; deliveries never delete)

Each side's compared columns travel as one struct, and the two structs are
compared with ``<=>`` (field by field, NULL equals NULL).  Keeping the
comparison on two attributes instead of 2 x n columns matters for planning:
a filter over n per-column comparisons followed by a projection that renames
the n columns makes Catalyst's constraint propagation grow as 2^n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "change"
INSERT, UPDATE, SAME, MISSING, STALE = "insert", "update", "same", "missing", "stale"

NEW, OLD = "__new", "__old"          # compared columns of each side
NEW_X, OLD_X = "__new_x", "__old_x"  # carried (not compared) columns of each side


def new_col(c: str) -> Column:
    return F.col(NEW).getField(c)


def old_col(c: str) -> Column:
    return F.col(OLD).getField(c)


def new_extra(c: str) -> Column:
    return F.col(NEW_X).getField(c)


def old_extra(c: str) -> Column:
    return F.col(OLD_X).getField(c)


def _side(df: DataFrame, key: str, cols: list[str], extra: list[str], cmp_name: str,
          extra_name: str) -> DataFrame:
    # A table of keys alone (a code without attributes) compares a constant.
    compared = [F.col(c) for c in cols] or [F.lit(True).alias("present")]
    sel = [F.col(key), F.struct(*compared).alias(cmp_name)]
    if extra:
        sel.append(F.struct(*[F.col(c) for c in extra]).alias(extra_name))
    return df.select(*sel)


def classify(new: DataFrame, old: DataFrame, key: str, compare_cols: list[str],
             new_extra: list[str] | None = None, old_extra: list[str] | None = None,
             order_col: str | None = None) -> DataFrame:
    """Full-outer join of new and old on ``key`` with a ``change`` column.

    Output: ``key``, ``change``, the compared-column structs ``__new`` /
    ``__old`` and, when requested, the carried-column structs ``__new_x`` /
    ``__old_x``.  Read fields with ``new_col`` / ``old_col`` / ``new_extra`` /
    ``old_extra``.
    """
    cols = [c for c in compare_cols if c != key]
    n_extra = [c for c in (new_extra or []) if c not in cols and c != key]
    o_extra = [c for c in (old_extra or []) if c not in cols and c != key]
    n = _side(new, key, cols, n_extra, NEW, NEW_X)
    o = _side(old, key, cols, o_extra, OLD, OLD_X)
    j = n.join(o, key, "full_outer")
    change = (F.when(F.col(OLD).isNull(), F.lit(INSERT))
              .when(F.col(NEW).isNull(), F.lit(MISSING))
              .when(F.col(NEW).eqNullSafe(F.col(OLD)), F.lit(SAME)))
    if order_col:
        was, now = old_col(order_col), new_col(order_col)
        change = change.when(was.isNotNull() & (now.isNull() | (now < was)), F.lit(STALE))
    change = change.otherwise(F.lit(UPDATE))
    out = [F.col(key), change.alias(CHANGE), F.col(NEW), F.col(OLD)]
    if n_extra:
        out.append(F.col(NEW_X))
    if o_extra:
        out.append(F.col(OLD_X))
    return j.select(*out)


def change_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy(CHANGE).agg(F.count(F.lit(1)).alias("n"))


def new_keys(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Keys of ``new`` absent from ``old`` (one anti join, no distinct/except)."""
    return new.select(key).distinct().join(old.select(key), key, "left_anti")


def changed_rows_except_all(new: DataFrame, old: DataFrame, cols: list[str]) -> DataFrame:
    """Bag difference of business rows (NULL-safe: NULLs compare equal)."""
    return new.select(*cols).exceptAll(old.select(*cols))


def side(classified: DataFrame, key: str, cols: list[str], accessor, changes) -> DataFrame:
    """Rows of one side for the given change kinds, with original column names."""
    return (classified.filter(F.col(CHANGE).isin(*changes))
            .select(key, *[accessor(c).alias(c) for c in cols if c != key]))
