"""Lookup joins: normalised code-table joins, band (range) joins, as-of lookups.

Each has one path for inputs of every size.  Nothing is broadcast by hand: the
static size of a code table, or what adaptive execution measures at run time,
decides, and the rows never depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendstar.functions.text import norm_key


def join_normalised(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
                    how: str = "inner") -> DataFrame:
    """Equi-join on upper(trim(key)) of both sides.

    The right (code-table) key is normalised once in its own projection and
    dropped after the join; ``left_col`` is expected to be normalised already
    (staging does it), otherwise it is normalised here too.
    """
    rkey = f"__k_{right_col}"
    r = right.select(norm_key(right_col).alias(rkey),
                     *[c for c in right.columns if c != right_col])
    joined = left.join(r, norm_key(left[left_col]) == r[rkey], how)
    return joined.drop(rkey)


_HALF = 1 << 61  # cells are clamped to +-2^61, so that 63 levels cover the line


def _cell(value: Column, cell: float) -> Column:
    """Number of the cell that holds a value, from 0.  It never falls as values
    rise, also where a double can't hold them all; NULL stays NULL."""
    low, high = F.lit(-float(_HALF)), F.lit(float(_HALF))
    x = F.greatest(F.least(value.cast("double") / F.lit(float(cell)), high), low)  # NaN is above all numbers
    return F.when(value.isNotNull(), F.floor(x).cast("long") + F.lit(_HALF))


def _cover(bands: DataFrame, lo: str, hi: str, cell: float) -> DataFrame:
    """``bands`` with (level, cell) of the dyadic cells that make up each band,
    at most two on a level."""
    b = bands.withColumn("__a", _cell(F.col(lo), cell)).withColumn("__z", _cell(F.col(hi), cell) + 1)
    cells = F.expr("""flatten(transform(sequence(0, 62), k -> transform(
        filter(array(struct(shiftright(__a - 1, k) + 1 AS at, shiftright(__a - 1, k) + 1 AS l, shiftright(__z, k) AS r, true AS first),
                     struct(shiftright(__z, k) - 1 AS at, shiftright(__a - 1, k) + 1 AS l, shiftright(__z, k) AS r, false AS first)),
               c -> c.l < c.r AND CASE WHEN c.first THEN c.l % 2 = 1 ELSE c.r % 2 = 1 END),
        c -> struct(k AS level, c.at AS cell))))""")
    met = b.filter(F.col("__a").isNotNull() & F.col("__z").isNotNull() & (F.col("__a") < F.col("__z")))
    return met.withColumn("__c", F.explode(cells)).select(
        *bands.columns, F.col("__c.level").alias("__band_level"), F.col("__c.cell").alias("__band_cell"))


def band_join(left: DataFrame, value: Column, bands: DataFrame, lo: str, hi: str,
              how: str = "inner", value_name: str = "__band_value", cell: float = 1) -> DataFrame:
    """Join each left row to every band with ``lo <= value <= hi`` (inclusive).

    NULL values and NULL bounds match nothing; overlapping bands multiply rows,
    as a SQL BETWEEN join does.  Values and bounds may be of any numeric type.
    Columns: those of ``left``, ``value_name``, those of ``bands``.

    The number line is cut into cells of width ``cell``, and pairs of cells into
    cells of the next level, and so on.  A band is the union of at most two cells
    a level, whatever its width, and a value lies in one cell of each level, so
    it meets a band in one cell at most: an equi-join on (level, cell) with the
    exact condition on top.  Values look up only the levels that some band uses
    (a scalar of the bands; the left side is read once).  A left join resolves the
    distinct values and joins them back.
    """
    lhs = left.withColumn(value_name, value)
    cells = _cover(bands, lo, hi, cell)
    levels = cells.agg(F.collect_set("__band_level")).scalar()  # 63 numbers at most

    def met(rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn("__v", _cell(F.col(value_name), cell)).filter(F.col("__v").isNotNull())
        keyed = keyed.withColumn("__level", F.explode(levels)).withColumn("__cell", F.expr("shiftright(__v, __level)"))
        inside = ((keyed["__level"] == cells["__band_level"]) & (keyed["__cell"] == cells["__band_cell"])
                  & (keyed[value_name] >= cells[lo]) & (keyed[value_name] <= cells[hi]))
        return keyed.join(cells, inside).drop("__v", "__level", "__cell", "__band_level", "__band_cell")

    if how == "inner":
        return met(lhs)
    if how != "left":
        raise ValueError(f"inner or left, not {how}")
    found = met(lhs.select(F.col(value_name).alias("__value")).distinct().withColumn(value_name, F.col("__value")))
    found = found.drop(value_name)
    return lhs.join(found, F.col(value_name) == F.col("__value"), "left").drop("__value")


def asof_single(rates: DataFrame, date_col: str, value_col: str, at) -> DataFrame:
    """Latest ``value_col`` with ``date_col <= at`` as a one-row frame.

    Ties on the date resolve to the larger value (deterministic).  Returns no
    row when nothing qualifies.  Computed as one global aggregate (partial
    aggregation on every partition), never as a sorted single-partition window.
    """
    at_c = at if isinstance(at, Column) else F.lit(at).cast("date")
    best = (
        rates.filter(F.col(date_col) <= at_c)
        .agg(F.max(F.struct(F.col(date_col).alias("d"), F.col(value_col).alias("v"))).alias("b"))
    )
    return (best.select(F.col("b.d").alias(date_col), F.col("b.v").alias(value_col))
            .filter(F.col(date_col).isNotNull()))


def asof_lookup(left: DataFrame, left_date: str, rates: DataFrame, rate_date: str,
                rate_value: str) -> DataFrame:
    """For each left row, the latest rate with ``rate_date <= left_date``.

    Columns: those of ``left``, ``rate_date``, ``rate_value``.  Rows with no
    date or no earlier rate get NULLs; rates with a NULL date are never used;
    of several rates of one date the larger value wins.

    The left side is touched twice: a distinct projection of its dates
    (partially aggregated) and one equi-join back on the date.  The resolution
    itself runs on the union of distinct dates and rate dates, whose size is
    bounded by the days of the calendar span, not by the row count; the join's
    left side can be split when one date holds most of the rows.
    """
    dates = left.select(F.col(left_date).alias("__d")).distinct().filter(F.col("__d").isNotNull())
    points = rates.filter(F.col(rate_date).isNotNull()).groupBy(F.col(rate_date).alias("__d")).agg(
        F.max(F.struct(F.col(rate_date).alias("d"), F.col(rate_value).alias("v"))).alias("__r"))
    both = dates.select("__d", F.lit(None).cast(points.schema["__r"].dataType).alias("__r")).unionByName(points)
    # A global ordered window: its input is bounded by the number of distinct
    # dates (days in the calendar span), never by the fact row count.
    w = Window.orderBy("__d").rowsBetween(Window.unboundedPreceding, 0)
    resolved = (both.groupBy("__d").agg(F.max("__r").alias("__r"))
                .withColumn("__r", F.last("__r", ignorenulls=True).over(w))
                .select(F.col("__d"), F.col("__r.d").alias(rate_date), F.col("__r.v").alias(rate_value)))
    return left.join(resolved, left[left_date] == resolved["__d"], "left").drop("__d")
