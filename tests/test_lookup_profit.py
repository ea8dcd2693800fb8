"""Lookup joins and the monthly profit estimate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendstar.operators import lookup, profit


def test_band_join_inclusive_overlapping_and_null(spark):
    left = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, 9), (5, None)], "id int, v int")
    bands = spark.createDataFrame([(0, 1, 0.15), (1, 3, 0.1)], "lo int, hi int, r double")
    got = sorted((r.id, r.r) for r in lookup.band_join(left, F.col("v"), bands, "lo", "hi").collect())
    # 1 sits in both bands (rows multiply like SQL BETWEEN); NULL and 9 match nothing.
    assert got == [(1, 0.15), (2, 0.1), (2, 0.15), (3, 0.1)]


@pytest.mark.parametrize("cell", [1, 0.5, 10])
def test_band_join_equals_between(spark, cell):
    left = spark.createDataFrame([(i, i % 13 + 0.25) for i in range(100)] + [(999, None)], "id int, v double")
    bands = spark.sql("SELECT * FROM VALUES (0.00BD, 4.25BD, 1.0D), (3.00BD, 8.50BD, 2.0D), (9.00BD, 2000000000.00BD, 3.0D), "
                      "(NULL, 5.00BD, 4.0D), (2.00BD, NULL, 5.0D), (7.00BD, 3.00BD, 6.0D), (-9.00BD, -1.00BD, 7.0D) AS t(lo, hi, r)")
    left.createOrReplaceTempView("l")
    bands.createOrReplaceTempView("b")
    for how in ("inner", "left"):
        got = lookup.band_join(left, F.col("v"), bands, "lo", "hi", how=how, cell=cell)
        assert got.columns == ["id", "v", "__band_value", "lo", "hi", "r"]
        want = spark.sql(f"SELECT l.id, b.r FROM l {how} JOIN b ON l.v BETWEEN b.lo AND b.hi")
        got = got.select("id", "r")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert lookup.band_join(left.limit(0), F.col("v"), bands, "lo", "hi").isEmpty()


def test_asof_single_and_fallback(spark):
    rates = spark.createDataFrame([(dt.date(2025, 5, 1), 3.25), (dt.date(2025, 7, 1), 3.0)],
                                  "EffectiveDate date, BaseInterestRate double")
    r = profit.rate_at(rates, "2025-06-15").collect()
    assert [(x.EffectiveDate, x.BaseInterestRate, x.is_fallback) for x in r] == [
        (dt.date(2025, 5, 1), 3.25, True)]
    assert profit.rate_at(rates, "2025-04-01").isEmpty()


def test_asof_lookup_many_dates(spark):
    rates = spark.createDataFrame([(dt.date(2025, 3, 1), 1.0), (dt.date(2025, 5, 1), 2.0)],
                                  "EffectiveDate date, BaseInterestRate double")
    left = spark.createDataFrame([(1, dt.date(2025, 2, 1)), (2, dt.date(2025, 3, 1)),
                                  (3, dt.date(2025, 4, 30)), (4, dt.date(2025, 6, 1))], "id int, d date")
    got = sorted((r.id, r.BaseInterestRate) for r in
                 lookup.asof_lookup(left, "d", rates, "EffectiveDate", "BaseInterestRate").collect())
    assert got == [(1, None), (2, 1.0), (3, 1.0), (4, 2.0)]


def _profit_inputs(spark):
    cars = spark.createDataFrame([
        (1, " Volvo ", " electric", 2024, 100000.0, " low", dt.date(2025, 6, 1)),
        (2, "Saab", "diesel", 2010, 50000.0, "HIGH ", dt.date(2025, 6, 1)),     # year -> NULL
        (3, "Kia", "hydrogen", 2024, 30000.0, "low", dt.date(2025, 6, 1)),       # no margin
        (4, "Audi", "hybrid", 2023, -1.0, "low", dt.date(2025, 6, 1)),           # bad price
        (None, "X", "hybrid", 2023, 10.0, "low", dt.date(2025, 6, 1)),           # no id
    ], "RecordID int, CarModel string, EnergyClass string, ManufactureYear int, BasePrice double, "
       "CustomerRiskTier string, FileMonth date")
    rates = spark.createDataFrame([(dt.date(2025, 5, 1), 3.25)], "EffectiveDate date, BaseInterestRate double")
    margins = spark.createDataFrame([("Electric ", 1.25), (" Diesel", 2.75), ("hybrid", 1.75)],
                                    "EnergyClass string, MarginRate double")
    tiers = spark.createDataFrame([("LOW", 0.5), ("High", 3.0)], "RiskTier string, RiskAdjustment double")
    bands = spark.createDataFrame([(0, 1, 0.15), (2, 4, 0.1)], "MinYear int, MaxYear int, DepreciationRate double")
    return cars, rates, margins, tiers, bands


def test_profit_estimates(spark):
    cars, rates, margins, tiers, bands = _profit_inputs(spark)
    staged = profit.stage_cars(cars, "2025-06-15").collect()
    assert sorted(r.RecordID for r in staged) == [1, 2, 3]
    out = profit.estimate_profits(cars, rates, margins, tiers, bands, "2025-06-15").collect()
    assert len(out) == 1
    r = out[0]
    assert r.RecordID == 1 and r.CarModel == "Volvo" and r.EnergyClass == "ELECTRIC"
    assert r.FinalInterestRate == pytest.approx(3.25 + 1.25 + 0.5)
    assert r.EstimatedMonthlyPayment == pytest.approx(100000 * 5.0 / 100 / 12)
    assert r.DepreciatedValue == pytest.approx(100000 * 0.85)
    assert r.EstimatedProfit == pytest.approx(100000 * 5.0 / 100 - 100000 * 0.15)


def test_profit_without_any_rate_gives_no_rows(spark):
    cars, rates, margins, tiers, bands = _profit_inputs(spark)
    none = rates.filter(F.lit(False))
    assert profit.estimate_profits(cars, none, margins, tiers, bands, "2025-06-15").isEmpty()


def test_asof_lookup_equals_correlated_subquery(spark):
    rates = spark.sql("SELECT * FROM VALUES (DATE'2025-03-01', 1.0D), (DATE'2025-05-01', 2.0D), "
                      "(DATE'2025-05-01', 2.5D), (CAST(NULL AS DATE), 9.9D) AS t(EffectiveDate, BaseInterestRate)")
    left = spark.sql("SELECT id, date_add(DATE'2025-02-20', CAST(id AS INT)) AS d FROM range(120)") \
        .unionByName(spark.sql("SELECT 999L AS id, CAST(NULL AS DATE) AS d"))
    got = lookup.asof_lookup(left, "d", rates, "EffectiveDate", "BaseInterestRate")
    assert got.columns == ["id", "d", "EffectiveDate", "BaseInterestRate"]
    pts = [(r.EffectiveDate, r.BaseInterestRate) for r in rates.collect() if r.EffectiveDate]
    for r in got.collect():
        best = max((p for p in pts if r.d and p[0] <= r.d), default=(None, None))
        assert (r.EffectiveDate, r.BaseInterestRate) == best
    assert got.count() == 121


def test_band_join_of_any_width_equals_between(spark):
    """Bands over billions of cells, decimal and overlapping ones, NULL and reversed bounds, huge values."""
    bands = spark.sql("""SELECT * FROM VALUES (0D, 3e9D, 1), (2.5D, 2.5D, 2), (-1e300D, 1e300D, 3), (NULL, 5D, 4), (5D, NULL, 5),
        (9D, 1D, 6), (7D, 1e9D, 7), (-5D, -1.5D, 8), (9007199254740993D, 9007199254740995D, 9), (-7D, 4e18D, 10) AS t(lo, hi, r)""")
    values = [0.0, 3e9, 3e9 + 1, 2.5, 2.4999, -2.0, -1.5, -1.4, 1e9, 1e9 + 0.5, 1e301, -1e301, float("nan"), float("inf"), None,
              9007199254740994.0, 9007199254740992.0, 4e18, 5e18, 6.999, 7.0] + [i * 0.37 - 3 for i in range(40)]
    left = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    left.createOrReplaceTempView("band_left")
    bands.createOrReplaceTempView("band_right")
    for how in ("inner", "left"):
        want = spark.sql(f"SELECT id, r FROM band_left {how} JOIN band_right ON v BETWEEN lo AND hi")
        for cell in (1, 0.25, 1000):
            got = lookup.band_join(left, F.col("v"), bands, "lo", "hi", how=how, cell=cell).select("id", "r")
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    cover = lookup._cover(bands, "lo", "hi", 1).groupBy("r").count().collect()
    assert max(r["count"] for r in cover) <= 2 * 62
