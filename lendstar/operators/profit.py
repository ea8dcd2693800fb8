"""Monthly auto-loan profit estimates.

``stage_cars`` validates the monthly vehicle delivery; ``estimate_profits``
attaches the base rate valid at the run date (falling back to the latest
earlier month), the energy-class margin, the customer risk adjustment and the
depreciation band, then computes the estimates.  One lazy plan: the staged cars
are joined to the lookups as Spark plans them; the rate is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendstar.functions.text import norm_key
from lendstar.operators.lookup import asof_single, band_join, join_normalised

# Fixed validation bound: vehicles built before this year get no year.
MIN_MANUFACTURE_YEAR = 2015

STAGED_COLUMNS = ["RecordID", "CarModel", "EnergyClass", "ManufactureYear", "BasePrice",
                  "CustomerRiskTier", "FileMonth"]
OUTPUT_COLUMNS = ["RecordID", "CarModel", "EnergyClass", "ManufactureYear", "BasePrice",
                  "CustomerRiskTier", "FinalInterestRate", "EstimatedMonthlyPayment",
                  "DepreciatedValue", "EstimatedProfit", "FileMonth"]


def _date(d):
    return d if not isinstance(d, str) else F.lit(d).cast("date")


def stage_cars(cars: DataFrame, run_date) -> DataFrame:
    """Required fields present and price positive; codes trimmed/upper-cased;
    manufacture years outside [2015, year(run_date)] become NULL."""
    run_year = F.year(_date(run_date))
    year = F.col("ManufactureYear")
    price = F.col("BasePrice")
    return (
        cars.filter(
            F.col("RecordID").isNotNull() & F.col("CarModel").isNotNull()
            & F.col("EnergyClass").isNotNull() & (price > 0)
            & F.col("CustomerRiskTier").isNotNull())
        .select(
            "RecordID",
            F.trim("CarModel").alias("CarModel"),
            norm_key("EnergyClass").alias("EnergyClass"),
            F.when((year < MIN_MANUFACTURE_YEAR) | (year > run_year), F.lit(None))
             .otherwise(year).cast("int").alias("ManufactureYear"),
            F.when(price <= 0, F.lit(None)).otherwise(price).alias("BasePrice"),
            norm_key("CustomerRiskTier").alias("CustomerRiskTier"),
            "FileMonth",
        )
    )


def rate_at(rates: DataFrame, run_date) -> DataFrame:
    """One row: EffectiveDate, BaseInterestRate, is_fallback (rate not from the run month)."""
    r = asof_single(rates, "EffectiveDate", "BaseInterestRate", _date(run_date))
    fmt = "yyyyMM"
    return r.withColumn(
        "is_fallback",
        F.date_format("EffectiveDate", fmt) != F.date_format(_date(run_date), fmt))


def attach_margins(staged: DataFrame, margins: DataFrame, tiers: DataFrame) -> DataFrame:
    m = join_normalised(staged, margins, "EnergyClass", "EnergyClass")
    return join_normalised(m, tiers, "CustomerRiskTier", "RiskTier")


def attach_depreciation(staged: DataFrame, bands: DataFrame) -> DataFrame:
    age = F.year("FileMonth") - F.col("ManufactureYear")
    return band_join(staged, age, bands, "MinYear", "MaxYear", value_name="age")


def estimate_profits(cars: DataFrame, rates: DataFrame, margins: DataFrame, tiers: DataFrame,
                     bands: DataFrame, run_date, staged: bool = False) -> DataFrame:
    c = cars if staged else stage_cars(cars, run_date)
    # The run's base rate is a one-row aggregate: a scalar subquery, evaluated
    # once.  No qualifying rate -> no estimates (the run stops).
    base_rate = rate_at(rates, run_date).select("BaseInterestRate").scalar()
    j = attach_depreciation(attach_margins(c, margins, tiers), bands)
    j = j.withColumn("BaseInterestRate", base_rate).filter(F.col("BaseInterestRate").isNotNull())
    final_rate = F.col("BaseInterestRate") + F.col("MarginRate") + F.col("RiskAdjustment")
    price = F.col("BasePrice")
    yearly_interest = price * final_rate / 100
    depreciated = price * (1 - F.col("DepreciationRate"))
    return j.select(
        "RecordID", "CarModel", "EnergyClass", "ManufactureYear", "BasePrice", "CustomerRiskTier",
        final_rate.alias("FinalInterestRate"),
        (yearly_interest / 12).alias("EstimatedMonthlyPayment"),
        depreciated.alias("DepreciatedValue"),
        (yearly_interest - (price - depreciated)).alias("EstimatedProfit"),
        "FileMonth",
    )
