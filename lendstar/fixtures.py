"""Lending-shaped input tables derived from the driver's TPC-H-like parquet.

The reference ships no data; FIXTURES.md defines the raw loan deliveries and
the profit-estimate inputs as SQL over the driver tables.  Each template below
is written once with ``{name}`` placeholders: Spark fills them with DataFrames
(``spark.sql(text, name=df)``), the DuckDB oracle fills them with view names.
These are test inputs, not library operators.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lendstar.specs import ACCOUNT_SCHEMA, BALANCE_SCHEMA, TRANSACTION_SCHEMA

# Fixed run parameters of the fixtures (FIXTURES.md section 2).
RUN_DATE = "2025-06-15"
DAY1_DATE = "2025-06-01"
DAY1_TS = "2025-06-01 08:00:00"
DAY2_TS = "2025-06-15 08:00:00"
CALENDAR_START, CALENDAR_END = "2017-01-01", "2025-12-31"

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

TEMPLATES: dict[str, str] = {}

TEMPLATES["raw_loan_account"] = """
SELECT CAST(c.c_custkey AS BIGINT) AS LoanAccountId, 8 AS SourceId, c.c_name AS AccountNumber,
  CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE concat('SE', CAST(1000000 + c.c_custkey AS STRING)) END AS IBAN,
  CAST(NULL AS STRING) AS BBAN,
  CAST(CASE WHEN c.c_nationkey % 2 = 0 THEN 49 ELSE 50 END AS INT) AS AccountCurrencyId,
  CASE WHEN c.c_nationkey % 2 = 0 THEN 'SEK' ELSE 'EUR' END AS AccountCurrency,
  CAST(r.r_regionkey AS INT) AS OrganizationId, r.r_name AS OrganizationName,
  CAST(CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE c.c_custkey % 7 END AS INT) AS ChannelID,
  CAST(c.c_nationkey AS INT) AS BrokerId,
  CAST((2018 + c.c_custkey % 7 - c.v) * 10000 + (1 + c.c_custkey % 12) * 100 + 1 + c.c_custkey % 28 AS INT) AS OpenDateId,
  make_date(CAST(2018 + c.c_custkey % 7 - c.v AS INT), CAST(1 + c.c_custkey % 12 AS INT), CAST(1 + c.c_custkey % 28 AS INT)) AS OpenDate,
  CAST(CASE WHEN c.c_custkey % 5 = 0 THEN 20250131 ELSE -1 END AS INT) AS CancelledDateId,
  CASE WHEN c.c_custkey % 5 = 0 THEN make_date(2025, 1, 31) ELSE NULL END AS CancelledDate,
  make_date(CAST(2018 + c.c_custkey % 7 AS INT), CAST(1 + c.c_custkey % 12 AS INT), 28) AS ValueDate,
  CAST(NULL AS DATE) AS MaturityDate,
  CAST(CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
       WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS INT) AS ProductId,
  c.c_mktsegment AS Product, 14 AS InvoiceDay,
  CASE WHEN c.c_custkey % 11 = 0 THEN 'NULL' WHEN c.c_custkey % 13 = 0 THEN ''
       WHEN c.c_custkey % 101 = 0 THEN '1.234,56'
       ELSE concat(' ', replace(CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) AS STRING), '.', ','), ' ') END AS CurrentInstallmentAmount,
  '29,50' AS CurrentInvoiceFee, CAST(NULL AS STRING) AS RepaymentRate,
  make_date(2025, 7, 14) AS NextInvoiceDate, CAST(NULL AS DATE) AS CalculatedMaturityDate
FROM (SELECT *, 0 AS v FROM {customer} UNION ALL SELECT *, 1 AS v FROM {customer} WHERE c_custkey % 10 = 0) c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

TEMPLATES["raw_loan_balance"] = """
SELECT CAST(o.o_orderkey AS BIGINT) AS LoanAccountBalanceId, 8 AS SourceId,
  CAST(CASE WHEN o.o_orderkey % 499 = 0 THEN 20251399
       ELSE (year(o.o_orderdate) + 24) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) END AS INT) AS BalanceDateId,
  CAST(o.o_custkey AS BIGINT) AS LoanAccountId, a.ProductId, a.AccountCurrencyId,
  CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INT) AS AccountStatusId,
  1 AS NumOfTransactions, '0,00' AS NetTransactionAmount, 'NULL' AS NetTransactionAmountSek,
  replace(CAST(CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(12,2)) AS STRING), '.', ',') AS AccruedInterest,
  '' AS AccruedInterestSEK,
  replace(CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS STRING), '.', ',') AS Balance,
  replace(CAST(CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) * CAST(11.5 AS DECIMAL(3,1)) AS DECIMAL(12,2)) AS STRING), '.', ',') AS BalanceSek,
  0 AS LTV, CAST(CASE WHEN o.o_orderkey % 4 = 0 THEN -1 ELSE o.o_orderkey - 1 END AS BIGINT) AS PrecedingId
FROM {orders} o JOIN (SELECT DISTINCT LoanAccountId, ProductId, AccountCurrencyId FROM {raw_loan_account}) a
  ON o.o_custkey = a.LoanAccountId
"""

TEMPLATES["raw_loan_transaction"] = """
SELECT CAST(CAST(l.l_orderkey AS BIGINT) * 10 + l.l_linenumber AS BIGINT) AS LoanAccountTransactionId, 8 AS SourceId,
  CAST((year(l.l_shipdate) + 24) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) + CASE WHEN l.l_partkey % 701 = 0 THEN 60 ELSE 0 END AS INT) AS TransactionDateId,
  CAST((year(l.l_shipdate) + 24) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS INT) AS ValueDateId,
  CAST((year(o.o_orderdate) + 24) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INT) AS EntryDateID,
  CAST(o.o_custkey AS BIGINT) AS LoanAccountId,
  CAST(CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS INT) AS TransactionTypeId,
  l.l_linestatus AS TransactionStatus, CAST(49 AS INT) AS TransactionCurrencyId,
  replace(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS STRING), '.', ',') AS TransactionAmount,
  replace(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS STRING), '.', ',') AS TransactionAmountSEK,
  concat(CAST(l.l_partkey AS STRING), '-', CAST(l.l_suppkey AS STRING)) AS TransactionReference,
  CAST(l.l_suppkey % 10 AS INT) AS ExchangeRateId, CAST(-1 AS INT) AS CounterPartId,
  CAST(CASE WHEN l.l_linenumber = 1 THEN -1 ELSE l.l_orderkey END AS BIGINT) AS InvoiceId
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

TEMPLATES["car_information"] = """
SELECT CAST(CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_partkey END AS INT) AS RecordID,
  concat(' ', p_name, ' ') AS CarModel,
  CASE p_type WHEN 'PROMO' THEN ' electric' WHEN 'SMALL' THEN 'Gasoline ' WHEN 'LARGE' THEN 'diesel'
       WHEN 'MEDIUM' THEN 'HYBRID' WHEN 'ECONOMY' THEN NULL ELSE 'hydrogen' END AS EnergyClass,
  CAST(2010 + p_size % 18 AS INT) AS ManufactureYear,
  CASE WHEN p_partkey % 31 = 0 THEN CAST(-1.0 AS DOUBLE) ELSE p_retailprice * 30 END AS BasePrice,
  CASE p_size % 4 WHEN 0 THEN ' low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'HIGH ' ELSE NULL END AS CustomerRiskTier,
  make_date(2025, 6, 1) AS FileMonth
FROM {part}
"""

TEMPLATES["energy_class_margin"] = """
SELECT * FROM (VALUES ('Electric ', CAST(1.25 AS DOUBLE)), ('GASOLINE', CAST(2.5 AS DOUBLE)), (' Diesel', CAST(2.75 AS DOUBLE)), ('hybrid', CAST(1.75 AS DOUBLE))) AS t(EnergyClass, MarginRate)
"""

TEMPLATES["credit_risk_tier"] = """
SELECT * FROM (VALUES ('LOW', CAST(0.5 AS DOUBLE)), (' medium', CAST(1.5 AS DOUBLE)), ('High', CAST(3.0 AS DOUBLE))) AS t(RiskTier, RiskAdjustment)
"""

TEMPLATES["depreciation_rates"] = """
SELECT * FROM (VALUES (0, 1, CAST(0.15 AS DOUBLE)), (2, 4, CAST(0.1 AS DOUBLE)), (5, 9, CAST(0.08 AS DOUBLE))) AS t(MinYear, MaxYear, DepreciationRate)
"""

TEMPLATES["interest_rates"] = """
SELECT * FROM (VALUES (make_date(2025, 3, 1), CAST(3.75 AS DOUBLE)), (make_date(2025, 4, 1), CAST(3.5 AS DOUBLE)), (make_date(2025, 5, 1), CAST(3.25 AS DOUBLE)), (make_date(2025, 7, 1), CAST(3.0 AS DOUBLE))) AS t(EffectiveDate, BaseInterestRate)
"""

TEMPLATES["raw_loan_account_day2"] = """
SELECT * FROM (
  SELECT LoanAccountId, SourceId, AccountNumber, IBAN, BBAN, AccountCurrencyId, AccountCurrency, OrganizationId, OrganizationName,
    ChannelID, BrokerId, OpenDateId, OpenDate, CancelledDateId, CancelledDate, ValueDate, MaturityDate, ProductId, Product, InvoiceDay,
    CASE WHEN LoanAccountId % 50 = 1 THEN '777,70' ELSE CurrentInstallmentAmount END AS CurrentInstallmentAmount,
    CurrentInvoiceFee, RepaymentRate, NextInvoiceDate, CalculatedMaturityDate
  FROM {raw_loan_account} WHERE LoanAccountId % 200 <> 7
  UNION ALL
  SELECT -LoanAccountId, SourceId, AccountNumber, IBAN, BBAN, AccountCurrencyId, AccountCurrency, OrganizationId, OrganizationName,
    ChannelID, BrokerId, OpenDateId, OpenDate, CancelledDateId, CancelledDate, ValueDate, MaturityDate, ProductId, Product, InvoiceDay,
    CurrentInstallmentAmount, CurrentInvoiceFee, RepaymentRate, NextInvoiceDate, CalculatedMaturityDate
  FROM {raw_loan_account} WHERE LoanAccountId % 100 = 3) q
"""

# Raw loan views are widened to the full declared layout (free-text columns the
# derivation does not produce become typed NULLs).
FULL_SCHEMA = {
    "raw_loan_account": ACCOUNT_SCHEMA,
    "raw_loan_account_day2": ACCOUNT_SCHEMA,
    "raw_loan_balance": BALANCE_SCHEMA,
    "raw_loan_transaction": TRANSACTION_SCHEMA,
}

ORDER = ("raw_loan_account", "raw_loan_balance", "raw_loan_transaction", "car_information",
         "energy_class_margin", "credit_risk_tier", "depreciation_rates", "interest_rates",
         "raw_loan_account_day2")

_SQL_TYPES = {"integer": "INT", "long": "BIGINT", "string": "STRING", "date": "DATE", "timestamp": "TIMESTAMP"}


def _deps(name: str) -> list[str]:
    import string
    return [f for _, f, _, _ in string.Formatter().parse(TEMPLATES[name]) if f]


def full_layout_sql(name: str, inner: str) -> str:
    """SELECT list that puts ``inner`` into the declared column order/types."""
    schema = FULL_SCHEMA[name]
    cols = []
    present = set(_present_columns(name))
    for f in schema.fields:
        t = _SQL_TYPES[f.dataType.typeName()]
        if f.name in present:
            cols.append(f"CAST({f.name} AS {t}) AS {f.name}")
        else:
            cols.append(f"CAST(NULL AS {t}) AS {f.name}")
    return f"SELECT {', '.join(cols)} FROM ({inner}) x"


# Columns of the declared layout that the derivation does not produce.
MISSING_COLUMNS = {
    "raw_loan_transaction": (
        "RectifyStatus", "CounterpartClearingNumber", "CounterPartBic", "CounterPartIban",
        "TransactionText", "AccountServicerReference", "CounterPartAccountNumber",
        "CounterPartBankName", "TransactionDateTime", "IsDirectDebit", "GLAccount", "EventName",
    ),
}


def _present_columns(name: str) -> list[str]:
    missing = set(MISSING_COLUMNS.get(name, ()))
    return [f.name for f in FULL_SCHEMA[name].fields if f.name not in missing]


def duckdb_views_sql() -> list[tuple[str, str]]:
    """(name, SQL) pairs that define every fixture view over the base tables."""
    out = []
    for name in ORDER:
        text = TEMPLATES[name].format(**{d: d for d in _deps(name)})
        if name in FULL_SCHEMA:
            text = full_layout_sql(name, text)
        out.append((name, text.strip()))
    return out


def cte_prefix(names: list[str] | None = None) -> str:
    """``WITH a AS (...), b AS (...)`` over all fixture views (DuckDB oracle)."""
    views = duckdb_views_sql()
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in views)


class Fixtures:
    """Lazily derived fixture DataFrames for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def get(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        if name not in self._cache:
            deps = {d: self.get(d) for d in _deps(name)}
            text = TEMPLATES[name]
            if name in FULL_SCHEMA:
                text = full_layout_sql(name, text)
            self._cache[name] = self.spark.sql(text, **deps)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "sf_dir"):
            raise AttributeError(name)
        if name in TEMPLATES or name in BASE_TABLES:
            return self.get(name)
        raise AttributeError(name)

    # Convenience names used across queries.
    @cached_property
    def acc(self) -> DataFrame:
        return self.get("raw_loan_account")

    @cached_property
    def acc2(self) -> DataFrame:
        return self.get("raw_loan_account_day2")

    @cached_property
    def bal(self) -> DataFrame:
        return self.get("raw_loan_balance")

    @cached_property
    def txn(self) -> DataFrame:
        return self.get("raw_loan_transaction")

    @cached_property
    def cars(self) -> DataFrame:
        return self.get("car_information")
