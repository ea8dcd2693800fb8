"""Star schema: calendar, account and code dimensions, balance and transaction
facts, referential checks.

* Code dimensions (organization, product, currency, transaction type) hold one
  row per natural id.  They come from a ``groupBy`` whose partial aggregation
  runs before the shuffle, so an id that carries a third of all accounts moves
  one row per map partition, not its rows.
* Surrogate keys are dense identities in natural-id order
  (``keys.assign_dense_identity``: range partitioning, no single-task window).
* Facts keep only rows whose foreign keys exist in their dimensions; the rest
  go to an orphan report instead of being silently dropped.  No join is forced
  into a broadcast; a check of a code against the fact's own codes is no join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.functions.dates import date_key, us_week_of_year
from lendstar.operators.keys import assign_dense_identity
from lendstar.specs import AUDIT_COLS

# ----------------------------------------------------------------- calendar

# The calendar span of the warehouse.
CALENDAR_START, CALENDAR_END = "2017-01-01", "2025-12-31"
# The widest span that dates of the data may widen the calendar to.
CALENDAR_LIMITS = ("1990-01-01", "2060-12-31")

DATE_COLUMNS = ["date_key", "full_date", "year", "quarter", "month", "month_name", "day",
                "day_of_week", "day_name", "week_of_year", "is_weekend", "is_holiday"]


def _as_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.date):
        d = d.isoformat()
    return F.lit(str(d)).cast("date")


def date_dimension(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in [start, end] with calendar attributes.

    ``start`` / ``end`` are dates, ISO strings or date Columns (e.g. scalar
    subqueries over fact dates).  Weekday is Sunday = 1; week of year counts
    Sunday-started weeks with January 1 in week 1; weekend = Sunday or
    Saturday; ``is_holiday`` defaults to 0.  Rows = days in the span, so the
    single generator row is bounded by the calendar, not by the data.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(_as_date(start), _as_date(end), F.expr("INTERVAL 1 DAY"))).alias("d"))
    d = F.col("d")
    dow = F.dayofweek(d)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        us_week_of_year(d).alias("week_of_year"),
        dow.isin(1, 7).cast("int").alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
    )


def calendar_bounds(*dated: tuple[DataFrame, str], start=CALENDAR_START, end=CALENDAR_END, within=None):
    """(start, end) widened to cover every date column given: the span is
    ``least(start, min over data)`` .. ``greatest(end, max over data)``.  Dates
    outside ``within`` (an end-of-time date, a typing error) do not widen it;
    ``outside_calendar`` reports them (``pipeline.run_star`` logs its counts).
    Each extreme is a scalar subquery (one partial aggregate per input)."""
    lo, hi = _as_date(start), _as_date(end)
    for df, c in dated:
        if within:
            df = df.filter(F.col(c).between(_as_date(within[0]), _as_date(within[1])))
        ext = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar()
        lo = F.least(lo, ext.getField("lo"))
        hi = F.greatest(hi, ext.getField("hi"))
    return lo, hi


def outside_calendar(*dated: tuple[DataFrame, str], within=CALENDAR_LIMITS) -> DataFrame:
    """(column_name, date, rows) of the dates that may not widen the calendar."""
    parts = [df.filter(~F.col(c).between(_as_date(within[0]), _as_date(within[1])))
             .groupBy(F.lit(c).alias("column_name"), F.col(c).alias("date")).agg(F.count(F.lit(1)).alias("rows"))
             for df, c in dated]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ----------------------------------------------------------------- dimensions

# Cleansed account column -> Dim_Account column.
ACCOUNT_DIM_MAP = [
    ("LoanAccountId", "account_id"), ("AccountNumber", "account_number"),
    ("AccountCurrency", "currency_code"), ("OrganizationId", "organization_id"),
    ("ChannelID", "channel_id"), ("BrokerId", "broker_id"), ("Product", "product_name"),
    ("OpenDate", "open_date"), ("CancelledDate", "cancelled_date"), ("ValueDate", "value_date"),
    ("InvoiceDay", "invoice_day"), ("CurrentInstallmentAmount", "current_installment_amount"),
    ("CurrentInvoiceFee", "current_invoice_fee"), ("NextInvoiceDate", "next_invoice_date"),
    ("CalculatedMaturityDate", "calculated_maturity_date"), ("IsActive", "is_active"),
]
# Dim_Account stores the instalment and fee as DECIMAL(12,2).
ACCOUNT_DIM_DECIMALS = {"current_installment_amount": "decimal(12,2)",
                        "current_invoice_fee": "decimal(12,2)"}
ACCOUNT_DIM_COLUMNS = [b for _, b in ACCOUNT_DIM_MAP]


def account_rows(clean_accounts: DataFrame) -> DataFrame:
    """Cleansed accounts renamed/narrowed to the Dim_Account layout (no key)."""
    return clean_accounts.select(*[
        (F.col(a).try_cast(ACCOUNT_DIM_DECIMALS[b]) if b in ACCOUNT_DIM_DECIMALS else F.col(a)).alias(b)
        for a, b in ACCOUNT_DIM_MAP])


def dim_account(clean_accounts: DataFrame) -> DataFrame:
    """account_key + Dim_Account columns; one row per account (input is deduplicated)."""
    return assign_dense_identity(account_rows(clean_accounts), "account_id", "account_key")


def account_ids(clean_accounts: DataFrame) -> DataFrame:
    """The natural keys of the account dimension (for referential checks)."""
    return clean_accounts.select(F.col("LoanAccountId").alias("account_id"))


def code_dimension(df: DataFrame, id_col: str, attrs: dict[str, str], id_name: str,
                   key_name: str | None) -> DataFrame:
    """One row per natural id with its attributes and a dense surrogate key.

    ``attrs`` maps source column -> dimension column.  When an id appears
    with several attribute combinations the smallest one wins (deterministic).
    ``key_name=None`` skips the surrogate key (lookups that only need names).
    """
    if attrs:
        picked = F.min(F.struct(*[F.col(a).alias(b) for a, b in attrs.items()])).alias("__a")
        one = df.groupBy(F.col(id_col).alias(id_name)).agg(picked).select(id_name, "__a.*")
    else:
        one = df.select(F.col(id_col).alias(id_name)).distinct()
    one = one.filter(F.col(id_name).isNotNull())
    return assign_dense_identity(one, id_name, key_name) if key_name else one


def dim_organization(clean_accounts: DataFrame, keyed: bool = True) -> DataFrame:
    return code_dimension(clean_accounts, "OrganizationId",
                          {"OrganizationName": "organization_name", "SourceId": "source_id"},
                          "organization_id", "organization_key" if keyed else None)


def dim_product(clean_accounts: DataFrame, keyed: bool = True) -> DataFrame:
    return code_dimension(clean_accounts, "ProductId", {"Product": "product_name"},
                          "product_id", "product_key" if keyed else None)


def dim_currency(clean_accounts: DataFrame, keyed: bool = True) -> DataFrame:
    return code_dimension(clean_accounts, "AccountCurrencyId", {"AccountCurrency": "currency_code"},
                          "currency_id", "currency_key" if keyed else None)


def dim_transaction_type(clean_transactions: DataFrame, keyed: bool = True) -> DataFrame:
    return code_dimension(clean_transactions, "TransactionTypeId", {},
                          "transaction_type_id", "transaction_type_key" if keyed else None)


# ----------------------------------------------------------------- facts

# Cleansed balance column -> Fact_Balance column.
BALANCE_FACT_MAP = [
    ("LoanAccountBalanceId", "balance_id"), ("PrecedingId", "preceding_id"),
    ("LoanAccountId", "account_id"), ("AccountStatusId", "account_status_id"),
    ("ProductId", "product_id"), ("AccountCurrencyId", "currency_id"),
    ("AccruedInterest", "accrued_interest_eur"), ("AccruedInterestSEK", "accrued_interest_sek"),
    ("Balance", "balance_eur"), ("BalanceSek", "balance_sek"), ("BalanceDate", "balance_date"),
]

# Cleansed transaction column -> Fact_Transaction column.
TRANSACTION_FACT_MAP = [
    ("LoanAccountTransactionId", "transaction_id"), ("TransactionDate", "transaction_date"),
    ("ValueDate", "value_date"), ("EntryDate", "entry_date"), ("LoanAccountId", "account_id"),
    ("TransactionTypeId", "transaction_type_id"), ("TransactionAmount", "transaction_amount"),
    ("TransactionAmountSEK", "transaction_amount_sek"),
    ("TransactionReference", "transaction_reference"),
    ("TransactionCurrencyId", "currency_id"), ("ExchangeRateId", "exchange_rate_id"),
]


def rename(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in mapping])


def conforming(fact: DataFrame, refs: list[tuple[DataFrame | None, str]]) -> DataFrame:
    """Fact rows whose every foreign key exists in its dimension (semi joins).

    A dimension of None stands for one built from this fact: every key that
    isn't NULL is in it, so that check is a filter and moves no row.
    """
    for dim, col in refs:
        fact = (fact.filter(F.col(col).isNotNull()) if dim is None
                else fact.join(dim.select(col), col, "left_semi"))
    return fact


def orphans(fact: DataFrame, refs: list[tuple[DataFrame | None, str]], id_col: str) -> DataFrame:
    """Fact id + the foreign key that has no dimension row (one row per miss)."""
    parts = []
    for dim, col in refs:
        miss = (fact.filter(F.col(col).isNull()) if dim is None
                else fact.join(dim.select(col), col, "left_anti"))
        parts.append(miss.select(id_col, F.lit(col).alias("missing_key"),
                                 F.col(col).cast("long").alias("key_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def marked(fact: DataFrame, refs: list[tuple[DataFrame | None, str]], name: str = "missing_key") -> DataFrame:
    """``fact`` with the first foreign key that has no dimension row, NULL if
    all have one: conforming rows and orphans from one pass."""
    missing = []
    for i, (dim, col) in enumerate(refs):
        found = F.col(col).isNotNull()
        if dim is not None:
            fact = fact.join(dim.select(F.col(col), F.lit(True).alias(f"__found{i}")), col, "left")
            found = F.col(f"__found{i}").isNotNull()
        missing.append(F.when(~found, F.lit(col)))
    return fact.withColumn(name, F.coalesce(*missing)).drop(*[f"__found{i}" for i in range(len(refs))])


def audited(mapping: list[tuple[str, str]], audit: bool = True) -> list[tuple[str, str]]:
    return mapping + [(c, c) for c in AUDIT_COLS] if audit else mapping


def balance_rows(clean_balances: DataFrame, acc_ids: DataFrame, audit: bool = False) -> DataFrame:
    """Fact_Balance rows (no surrogate key) whose account exists; with the
    cleansed table's audit columns for the published table."""
    return conforming(rename(clean_balances, audited(BALANCE_FACT_MAP, audit)), [(acc_ids, "account_id")])


def transaction_rows(clean_transactions: DataFrame, acc_ids: DataFrame,
                     ttype_ids: DataFrame | None = None, audit: bool = False) -> DataFrame:
    """Fact_Transaction rows (no surrogate key) whose account and type exist."""
    return conforming(rename(clean_transactions, audited(TRANSACTION_FACT_MAP, audit)),
                      [(acc_ids, "account_id"), (ttype_ids, "transaction_type_id")])


def fact_balance(clean_balances: DataFrame, acc_ids: DataFrame) -> DataFrame:
    return assign_dense_identity(balance_rows(clean_balances, acc_ids), "balance_id", "balance_key")


def fact_transaction(clean_transactions: DataFrame, acc_ids: DataFrame,
                     ttype_ids: DataFrame | None = None) -> DataFrame:
    return assign_dense_identity(transaction_rows(clean_transactions, acc_ids, ttype_ids),
                                 "transaction_id", "transaction_key")


def balance_orphans(clean_balances: DataFrame, dim_acc: DataFrame) -> DataFrame:
    return orphans(rename(clean_balances, BALANCE_FACT_MAP), [(dim_acc, "account_id")], "balance_id")


def transaction_orphans(clean_transactions: DataFrame, dim_acc: DataFrame,
                        dim_ttype: DataFrame | None = None) -> DataFrame:
    return orphans(rename(clean_transactions, TRANSACTION_FACT_MAP),
                   [(dim_acc, "account_id"), (dim_ttype, "transaction_type_id")], "transaction_id")


def balance_star(fact_bal: DataFrame, dim_acc: DataFrame, dim_prod: DataFrame,
                 dim_org: DataFrame, dim_cur: DataFrame) -> DataFrame:
    """Balance facts with every dimension's surrogate key and the date key.

    The account dimension grows with the customer base: a shuffle join on
    account_id unless adaptive execution measures it small.  Organization is reached through the account (by id, never by
    name, so repeated names cannot fan out).  Code dimensions are tiny.
    """
    acc = dim_acc.select("account_id", "account_key", "organization_id")
    j = fact_bal.join(acc, "account_id")
    j = j.join(dim_prod.select("product_id", "product_key"), "product_id")
    j = j.join(dim_org.select("organization_id", "organization_key"), "organization_id")
    j = j.join(dim_cur.select("currency_id", "currency_key"), "currency_id")
    return j.select(
        "balance_key", "balance_id", "account_key", "product_key", "organization_key",
        "currency_key", date_key("balance_date").alias("date_key"), "account_status_id",
        "accrued_interest_eur", "accrued_interest_sek", "balance_eur", "balance_sek", "balance_date")
