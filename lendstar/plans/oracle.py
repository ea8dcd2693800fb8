"""DuckDB SQL twins of the named queries (the correctness oracle).

Each statement starts with the fixture views as CTEs over the driver's base
tables, adds shared intermediate CTEs it needs, then selects the output with
the same column names as the Spark query.
"""

from __future__ import annotations

from lendstar.fixtures import CALENDAR_END, CALENDAR_START, RUN_DATE, cte_prefix

ORACLE: dict[str, str] = {}

# Shared intermediate steps, written once.  Each entry: name -> (deps, sql).
STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def step(name: str, sql: str, deps: tuple[str, ...] = ()):
    STEPS[name] = (deps, sql)


def _resolve(names, seen=None, out=None):
    seen = set() if seen is None else seen
    out = [] if out is None else out
    for n in names:
        if n in seen:
            continue
        seen.add(n)
        _resolve(STEPS[n][0], seen, out)
        out.append(n)
    return out


def oracle(key: str, select: str, uses: tuple[str, ...] = ()):
    ctes = "".join(f",\n{n} AS ({STEPS[n][1]})" for n in _resolve(uses))
    ORACLE[key] = cte_prefix() + ctes + "\n" + select


RUN = f"DATE '{RUN_DATE}'"

# --------------------------------------------------------------- profit

step("staged", f"""
SELECT RecordID, trim(CarModel) AS CarModel, upper(trim(EnergyClass)) AS EnergyClass,
  CAST(CASE WHEN ManufactureYear < 2015 OR ManufactureYear > year({RUN}) THEN NULL ELSE ManufactureYear END AS INT) AS ManufactureYear,
  CASE WHEN BasePrice <= 0 THEN NULL ELSE BasePrice END AS BasePrice,
  upper(trim(CustomerRiskTier)) AS CustomerRiskTier, FileMonth
FROM car_information
WHERE RecordID IS NOT NULL AND CarModel IS NOT NULL AND EnergyClass IS NOT NULL
  AND BasePrice > 0 AND CustomerRiskTier IS NOT NULL""")

step("rate", f"""
SELECT EffectiveDate, BaseInterestRate,
  strftime(EffectiveDate, '%Y%m') <> strftime({RUN}, '%Y%m') AS is_fallback
FROM (SELECT *, row_number() OVER (ORDER BY EffectiveDate DESC, BaseInterestRate DESC) AS rn
      FROM interest_rates WHERE EffectiveDate <= {RUN}) WHERE rn = 1""")

oracle("car_staging", "SELECT * FROM staged", ("staged",))

oracle("energy_margin_join", """
SELECT c.RecordID, m.MarginRate, t.RiskAdjustment
FROM staged c JOIN energy_class_margin m ON c.EnergyClass = upper(trim(m.EnergyClass))
JOIN credit_risk_tier t ON c.CustomerRiskTier = upper(trim(t.RiskTier))""", ("staged",))

oracle("depreciation_band_join", """
SELECT c.RecordID, CAST(year(c.FileMonth) - c.ManufactureYear AS INT) AS age, d.DepreciationRate
FROM staged c JOIN depreciation_rates d
  ON (year(c.FileMonth) - c.ManufactureYear) BETWEEN d.MinYear AND d.MaxYear""", ("staged",))

oracle("depreciation_band_edges", """
SELECT c.RecordID, CAST(year(c.FileMonth) - c.ManufactureYear + 0.25 AS DOUBLE) AS age, d.rate
FROM staged c JOIN (VALUES (CAST(NULL AS DECIMAL(4,2)), 9.00, CAST(0.5 AS DOUBLE)), (0.50, 2.25, 0.2),
  (2.00, CAST(NULL AS DECIMAL(4,2)), 0.3), (2.25, 9.00, 0.1)) d(lo, hi, rate)
  ON year(c.FileMonth) - c.ManufactureYear + 0.25 BETWEEN d.lo AND d.hi""", ("staged",))

_BANDS = """(VALUES (CAST(0 AS DECIMAL(15,5)), CAST(3000000000 AS DECIMAL(15,5)), 1), (-3000000000, 99.995, 2), (1000.5, 1000.5, 3),
  (2500.25, 250000.75, 4), (9, 1, 5), (CAST(NULL AS DECIMAL(15,5)), 5, 6), (5, CAST(NULL AS DECIMAL(15,5)), 7)) d(lo, hi, band)"""

oracle("rate_asof_null_dates", """
SELECT a.LoanAccountId, a.OpenDateId, a.d,
  (SELECT max(EffectiveDate) FROM interest_rates i WHERE i.EffectiveDate <= a.d) AS EffectiveDate,
  (SELECT arg_max(BaseInterestRate, EffectiveDate) FROM interest_rates i WHERE i.EffectiveDate <= a.d) AS BaseInterestRate
FROM (SELECT LoanAccountId, OpenDateId, CASE WHEN LoanAccountId % 9 <> 0
        THEN CAST(DATE '2025-01-15' + to_months(CAST(LoanAccountId % 8 AS INT)) AS DATE) END AS d FROM raw_loan_account) a""")

oracle("rate_asof", """
SELECT c.RecordID, (SELECT EffectiveDate FROM rate) AS EffectiveDate,
  (SELECT BaseInterestRate FROM rate) AS BaseInterestRate, (SELECT is_fallback FROM rate) AS is_fallback
FROM staged c WHERE EXISTS (SELECT 1 FROM rate)""", ("staged", "rate"))

oracle("rate_asof_by_month", """
SELECT a.LoanAccountId, a.OpenDateId, a.rate_month,
  r.EffectiveDate, r.BaseInterestRate
FROM (SELECT LoanAccountId, OpenDateId, CAST(date_trunc('month', NextInvoiceDate) AS DATE) AS rate_month
      FROM raw_loan_account) a
LEFT JOIN (
  SELECT m.rate_month, i.EffectiveDate, i.BaseInterestRate,
    row_number() OVER (PARTITION BY m.rate_month ORDER BY i.EffectiveDate DESC, i.BaseInterestRate DESC) AS rn
  FROM (SELECT DISTINCT CAST(date_trunc('month', NextInvoiceDate) AS DATE) AS rate_month FROM raw_loan_account) m
  JOIN interest_rates i ON i.EffectiveDate <= m.rate_month) r
  ON a.rate_month = r.rate_month AND r.rn = 1""")

step("estimates", """
SELECT c.RecordID, c.CarModel, c.EnergyClass, c.ManufactureYear, c.BasePrice, c.CustomerRiskTier,
  (SELECT BaseInterestRate FROM rate) + m.MarginRate + t.RiskAdjustment AS FinalInterestRate,
  (c.BasePrice * ((SELECT BaseInterestRate FROM rate) + m.MarginRate + t.RiskAdjustment) / 100) / 12 AS EstimatedMonthlyPayment,
  c.BasePrice * (1 - d.DepreciationRate) AS DepreciatedValue,
  (c.BasePrice * ((SELECT BaseInterestRate FROM rate) + m.MarginRate + t.RiskAdjustment) / 100)
    - (c.BasePrice - c.BasePrice * (1 - d.DepreciationRate)) AS EstimatedProfit,
  c.FileMonth
FROM staged c
JOIN energy_class_margin m ON c.EnergyClass = upper(trim(m.EnergyClass))
JOIN credit_risk_tier t ON c.CustomerRiskTier = upper(trim(t.RiskTier))
JOIN depreciation_rates d ON (year(c.FileMonth) - c.ManufactureYear) BETWEEN d.MinYear AND d.MaxYear
WHERE EXISTS (SELECT 1 FROM rate)""", ("staged", "rate"))
oracle("loan_profit_estimates", "SELECT * FROM estimates", ("estimates",))


# --------------------------------------------------------------- cleansing

from lendstar.fixtures import DAY1_DATE as DAY1_DATE_, DAY1_TS, DAY2_TS  # noqa: E402
from lendstar.specs import ACCOUNT, BALANCE, TRANSACTION, TableSpec  # noqa: E402

_T = {"integer": "INT", "long": "BIGINT", "string": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP"}
DEC = "DECIMAL(15,5)"


def _is_null_token(c: str) -> str:
    return f"({c} IS NULL OR {c} IN ('', 'NULL', 'null'))"


def _parsed(c: str) -> str:
    return f"TRY_CAST(replace(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), ',', '.') AS {DEC})"


def eu_sql(c: str) -> str:
    return f"CASE WHEN {_is_null_token(c)} THEN CAST(0 AS {DEC}) ELSE {_parsed(c)} END"


def _unparseable(c: str) -> str:
    return f"(NOT {_is_null_token(c)} AND {_parsed(c)} IS NULL)"


def conform_sql(spec: TableSpec, src: str) -> str:
    """Typed/defaulted columns + reject_reason ('' = accepted)."""
    sel, reasons = [], []
    for f in spec.schema.fields:
        c = f.name
        if c in spec.amount_cols:
            sel.append(f"{eu_sql(c)} AS {c}")
        elif c in spec.defaults:
            sel.append(f"coalesce({c}, CAST({spec.defaults[c]} AS {_T[f.dataType.typeName()]})) AS {c}")
        else:
            sel.append(c)
    for c in spec.amount_cols:
        reasons.append(f"CASE WHEN {_unparseable(c)} THEN '{c} unparseable' END")
    for c in spec.not_null_cols:
        if c in spec.amount_cols:
            continue
        expr = f"coalesce({c}, {spec.defaults[c]})" if c in spec.defaults else c
        reasons.append(f"CASE WHEN {expr} IS NULL THEN '{c} is null' END")
    for c, n in spec.length_checks.items():
        reasons.append(f"CASE WHEN length({c}) <> {n} THEN '{c} length <> {n}' END")
    for k in spec.date_keys.values():
        reasons.append(f"CASE WHEN {k} IS NOT NULL AND try_strptime(CAST({k} AS VARCHAR), '%Y%m%d') IS NULL "
                       f"THEN '{k} is no date' END")
    return f"SELECT {', '.join(sel)}, concat_ws('; ', {', '.join(reasons)}) AS reject_reason FROM {src}"


def clean_sql(spec: TableSpec, conf: str) -> str:
    cols = spec.business_cols
    sent = [f"CASE WHEN {c} = -1 THEN NULL ELSE {c} END AS {c}" if c in spec.sentinel_cols else c
            for c in cols]
    tie = [f"{c} ASC NULLS FIRST" for c in cols if c not in (spec.key, spec.order_col)]
    order = ", ".join([f"{spec.order_col} DESC NULLS LAST"] + tie)
    computed = [f"CAST(try_strptime(CAST({k} AS VARCHAR), '%Y%m%d') AS DATE) AS {d}"
                for d, k in spec.date_keys.items()]
    if spec.is_active_from:
        computed.append(f"CAST({spec.is_active_from} IS NULL AS INT) AS IsActive")
    inner = (f"SELECT {', '.join(sent)} FROM {conf} WHERE reject_reason = ''")
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY {spec.key} ORDER BY {order}) AS __rn "
              f"FROM ({inner}) s")
    return f"SELECT {', '.join(cols + computed)} FROM ({ranked}) r WHERE __rn = 1"


for _name, _spec, _src in (("acc", ACCOUNT, "raw_loan_account"), ("bal", BALANCE, "raw_loan_balance"),
                           ("txn", TRANSACTION, "raw_loan_transaction"),
                           ("acc2", ACCOUNT, "raw_loan_account_day2")):
    step(f"conf_{_name}", conform_sql(_spec, _src))
    step(f"clean_{_name}", clean_sql(_spec, f"conf_{_name}"), (f"conf_{_name}",))

oracle("european_decimal", f"""
SELECT LoanAccountId, OpenDateId, {eu_sql('CurrentInstallmentAmount')} AS CurrentInstallmentAmount,
  {eu_sql('CurrentInvoiceFee')} AS CurrentInvoiceFee FROM raw_loan_account""")

oracle("reject_amounts", " UNION ALL ".join(
    f"SELECT LoanAccountId, OpenDateId, '{c}' AS column_name, {c} AS raw_value "
    f"FROM raw_loan_account WHERE {_unparseable(c)}" for c in ACCOUNT.amount_cols))

oracle("conform_accounts",
       f"SELECT {', '.join(ACCOUNT.business_cols)} FROM conf_acc WHERE reject_reason = ''",
       ("conf_acc",))
oracle("reject_accounts",
       "SELECT LoanAccountId, OpenDateId, reject_reason FROM conf_acc WHERE reject_reason <> ''",
       ("conf_acc",))
oracle("reject_balances", "SELECT LoanAccountBalanceId, BalanceDateId, reject_reason FROM conf_bal "
       "WHERE reject_reason <> ''", ("conf_bal",))
oracle("reject_transactions", "SELECT LoanAccountTransactionId, TransactionDateId, reject_reason FROM conf_txn "
       "WHERE reject_reason <> ''", ("conf_txn",))
oracle("clean_accounts", "SELECT * FROM clean_acc", ("clean_acc",))
oracle("clean_balances", "SELECT * FROM clean_bal", ("clean_bal",))
oracle("clean_transactions", "SELECT * FROM clean_txn", ("clean_txn",))
oracle("dedup_accounts", "SELECT LoanAccountId, OpenDateId, OpenDate FROM clean_acc", ("clean_acc",))
oracle("dedup_balances", "SELECT LoanAccountBalanceId, BalanceDateId, LoanAccountId FROM clean_bal",
       ("clean_bal",))
oracle("dedup_transactions",
       "SELECT LoanAccountTransactionId, TransactionDateId, TransactionReference FROM clean_txn",
       ("clean_txn",))
oracle("band_join_wide", f"""
SELECT LoanAccountBalanceId, Balance, band FROM clean_bal JOIN {_BANDS} ON Balance BETWEEN lo AND hi""", ("clean_bal",))
oracle("duplicate_keys", """
SELECT LoanAccountTransactionId, count(*) AS n FROM raw_loan_transaction
GROUP BY LoanAccountTransactionId HAVING count(*) > 1""")


def local_ts(ts: str) -> str:
    return f"((TIMESTAMP '{ts}' AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm')"


def audit_sql(ts: str) -> str:
    lt = local_ts(ts)
    return (f"{lt} AS CreatedDate, CAST({lt} AS DATE) AS UpdatedDate, "
            f"strftime({lt}, '%H:%M:%S') AS UpdatedTime")


oracle("audit_columns", f"SELECT LoanAccountId, {audit_sql(DAY1_TS)} FROM clean_acc", ("clean_acc",))

# --------------------------------------------------------------- identity


def ident(spec: TableSpec, src: str, base: str = "0") -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY {spec.key} NULLS FIRST) + {base} AS BIGINT) "
            f"AS {spec.identity_col}, * FROM {src}")


step("snap_acc", f"SELECT *, {audit_sql(DAY1_TS)} FROM ({ident(ACCOUNT, 'clean_acc')}) x", ("clean_acc",))

oracle("identity_initial",
       f"SELECT {BALANCE.identity_col}, {BALANCE.key} FROM ({ident(BALANCE, 'clean_bal')}) x",
       ("clean_bal",))

_TABLES = (("acc", ACCOUNT), ("bal", BALANCE), ("txn", TRANSACTION))
oracle("key_range", " UNION ALL ".join(
    f"SELECT '{s.name}' AS table_name, min({s.key}) AS min_key, max({s.key}) AS max_key FROM clean_{n}"
    for n, s in _TABLES), tuple(f"clean_{n}" for n, _ in _TABLES))
oracle("row_counts", " UNION ALL ".join(
    f"SELECT '{s.name}' AS table_name, count(*) AS raw_rows, "
    f"count(CASE WHEN reject_reason = '' THEN 1 END) AS accepted_rows, "
    f"count(CASE WHEN reject_reason <> '' THEN 1 END) AS rejected_rows, "
    f"(SELECT count(*) FROM clean_{n}) AS clean_rows FROM conf_{n}"
    for n, s in _TABLES), tuple(f"clean_{n}" for n, _ in _TABLES))

# --------------------------------------------------------------- changes and upserts

_K = ACCOUNT.key
_BIZ = [c for c in ACCOUNT.business_cols if c != _K]
_EQ = " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in _BIZ)

step("classified", f"""
SELECT coalesce(n.{_K}, o.{_K}) AS {_K},
  CASE WHEN o.{_K} IS NULL THEN 'insert' WHEN n.{_K} IS NULL THEN 'missing'
       WHEN {_EQ} THEN 'same' ELSE 'update' END AS change
FROM clean_acc2 n FULL OUTER JOIN clean_acc o ON n.{_K} = o.{_K}""", ("clean_acc", "clean_acc2"))
step("max_acc", f"SELECT CAST(coalesce(max({ACCOUNT.identity_col}), 0) AS BIGINT) AS m FROM snap_acc",
     ("snap_acc",))

oracle("identity_increment", f"""
SELECT CAST(row_number() OVER (ORDER BY n.{_K}) + (SELECT m FROM max_acc) AS BIGINT) AS {ACCOUNT.identity_col}, n.{_K}
FROM clean_acc2 n WHERE n.{_K} NOT IN (SELECT {_K} FROM snap_acc)""", ("clean_acc2", "max_acc"))
oracle("detect_new_keys", f"""
SELECT DISTINCT n.{_K} FROM clean_acc2 n WHERE NOT EXISTS (SELECT 1 FROM clean_acc o WHERE o.{_K} = n.{_K})""",
       ("clean_acc", "clean_acc2"))
_ALL = ", ".join(ACCOUNT.business_cols)
oracle("changed_rows_exceptall", f"SELECT {_ALL} FROM clean_acc2 EXCEPT ALL SELECT {_ALL} FROM clean_acc",
       ("clean_acc", "clean_acc2"))
oracle("detect_changes", "SELECT * FROM classified", ("classified",))
oracle("change_counts", "SELECT change, count(*) AS n FROM classified GROUP BY change", ("classified",))

_IDC = ACCOUNT.identity_col
oracle("upsert_snapshot", f"""
SELECT s.{_IDC}, {', '.join('s.' + c for c in ACCOUNT.business_cols)}
FROM snap_acc s JOIN classified k ON s.{_K} = k.{_K} WHERE k.change IN ('same', 'missing')
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY n.{_K}) + (SELECT m FROM max_acc) AS BIGINT) AS {_IDC},
  {', '.join('n.' + c for c in ACCOUNT.business_cols)}
FROM clean_acc2 n JOIN classified k ON n.{_K} = k.{_K} WHERE k.change IN ('insert', 'update')""",
       ("snap_acc", "classified", "max_acc", "clean_acc2"))

_lt2 = local_ts(DAY2_TS)
oracle("merge_upsert", f"""
SELECT s.{_IDC}, s.{_K},
  {', '.join(f"CASE WHEN k.change = 'update' THEN n.{c} ELSE s.{c} END AS {c}" for c in _BIZ)},
  s.CreatedDate,
  CASE WHEN k.change = 'update' THEN CAST({_lt2} AS DATE) ELSE s.UpdatedDate END AS UpdatedDate,
  CASE WHEN k.change = 'update' THEN strftime({_lt2}, '%H:%M:%S') ELSE s.UpdatedTime END AS UpdatedTime
FROM snap_acc s JOIN classified k ON s.{_K} = k.{_K} LEFT JOIN clean_acc2 n ON n.{_K} = s.{_K}
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY n.{_K}) + (SELECT m FROM max_acc) AS BIGINT) AS {_IDC},
  {', '.join('n.' + c for c in ACCOUNT.business_cols)}, {audit_sql(DAY2_TS)}
FROM clean_acc2 n JOIN classified k ON n.{_K} = k.{_K} WHERE k.change = 'insert'""",
       ("snap_acc", "classified", "max_acc", "clean_acc2"))

oracle("max_identity", f"""
SELECT '{ACCOUNT.name}' AS table_name, CAST((SELECT m FROM max_acc)
  + (SELECT count(*) FROM classified WHERE change IN ('insert', 'update')) AS BIGINT) AS max_id""", ("max_acc", "classified"))

oracle("append_changes", f"""
SELECT {_IDC}, {_ALL} FROM snap_acc
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY n.{_K}) + (SELECT m FROM max_acc) AS BIGINT) AS {_IDC},
  {', '.join('n.' + c for c in ACCOUNT.business_cols)}
FROM clean_acc2 n JOIN classified k ON n.{_K} = k.{_K} WHERE k.change IN ('insert', 'update')""",
       ("snap_acc", "classified", "max_acc", "clean_acc2"))

oracle("rerun_is_noop", """
SELECT CAST(1 AS BIGINT) AS versions, CAST(0 AS BIGINT) AS changed_rows, count(*) AS unchanged_rows FROM clean_acc""",
       ("clean_acc",))

def _crc32(c: str) -> str:
    """CRC-32 of the decimal text of an integer, bit by bit."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    digits = f"list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {digits}), lambda a, b: list_reduce(list_concat([xor(a, b)], "
            f"list_transform(range(8), lambda i: CAST(0 AS BIGINT))), lambda c, z: {step})), 4294967295)")


step("raw_acc_changed", "SELECT * REPLACE (CASE WHEN LoanAccountId % 100 = 1 THEN '777,70' ELSE CurrentInstallmentAmount END "
                        "AS CurrentInstallmentAmount) FROM raw_loan_account")
step("conf_acc_changed", conform_sql(ACCOUNT, "raw_acc_changed"), ("raw_acc_changed",))
step("clean_acc_changed", clean_sql(ACCOUNT, "conf_acc_changed"), ("conf_acc_changed",))
step("acc_changes", "SELECT n.LoanAccountId, o.LoanAccountId IS NULL AS is_new FROM clean_acc_changed n LEFT JOIN clean_acc o "
                    "ON n.LoanAccountId = o.LoanAccountId WHERE n.CurrentInstallmentAmount IS DISTINCT FROM o.CurrentInstallmentAmount",
     ("clean_acc_changed", "clean_acc"))
oracle("upsert_changed_buckets", f"""
SELECT x.*, (SELECT count(*) FROM acc_changes) AS changed_rows,
  (SELECT count(DISTINCT {_crc32('LoanAccountId')} % 16) FROM acc_changes) AS written_buckets
FROM (SELECT s.{_IDC}, s.LoanAccountId, n.CurrentInstallmentAmount, s.CreatedDate,
        CASE WHEN s.LoanAccountId IN (SELECT LoanAccountId FROM acc_changes) THEN CAST({_lt2} AS DATE) ELSE s.UpdatedDate END AS UpdatedDate
      FROM snap_acc s JOIN clean_acc_changed n ON n.LoanAccountId = s.LoanAccountId
      UNION ALL
      SELECT CAST(row_number() OVER (ORDER BY n.LoanAccountId) + (SELECT m FROM max_acc) AS BIGINT), n.LoanAccountId,
        n.CurrentInstallmentAmount, {_lt2}, CAST({_lt2} AS DATE)
      FROM clean_acc_changed n JOIN acc_changes c ON c.LoanAccountId = n.LoanAccountId WHERE c.is_new) x""",
       ("snap_acc", "acc_changes", "max_acc"))
oracle("late_delivery_merge", f"SELECT LoanAccountId, OpenDateId, OpenDate, {_IDC} FROM snap_acc", ("snap_acc",))
oracle("table_pipeline_log", " UNION ALL ".join(
    f"SELECT '{s.name}' AS step, 'ok' AS status, 'first load' AS message, (SELECT count(*) FROM clean_{n}) AS row_count, "
    f"count(*) AS raw_rows, count(*) FILTER (reject_reason = '') AS accepted_rows, "
    f"count(*) FILTER (reject_reason <> '') AS rejected_rows, "
    f"count(*) FILTER (reject_reason = '') - (SELECT count(*) FROM clean_{n}) AS duplicate_rows FROM conf_{n}"
    for n, s in _TABLES), tuple(f"clean_{n}" for n, _ in _TABLES))
oracle("stream_deliveries", """
SELECT LoanAccountId, OpenDateId FROM clean_acc
UNION ALL SELECT LoanAccountId, OpenDateId FROM clean_acc2 WHERE LoanAccountId NOT IN (SELECT LoanAccountId FROM clean_acc)""",
       ("clean_acc", "clean_acc2"))

# --------------------------------------------------------------- sources and sinks

from lendstar.specs import TRANSACTION_SCHEMA  # noqa: E402

oracle("scan_csv_roundtrip",
       f"SELECT {', '.join(f.name for f in TRANSACTION_SCHEMA.fields)} FROM raw_loan_transaction")
oracle("scan_csv_layouts", "SELECT " + ", ".join(
    "CASE WHEN LoanAccountTransactionId % 3 <> 2 THEN TransactionReference END AS TransactionReference"
    if f.name == "TransactionReference" else f.name for f in TRANSACTION_SCHEMA.fields) + " FROM raw_loan_transaction")
oracle("scan_parquet", "SELECT * FROM orders")
oracle("scan_csv_inferred", "SELECT LoanAccountBalanceId, LoanAccountId, CAST(BalanceDateId AS BIGINT) AS BalanceDateId, "
       "Balance FROM raw_loan_balance")
oracle("source_fallback", "SELECT * FROM raw_loan_balance")
oracle("source_exists", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, true AS found, true AS has_files, (SELECT count(*) FROM {t}) AS n"
    for t in ("customer", "orders", "lineitem", "part"))
    + " UNION ALL SELECT 'no_such_table', false, false, 0")
oracle("failed_version_removed",
       "SELECT LoanAccountBalanceId, SourceId + 1 AS SourceId, '[2]' AS removed FROM raw_loan_balance")
oracle("columns_without_identity", "SELECT * FROM clean_acc", ("clean_acc",))
oracle("sink_parquet_roundtrip", "SELECT * FROM raw_loan_balance")
oracle("month_partition_select",
       "SELECT *, 202506 AS yyyymm FROM clean_txn WHERE strftime(TransactionDate, '%Y%m') = '202506'",
       ("clean_txn",))

# --------------------------------------------------------------- star schema


def _dkey(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INT)"


def _from_key(k: str) -> str:
    return f"CAST(try_strptime(CAST({k} AS VARCHAR), '%Y%m%d') AS DATE)"


oracle("dim_date", f"""
SELECT {_dkey('d')} AS date_key, d AS full_date, CAST(year(d) AS INT) AS year,
  CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
  CAST(day(d) AS INT) AS day, CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayname(d) AS day_name,
  CAST(floor((dayofyear(d) + dayofweek(date_trunc('year', d)) + 1 - 2) / 7) + 1 AS INT) AS week_of_year,
  CAST(dayofweek(d) IN (0, 6) AS INT) AS is_weekend, 0 AS is_holiday
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT least(DATE '{CALENDAR_START}',
                         (SELECT min({_from_key('TransactionDateId')}) FROM conf_txn WHERE reject_reason = ''),
                         (SELECT min({_from_key('BalanceDateId')}) FROM conf_bal WHERE reject_reason = ''),
                         (SELECT min(OpenDate) FROM conf_acc WHERE reject_reason = '')) AS lo,
                   greatest(DATE '{CALENDAR_END}',
                         (SELECT max({_from_key('TransactionDateId')}) FROM conf_txn WHERE reject_reason = ''),
                         (SELECT max({_from_key('BalanceDateId')}) FROM conf_bal WHERE reject_reason = ''),
                         (SELECT max(OpenDate) FROM conf_acc WHERE reject_reason = '')) AS hi) b) g""", ("conf_txn", "conf_bal", "conf_acc"))


# Written out by hand, apart from the maps of the star module that they check.
ACCOUNT_COLUMNS = """LoanAccountId AS account_id, AccountNumber AS account_number, AccountCurrency AS currency_code,
  OrganizationId AS organization_id, ChannelID AS channel_id, BrokerId AS broker_id, Product AS product_name,
  OpenDate AS open_date, CancelledDate AS cancelled_date, ValueDate AS value_date, InvoiceDay AS invoice_day,
  TRY_CAST(CurrentInstallmentAmount AS DECIMAL(12,2)) AS current_installment_amount,
  TRY_CAST(CurrentInvoiceFee AS DECIMAL(12,2)) AS current_invoice_fee, NextInvoiceDate AS next_invoice_date,
  CalculatedMaturityDate AS calculated_maturity_date, IsActive AS is_active"""
ACCOUNT_TRACKED = ("account_number", "currency_code", "organization_id", "channel_id", "broker_id", "product_name",
                   "open_date", "cancelled_date", "value_date", "invoice_day", "current_installment_amount",
                   "current_invoice_fee", "next_invoice_date", "calculated_maturity_date", "is_active")
BALANCE_COLUMNS = """LoanAccountBalanceId AS balance_id, PrecedingId AS preceding_id, LoanAccountId AS account_id,
  AccountStatusId AS account_status_id, ProductId AS product_id, AccountCurrencyId AS currency_id,
  AccruedInterest AS accrued_interest_eur, AccruedInterestSEK AS accrued_interest_sek, Balance AS balance_eur,
  BalanceSek AS balance_sek, BalanceDate AS balance_date"""
TRANSACTION_COLUMNS = """LoanAccountTransactionId AS transaction_id, TransactionDate AS transaction_date,
  ValueDate AS value_date, EntryDate AS entry_date, LoanAccountId AS account_id,
  TransactionTypeId AS transaction_type_id, TransactionAmount AS transaction_amount,
  TransactionAmountSEK AS transaction_amount_sek, TransactionReference AS transaction_reference,
  TransactionCurrencyId AS currency_id, ExchangeRateId AS exchange_rate_id"""


def account_rows_sql(src: str) -> str:
    return f"SELECT {ACCOUNT_COLUMNS} FROM {src}"


def keyed(key: str, order: str, src: str) -> str:
    return f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {key}, * FROM ({src}) k"


def code_dim_sql(src: str, id_col: str, attrs: dict, id_name: str, key_name: str) -> str:
    if attrs:
        sel = ", ".join(f"{a} AS {b}" for a, b in attrs.items())
        order = ", ".join(f"{a} ASC NULLS FIRST" for a in attrs)
        inner = (f"SELECT {id_name}, {', '.join(attrs.values())} FROM ("
                 f"SELECT {id_col} AS {id_name}, {sel}, row_number() OVER (PARTITION BY {id_col} "
                 f"ORDER BY {order}) AS __rn FROM {src} WHERE {id_col} IS NOT NULL) x WHERE __rn = 1")
    else:
        inner = f"SELECT DISTINCT {id_col} AS {id_name} FROM {src} WHERE {id_col} IS NOT NULL"
    return keyed(key_name, id_name, inner)


step("dim_acc", keyed("account_key", "account_id", account_rows_sql("clean_acc")), ("clean_acc",))
step("dim_acc2", keyed("account_key", "account_id", account_rows_sql("clean_acc2")), ("clean_acc2",))
step("dim_org", code_dim_sql("clean_acc", "OrganizationId",
                             {"OrganizationName": "organization_name", "SourceId": "source_id"},
                             "organization_id", "organization_key"), ("clean_acc",))
step("dim_prod", code_dim_sql("clean_acc", "ProductId", {"Product": "product_name"},
                              "product_id", "product_key"), ("clean_acc",))
step("dim_cur", code_dim_sql("clean_acc", "AccountCurrencyId", {"AccountCurrency": "currency_code"},
                             "currency_id", "currency_key"), ("clean_acc",))
step("dim_ttype", code_dim_sql("clean_txn", "TransactionTypeId", {}, "transaction_type_id",
                               "transaction_type_key"), ("clean_txn",))


step("bal_rows", f"SELECT {BALANCE_COLUMNS} FROM clean_bal", ("clean_bal",))
step("txn_rows", f"SELECT {TRANSACTION_COLUMNS} FROM clean_txn", ("clean_txn",))
step("fact_bal", keyed("balance_key", "balance_id",
                       "SELECT * FROM bal_rows f WHERE EXISTS (SELECT 1 FROM dim_acc d "
                       "WHERE d.account_id = f.account_id)"), ("bal_rows", "dim_acc"))
step("fact_txn", keyed("transaction_key", "transaction_id",
                       "SELECT * FROM txn_rows f WHERE EXISTS (SELECT 1 FROM dim_acc d "
                       "WHERE d.account_id = f.account_id) AND EXISTS (SELECT 1 FROM dim_ttype t "
                       "WHERE t.transaction_type_id = f.transaction_type_id)"),
     ("txn_rows", "dim_acc", "dim_ttype"))

for _k, _s in (("dim_account", "dim_acc"), ("dim_organization", "dim_org"),
               ("dim_product", "dim_prod"), ("dim_currency", "dim_cur"),
               ("dim_transaction_type", "dim_ttype"), ("fact_balance", "fact_bal"),
               ("fact_transaction", "fact_txn")):
    oracle(_k, f"SELECT * FROM {_s}", (_s,))

oracle("fact_balance_joined", f"""
SELECT f.balance_key, f.balance_id, a.account_key, p.product_key, o.organization_key, c.currency_key,
  {_dkey('f.balance_date')} AS date_key, f.account_status_id, f.accrued_interest_eur,
  f.accrued_interest_sek, f.balance_eur, f.balance_sek, f.balance_date
FROM fact_bal f JOIN dim_acc a ON f.account_id = a.account_id
JOIN dim_prod p ON f.product_id = p.product_id
JOIN dim_org o ON a.organization_id = o.organization_id
JOIN dim_cur c ON f.currency_id = c.currency_id""",
       ("fact_bal", "dim_acc", "dim_prod", "dim_org", "dim_cur"))

oracle("orphan_balances", """
SELECT balance_id, 'account_id' AS missing_key, CAST(account_id AS BIGINT) AS key_value
FROM bal_rows f WHERE NOT EXISTS (SELECT 1 FROM dim_acc2 d WHERE d.account_id = f.account_id)""",
       ("bal_rows", "dim_acc2"))
oracle("orphan_transactions", """
SELECT transaction_id, 'account_id' AS missing_key, CAST(account_id AS BIGINT) AS key_value
FROM txn_rows f WHERE NOT EXISTS (SELECT 1 FROM dim_acc2 d WHERE d.account_id = f.account_id)
UNION ALL
SELECT transaction_id, 'transaction_type_id' AS missing_key, CAST(transaction_type_id AS BIGINT) AS key_value
FROM txn_rows f WHERE NOT EXISTS (SELECT 1 FROM dim_ttype t WHERE t.transaction_type_id = f.transaction_type_id)""",
       ("txn_rows", "dim_acc2", "dim_ttype"))

_TR = ACCOUNT_TRACKED
_SCD_EQ = " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in _TR)
step("scd_d1", account_rows_sql("clean_acc"), ("clean_acc",))
step("scd_d2", account_rows_sql("clean_acc2"), ("clean_acc2",))
step("scd_cls", f"""
SELECT coalesce(n.account_id, o.account_id) AS account_id,
  CASE WHEN o.account_id IS NULL THEN 'insert' WHEN n.account_id IS NULL THEN 'missing'
       WHEN {_SCD_EQ} THEN 'same' ELSE 'update' END AS change
FROM scd_d2 n FULL OUTER JOIN scd_d1 o ON n.account_id = o.account_id""", ("scd_d1", "scd_d2"))
oracle("dim_account_scd2", f"""
SELECT o.account_id, {', '.join('o.' + c for c in _TR)}, DATE '{DAY1_DATE_}' AS valid_from,
  CASE WHEN k.change = 'update' THEN CAST(DATE '{RUN_DATE}' - INTERVAL 1 DAY AS DATE) END AS valid_to,
  k.change <> 'update' AS is_current
FROM scd_d1 o JOIN scd_cls k ON o.account_id = k.account_id
UNION ALL
SELECT n.account_id, {', '.join('n.' + c for c in _TR)}, DATE '{RUN_DATE}' AS valid_from,
  CAST(NULL AS DATE) AS valid_to, true AS is_current
FROM scd_d2 n JOIN scd_cls k ON n.account_id = k.account_id WHERE k.change IN ('insert', 'update')""",
       ("scd_d1", "scd_d2", "scd_cls"))

step("history_seen", f"""
SELECT *, DATE '{DAY1_DATE_}' AS d FROM scd_d1 UNION ALL SELECT *, DATE '{RUN_DATE}' FROM scd_d2
UNION ALL SELECT * REPLACE (invoice_day + CASE WHEN account_id % 3 = 0 THEN 1 ELSE 0 END AS invoice_day), DATE '2025-06-08'
FROM scd_d1 WHERE account_id % 7 <> 3""", ("scd_d1", "scd_d2"))
oracle("account_history_late_delivery", f"""
SELECT account_id, {', '.join(_TR)}, d AS valid_from,
  CAST(lead(d) OVER w - INTERVAL 1 DAY AS DATE) AS valid_to, lead(d) OVER w IS NULL AS is_current
FROM (SELECT *, lag(x) OVER (PARTITION BY account_id ORDER BY d) AS before, row_number() OVER (PARTITION BY account_id ORDER BY d) AS n
      FROM (SELECT *, struct_pack({', '.join(f'{c} := {c}' for c in _TR)}) AS x FROM history_seen) a) b
WHERE n = 1 OR x IS DISTINCT FROM before WINDOW w AS (PARTITION BY account_id ORDER BY d)""", ("history_seen",))

# --------------------------------------------------------------- star publishing

step("cal", f"""
SELECT CAST(date_diff('day', least(DATE '{CALENDAR_START}', min(d)), greatest(DATE '{CALENDAR_END}', max(d))) + 1 AS BIGINT) AS n
FROM (SELECT BalanceDate AS d FROM clean_bal UNION ALL SELECT TransactionDate FROM clean_txn
      UNION ALL SELECT OpenDate FROM clean_acc) x""", ("clean_bal", "clean_txn", "clean_acc"))
_STAR = (("dim_date", "SELECT n FROM cal"), ("dim_account", "SELECT count(*) FROM dim_acc"),
         ("dim_organization", "SELECT count(*) FROM dim_org"), ("dim_product", "SELECT count(*) FROM dim_prod"),
         ("dim_currency", "SELECT count(*) FROM dim_cur"), ("dim_transaction_type", "SELECT count(*) FROM dim_ttype"),
         ("dim_account_history", "SELECT count(*) FROM dim_acc"), ("fact_balance", "SELECT count(*) FROM fact_bal"),
         ("fact_transaction", "SELECT count(*) FROM fact_txn"))
_STAR_USES = ("cal", "dim_acc", "dim_org", "dim_prod", "dim_cur", "dim_ttype", "fact_bal", "fact_txn")
_WAIT = "rows without dimension row kept for a later run"

_WAITING = "".join(
    f" UNION ALL SELECT '{fact}_orphans', 'warning', '{_WAIT}', n FROM (SELECT count(*) AS n FROM {rows} f WHERE NOT EXISTS "
    f"(SELECT 1 FROM dim_acc d WHERE d.account_id = f.account_id)) x WHERE n > 0"
    for fact, rows in (("fact_balance", "bal_rows"), ("fact_transaction", "txn_rows")))
oracle("star_first_load", " UNION ALL ".join(
    f"SELECT '{t}' AS step, 'ok' AS status, '{'versions published' if t.endswith('history') else 'first load'}' AS message, "
    f"CAST(({q}) AS BIGINT) AS row_count" for t, q in _STAR) + _WAITING, _STAR_USES)
oracle("star_rerun_is_noop", " UNION ALL ".join(
    f"SELECT '{t}' AS step, 'ok' AS status, 'no changes' AS message, CAST(0 AS BIGINT) AS row_count" for t, _ in _STAR)
       + _WAITING, _STAR_USES)


def _orphans_sql(fact: str, rows: str) -> str:
    """Loaded and waiting rows of two runs, the second one with every account and no facts."""
    has = lambda *dims: " OR ".join(f"EXISTS (SELECT 1 FROM {d} d WHERE d.account_id = f.account_id)" for d in dims)
    one, both = f"({has('dim_acc2')})", f"({has('dim_acc', 'dim_acc2')})"
    q = lambda cond: f"(SELECT count(*) FROM {rows} f WHERE {cond})"
    waits = f"SELECT {{run}} AS run, '{fact}_orphans' AS step, CASE WHEN n > 0 THEN 'warning' ELSE 'ok' END AS status, " \
            f"CASE WHEN n > 0 THEN '{_WAIT}' ELSE 'no rows waiting' END AS message, n AS row_count FROM (SELECT {{n}} AS n) x"
    return " UNION ALL ".join([
        f"SELECT 1 AS run, '{fact}' AS step, 'ok' AS status, 'first load' AS message, {q(one)} AS row_count",
        waits.format(run=1, n=q(f"NOT {one}")) + " WHERE n > 0",
        f"SELECT 2, '{fact}', 'ok', CASE WHEN n > 0 THEN 'changes merged' ELSE 'no changes' END, n "
        f"FROM (SELECT {q(f'NOT {one} AND {both}')} AS n) x",
        waits.format(run=2, n=q(f"NOT {both}")) + f" WHERE {q(f'NOT {one}')} > 0"])


oracle("star_orphans_retried", _orphans_sql("fact_balance", "bal_rows") + " UNION ALL "
       + _orphans_sql("fact_transaction", "txn_rows"), ("bal_rows", "txn_rows", "dim_acc", "dim_acc2"))
step("old_new", """
SELECT account_id, account_key FROM dim_acc
UNION ALL SELECT account_id, row_number() OVER (ORDER BY account_id) + (SELECT max(account_key) FROM dim_acc)
FROM scd_d2 WHERE account_id NOT IN (SELECT account_id FROM dim_acc)""", ("dim_acc", "scd_d2"))
step("versions", """
SELECT account_id, account_key AS version_key, 1 AS v FROM dim_acc
UNION ALL SELECT n.account_id, row_number() OVER (ORDER BY n.account_id) + (SELECT max(account_key) FROM dim_acc), 2
FROM scd_d2 n JOIN scd_cls k ON n.account_id = k.account_id WHERE k.change IN ('insert', 'update')""",
     ("dim_acc", "scd_d2", "scd_cls"))
oracle("star_second_delivery_keys_stable", """
SELECT CAST(o.account_key AS BIGINT) AS account_key, o.account_id, count(*) AS versions,
  CAST(min(v.version_key) AS BIGINT) AS first_version, CAST(max(v.version_key) AS BIGINT) AS last_version
FROM old_new o JOIN versions v ON o.account_id = v.account_id GROUP BY 1, 2""", ("old_new", "versions"))
oracle("fact_balance_versions", f"""
SELECT f.balance_id, f.account_id, f.balance_date,
  CASE WHEN k.change = 'insert' OR (f.balance_date >= DATE '{RUN_DATE}' AND k.change = 'update')
       THEN DATE '{RUN_DATE}' ELSE DATE '{DAY1_DATE_}' END AS valid_from
FROM bal_rows f JOIN scd_cls k ON f.account_id = k.account_id""", ("bal_rows", "scd_cls"))

# --------------------------------------------------------------- marts and reports

step("last_bal", """
SELECT *, lead(m) OVER (PARTITION BY account_id ORDER BY m) AS nxt
FROM (SELECT account_id, product_id, currency_id, balance_eur, year(balance_date) * 12 + month(balance_date) - 1 AS m,
        row_number() OVER (PARTITION BY account_id, year(balance_date) * 12 + month(balance_date)
                           ORDER BY balance_date DESC, balance_id DESC) AS rn
      FROM fact_bal WHERE balance_date IS NOT NULL) x WHERE rn = 1""", ("fact_bal",))
oracle("mart_balance_by_month", """
SELECT month, product_name, currency_code, count(DISTINCT account_id) AS accounts,
  CAST(sum(balance) AS DECIMAL(18,2)) AS balance,
  CAST(GROUPING(month, product_name, currency_code) AS INT) AS rollup_level
FROM (SELECT CAST(f.m // 12 * 100 + f.m % 12 + 1 AS INT) AS month,
        p.product_name, c.currency_code, f.account_id, f.balance_eur AS balance
      FROM last_bal f JOIN dim_prod p ON f.product_id = p.product_id
      JOIN dim_cur c ON f.currency_id = c.currency_id) x
GROUP BY ROLLUP (month, product_name, currency_code)""", ("last_bal", "dim_prod", "dim_cur"))

# Every account in every month from its first balance on.
oracle("mart_month_end_balance", """
SELECT month, product_name, currency_code, count(*) AS accounts, CAST(sum(balance_eur) AS DECIMAL(18,2)) AS balance,
  CAST(GROUPING(month, product_name, currency_code) AS INT) AS rollup_level
FROM (SELECT CAST(g.m // 12 * 100 + g.m % 12 + 1 AS INT) AS month, p.product_name, c.currency_code, g.balance_eur
      FROM (SELECT * EXCLUDE (m), unnest(range(m, coalesce(nxt, (SELECT max(m) FROM last_bal) + 1))) AS m FROM last_bal) g
      JOIN dim_prod p ON g.product_id = p.product_id JOIN dim_cur c ON g.currency_id = c.currency_id) x
GROUP BY GROUPING SETS ((month, product_name, currency_code), (month, product_name), (month))""", ("last_bal", "dim_prod", "dim_cur"))

oracle("mart_transactions_by_type", """
SELECT CAST(year(transaction_date) * 100 + month(transaction_date) AS INT) AS month,
  transaction_type_id, count(*) AS transactions, CAST(sum(transaction_amount) AS DECIMAL(18,2)) AS amount
FROM fact_txn GROUP BY 1, 2""", ("fact_txn",))

step("raw_txn_2", """
SELECT * REPLACE (CASE WHEN LoanAccountTransactionId % 100 = 1 THEN '777,70' ELSE TransactionAmount END AS TransactionAmount,
  CASE WHEN LoanAccountTransactionId % 100 = 2 THEN TransactionTypeId + 1000 ELSE TransactionTypeId END AS TransactionTypeId,
  CASE WHEN LoanAccountTransactionId % 100 = 3 THEN 20601231 ELSE TransactionDateId END AS TransactionDateId)
FROM raw_loan_transaction""")
step("conf_txn_2", conform_sql(TRANSACTION, "raw_txn_2"), ("raw_txn_2",))
step("clean_txn_2", clean_sql(TRANSACTION, "conf_txn_2"), ("conf_txn_2",))
step("txn_states", """
SELECT 1 AS delivery, * FROM clean_txn WHERE LoanAccountTransactionId % 50 <> 7
UNION ALL SELECT 2, * FROM clean_txn_2
UNION ALL SELECT 3, * FROM clean_txn WHERE LoanAccountTransactionId % 100 <> 3
UNION ALL SELECT 3, * FROM clean_txn_2 WHERE LoanAccountTransactionId % 100 = 3
  OR LoanAccountTransactionId NOT IN (SELECT LoanAccountTransactionId FROM clean_txn)""", ("clean_txn", "clean_txn_2"))
oracle("mart_kept_by_changes", """
SELECT CAST(delivery AS INT) AS delivery, CAST(year(TransactionDate) * 100 + month(TransactionDate) AS INT) AS month,
  TransactionTypeId AS transaction_type_id, count(DISTINCT LoanAccountId) AS accounts, count(*) AS transactions,
  CAST(sum(TransactionAmount) AS DECIMAL(18,2)) AS amount
FROM txn_states GROUP BY 1, 2, 3""", ("txn_states",))
_CHANGED = ("TransactionDate", "TransactionTypeId", "TransactionAmount")
oracle("changed_transactions", f"""
SELECT n.LoanAccountTransactionId, {', '.join(f'o.{c} AS before_{c}' for c in _CHANGED)},
  {', '.join(f'n.{c} AS after_{c}' for c in _CHANGED)}
FROM (FROM txn_states WHERE delivery = 2) n LEFT JOIN (FROM txn_states WHERE delivery = 1) o
  ON n.LoanAccountTransactionId = o.LoanAccountTransactionId
WHERE o.LoanAccountTransactionId IS NULL OR {' OR '.join(f'n.{c} IS DISTINCT FROM o.{c}' for c in _CHANGED)}""", ("txn_states",))

oracle("latest_transactions_top10", """
SELECT LoanAccountTransactionId, TransactionDate, LoanAccountId, TransactionAmount
FROM clean_txn ORDER BY LoanAccountTransactionId DESC LIMIT 10""", ("clean_txn",))

_PROFILE_COLS = ACCOUNT.business_cols + ACCOUNT.computed_cols
oracle("profile_accounts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM clean_acc"
    for c in _PROFILE_COLS), ("clean_acc",))

_NUMERIC = [f.name for f in BALANCE.schema.fields
            if f.name in BALANCE.amount_cols or f.dataType.typeName() in ("integer", "long")]
oracle("profile_numeric_balances", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS deviation, "
    + ", ".join(f"(SELECT CAST({c} AS DOUBLE) FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS n "
                f"FROM clean_bal WHERE {c} IS NOT NULL) q WHERE rn = CAST(ceil({p} * n) AS BIGINT)) AS {name}"
                for name, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))) + " FROM clean_bal"
    for c in _NUMERIC), ("clean_bal",))

step("unmatched", "SELECT RecordID FROM staged s WHERE NOT EXISTS "
                  "(SELECT 1 FROM estimates e WHERE e.RecordID = s.RecordID)", ("staged", "estimates"))
oracle("run_log", """
SELECT 'source_check' AS step, CASE WHEN n > 0 THEN 'ok' ELSE 'error' END AS status,
  CASE WHEN n > 0 THEN 'CarInformation found' ELSE 'CarInformation is empty' END AS message,
  n AS row_count, 'CarInformation' AS output_name FROM (SELECT count(*) AS n FROM car_information) a
UNION ALL
SELECT 'rate_lookup', CASE WHEN n = 0 THEN 'error' WHEN fb = 1 THEN 'warning' ELSE 'ok' END,
  CASE WHEN n = 0 THEN 'no interest rate on or before the run date'
       ELSE 'base rate ' || CAST(rate AS VARCHAR) || ' effective ' || CAST(eff AS VARCHAR)
            || CASE WHEN fb = 1 THEN ' (run month missing, latest earlier rate used)' ELSE '' END END,
  n, 'InterestRates'
FROM (SELECT count(*) AS n, max(BaseInterestRate) AS rate, max(EffectiveDate) AS eff,
             max(CAST(is_fallback AS INT)) AS fb FROM rate) b
UNION ALL
SELECT 'staging', 'ok', 'cars passing required-field and price checks', count(*), 'staging' FROM staged
UNION ALL
SELECT 'estimates', CASE WHEN count(*) > 0 THEN 'ok' ELSE 'warning' END, 'rows written for 2025-06',
  count(*), 'LoanProfitEstimates_202506' FROM estimates
UNION ALL
SELECT 'unmatched_cars', CASE WHEN count(*) > 0 THEN 'warning' ELSE 'ok' END,
  'staged cars without margin, risk tier or depreciation band', count(*), 'LoanProfitEstimates_202506'
FROM unmatched""", ("staged", "rate", "estimates", "unmatched"))

# The estimates of two months with the same cars.
oracle("publish_profit_month", """
SELECT * FROM estimates
UNION ALL
SELECT RecordID, CarModel, EnergyClass, ManufactureYear, BasePrice, CustomerRiskTier, FinalInterestRate,
  EstimatedMonthlyPayment, DepreciatedValue, EstimatedProfit, DATE '2025-05-01' AS FileMonth
FROM estimates""", ("estimates",))
