"""Named queries over the fixture tables derived from one scale-factor folder.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
work grows with the driver tables.  Column names match ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.fixtures import RUN_DATE, Fixtures
from lendstar.operators import lookup, profit
from lendstar.session import stored, work_path

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


# --------------------------------------------------------------- profit

def _staged(fx: Fixtures) -> DataFrame:
    return profit.stage_cars(fx.cars, RUN_DATE)


@query
def car_staging(spark, sf_dir):
    return _staged(_fx(spark, sf_dir))


@query
def energy_margin_join(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    j = profit.attach_margins(_staged(fx), fx.energy_class_margin, fx.credit_risk_tier)
    return j.select("RecordID", "MarginRate", "RiskAdjustment")


@query
def depreciation_band_join(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    j = profit.attach_depreciation(_staged(fx), fx.depreciation_rates)
    return j.select("RecordID", F.col("age").cast("int").alias("age"), "DepreciationRate")


@query
def rate_asof(spark, sf_dir):
    """The base rate valid at the run date attached to every staged car."""
    fx = _fx(spark, sf_dir)
    rate = profit.rate_at(fx.interest_rates, RUN_DATE)
    r = rate.select(F.struct(*rate.columns)).scalar()
    return (_staged(fx).select("RecordID", *[r.getField(c).alias(c) for c in rate.columns])
            .filter(F.col("EffectiveDate").isNotNull()))


@query
def rate_asof_by_month(spark, sf_dir):
    """Rate valid at the month of each account's next invoice (many dates)."""
    fx = _fx(spark, sf_dir)
    acc = fx.acc.select("LoanAccountId", "OpenDateId",
                        F.trunc("NextInvoiceDate", "month").alias("rate_month"))
    out = lookup.asof_lookup(acc, "rate_month", fx.interest_rates,
                             "EffectiveDate", "BaseInterestRate")
    return out.select("LoanAccountId", "OpenDateId", "rate_month", "EffectiveDate",
                      "BaseInterestRate")


@query
def depreciation_band_edges(spark, sf_dir):
    """Bands with NULL and decimal bounds: a NULL bound matches nothing."""
    bands = spark.sql("SELECT * FROM VALUES (CAST(NULL AS DECIMAL(4,2)), 9.00BD, 0.5D), (0.50BD, 2.25BD, 0.2D), "
                      "(2.00BD, NULL, 0.3D), (2.25BD, 9.00BD, 0.1D) AS t(lo, hi, rate)")
    age = (F.year("FileMonth") - F.col("ManufactureYear") + F.lit(0.25)).cast("double")
    return lookup.band_join(_staged(_fx(spark, sf_dir)), age, bands, "lo", "hi", value_name="age").select(
        "RecordID", "age", "rate")


@query
def band_join_wide(spark, sf_dir):
    """Bands of balances over billions of cells, overlapping, decimal, open and reversed."""
    bands = spark.sql("SELECT * FROM VALUES (0BD, 3000000000BD, 1), (-3000000000BD, 99.995BD, 2), (1000.5BD, 1000.5BD, 3), "
                      "(2500.25BD, 250000.75BD, 4), (9BD, 1BD, 5), (NULL, 5BD, 6), (5BD, NULL, 7) AS t(lo, hi, band)")
    bal = cleanse.clean(_fx(spark, sf_dir).bal, BALANCE).select("LoanAccountBalanceId", "Balance")
    return lookup.band_join(bal, F.col("Balance"), bands, "lo", "hi").select("LoanAccountBalanceId", "Balance", "band")


@query
def rate_asof_null_dates(spark, sf_dir):
    """A rate without a date is never used; an account without a month gets none."""
    fx = _fx(spark, sf_dir)
    rates = fx.interest_rates.unionByName(spark.sql("SELECT CAST(NULL AS DATE) AS EffectiveDate, 9.9D AS BaseInterestRate"))
    acc = fx.acc.select("LoanAccountId", "OpenDateId", F.expr(
        "CASE WHEN LoanAccountId % 9 <> 0 THEN add_months(DATE'2025-01-15', CAST(LoanAccountId % 8 AS INT)) END").alias("d"))
    return lookup.asof_lookup(acc, "d", rates, "EffectiveDate", "BaseInterestRate")


@query
def loan_profit_estimates(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return profit.estimate_profits(fx.cars, fx.interest_rates, fx.energy_class_margin,
                                   fx.credit_risk_tier, fx.depreciation_rates, RUN_DATE)


# --------------------------------------------------------------- cleansing

from lendstar.fixtures import DAY1_DATE, DAY1_TS, DAY2_TS  # noqa: E402
from lendstar.functions.audit import with_audit  # noqa: E402
from lendstar.functions.decimals import european_decimal as _eu  # noqa: E402
from lendstar.operators import changes, cleanse, keys, upsert  # noqa: E402
from lendstar.plans import kept, pipeline  # noqa: E402
from lendstar.sources import files, versioned  # noqa: E402
from lendstar.specs import ACCOUNT, AUDIT_COLS, BALANCE, TRANSACTION  # noqa: E402

RAW = {"account": "raw_loan_account", "balance": "raw_loan_balance",
       "transaction": "raw_loan_transaction"}
SPEC = {"account": ACCOUNT, "balance": BALANCE, "transaction": TRANSACTION}


def _clean(fx: Fixtures, table: str, day2: bool = False) -> DataFrame:
    src = fx.acc2 if day2 else fx.get(RAW[table])
    return cleanse.clean(src, SPEC[table])


def _clean_shared(fx: Fixtures, table: str, day2: bool = False) -> DataFrame:
    """The cleansed table written once as parquet to the shared folder when
    several parts of one query read it, as the published cleansed table would
    be; later reads scan it (columnar, pruned) instead of re-cleansing."""
    k = ("clean", table, day2)
    if k not in fx._cache:
        fx._cache[k] = stored(_clean(fx, table, day2), f"cleansed/{SPEC[table].name}")
    return fx._cache[k]


@query
def european_decimal(spark, sf_dir):
    acc = _fx(spark, sf_dir).acc
    return acc.select("LoanAccountId", "OpenDateId",
                      _eu("CurrentInstallmentAmount").alias("CurrentInstallmentAmount"),
                      _eu("CurrentInvoiceFee").alias("CurrentInvoiceFee"))


@query
def reject_amounts(spark, sf_dir):
    return cleanse.unparseable_amounts(_fx(spark, sf_dir).acc, ACCOUNT)


@query
def conform_accounts(spark, sf_dir):
    return cleanse.accepted(_fx(spark, sf_dir).acc, ACCOUNT)


@query
def reject_accounts(spark, sf_dir):
    return cleanse.rejected(_fx(spark, sf_dir).acc, ACCOUNT)


@query
def reject_balances(spark, sf_dir):
    return cleanse.rejected(_fx(spark, sf_dir).bal, BALANCE)


@query
def reject_transactions(spark, sf_dir):
    return cleanse.rejected(_fx(spark, sf_dir).txn, TRANSACTION)


@query
def clean_accounts(spark, sf_dir):
    return _clean(_fx(spark, sf_dir), "account")


@query
def clean_balances(spark, sf_dir):
    return _clean(_fx(spark, sf_dir), "balance")


@query
def clean_transactions(spark, sf_dir):
    return _clean(_fx(spark, sf_dir), "transaction")


@query
def dedup_accounts(spark, sf_dir):
    return _clean(_fx(spark, sf_dir), "account").select("LoanAccountId", "OpenDateId", "OpenDate")


@query
def dedup_balances(spark, sf_dir):
    return _clean(_fx(spark, sf_dir), "balance").select(
        "LoanAccountBalanceId", "BalanceDateId", "LoanAccountId")


@query
def dedup_transactions(spark, sf_dir):
    return _clean(_fx(spark, sf_dir), "transaction").select(
        "LoanAccountTransactionId", "TransactionDateId", "TransactionReference")


@query
def duplicate_keys(spark, sf_dir):
    return cleanse.duplicate_keys(_fx(spark, sf_dir).txn, "LoanAccountTransactionId")


@query
def audit_columns(spark, sf_dir):
    c = _clean(_fx(spark, sf_dir), "account").select("LoanAccountId")
    return with_audit(c, DAY1_TS)


# --------------------------------------------------------------- identity

def _snapshot(fx: Fixtures, table: str = "account") -> DataFrame:
    """Day-1 cleansed table with identities and audit columns."""
    spec = SPEC[table]
    c = _clean(fx, table)
    return with_audit(keys.assign_dense_identity(c, spec.key, spec.identity_col), DAY1_TS)


@query
def identity_initial(spark, sf_dir):
    c = _clean(_fx(spark, sf_dir), "balance").select(BALANCE.key)
    return keys.assign_dense_identity(c, BALANCE.key, BALANCE.identity_col)


@query
def max_identity(spark, sf_dir):
    """Largest identity of a merged snapshot, whose identities have gaps."""
    merged = upsert_snapshot(spark, sf_dir)
    return keys.max_identity(merged, ACCOUNT.identity_col).select(F.lit(ACCOUNT.name).alias("table_name"), "max_id")


@query
def key_range(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    parts = [keys.key_range(_clean(fx, t), SPEC[t].key).select(
        F.lit(SPEC[t].name).alias("table_name"), "min_key", "max_key")
        for t in ("account", "balance", "transaction")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def row_counts(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    parts = []
    for t in ("account", "balance", "transaction"):
        spec = SPEC[t]
        conf = cleanse.conform(fx.get(RAW[t]), spec)
        stats = conf.agg(
            F.count(F.lit(1)).alias("raw_rows"),
            F.count(F.when(F.col(cleanse.REASON) == "", 1)).alias("accepted_rows"),
            F.count(F.when(F.col(cleanse.REASON) != "", 1)).alias("rejected_rows"))
        clean_n = _clean(fx, t).agg(F.count(F.lit(1)).alias("clean_rows"))
        parts.append(stats.select(F.lit(spec.name).alias("table_name"), "*",
                                  clean_n.scalar().alias("clean_rows")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --------------------------------------------------------------- changes & upserts

ACC_BIZ = ACCOUNT.business_cols


@query
def identity_increment(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    old = _snapshot(fx)
    fresh = changes.new_keys(_clean(fx, "account", day2=True), old, ACCOUNT.key)
    out = keys.assign_dense_identity(fresh, ACCOUNT.key, ACCOUNT.identity_col,
                                     base=keys.max_identity(old, ACCOUNT.identity_col))
    return out.select(ACCOUNT.identity_col, ACCOUNT.key)


@query
def detect_new_keys(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return changes.new_keys(_clean(fx, "account", day2=True), _clean(fx, "account"), ACCOUNT.key)


@query
def changed_rows_exceptall(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return changes.changed_rows_except_all(_clean(fx, "account", day2=True),
                                           _clean(fx, "account"), ACC_BIZ)


def _classified(fx: Fixtures) -> DataFrame:
    return changes.classify(_clean(fx, "account", day2=True), _clean(fx, "account"),
                            ACCOUNT.key, ACC_BIZ)


@query
def detect_changes(spark, sf_dir):
    return _classified(_fx(spark, sf_dir)).select(ACCOUNT.key, changes.CHANGE)


@query
def change_counts(spark, sf_dir):
    return changes.change_counts(_classified(_fx(spark, sf_dir)))


@query
def upsert_snapshot(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return upsert.upsert_snapshot(_snapshot(fx), _clean(fx, "account", day2=True),
                                  ACCOUNT.key, ACCOUNT.identity_col, ACC_BIZ)


@query
def merge_upsert(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return upsert.merge_upsert(_snapshot(fx), _clean(fx, "account", day2=True),
                               ACCOUNT.key, ACCOUNT.identity_col, ACC_BIZ, DAY2_TS)


@query
def append_changes(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return upsert.append_changes(_snapshot(fx), _clean(fx, "account", day2=True),
                                 ACCOUNT.key, ACCOUNT.identity_col, ACC_BIZ)


@query
def rerun_is_noop(spark, sf_dir):
    """The same file delivered twice through the pipeline: one version, no change."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "rerun", ACCOUNT.name)
    pipeline.run_table_etl(fx.acc, ACCOUNT, base, DAY1_TS)
    again = pipeline.run_table_etl(fx.acc, ACCOUNT, base, DAY2_TS)
    return versioned.read_current(spark, base).agg(
        F.lit(versioned.current_version(spark, base)).cast("long").alias("versions"),
        F.lit(again["row_count"]).cast("long").alias("changed_rows"), F.count(F.lit(1)).alias("unchanged_rows"))


@query
def upsert_changed_buckets(spark, sf_dir):
    """A second delivery with one changed row in a hundred: the merged table, and
    how many of its buckets were written anew."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "buckets", ACCOUNT.name)
    pipeline.run_table_etl(fx.acc, ACCOUNT, base, DAY1_TS)
    amount = F.when(F.col("LoanAccountId") % 100 == 1, "777,70").otherwise(F.col("CurrentInstallmentAmount"))
    done = pipeline.run_table_etl(fx.acc.withColumn("CurrentInstallmentAmount", amount), ACCOUNT, base, DAY2_TS)
    return versioned.read_current(spark, base).select(
        ACCOUNT.identity_col, "LoanAccountId", "CurrentInstallmentAmount", "CreatedDate", "UpdatedDate",
        F.lit(done["row_count"]).cast("long").alias("changed_rows"), F.lit(done["buckets"]).cast("long").alias("written_buckets"))


@query
def late_delivery_merge(spark, sf_dir):
    """Newer rows delivered first, the older ones later: as if delivered at once."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "late", ACCOUNT.name)
    newer = F.col("OpenDateId") >= (2018 + F.col("LoanAccountId") % 7) * 10000
    pipeline.run_table_etl(fx.acc.filter(newer), ACCOUNT, base, DAY1_TS)
    pipeline.run_table_etl(fx.acc.filter(~newer), ACCOUNT, base, DAY2_TS)
    return versioned.read_current(spark, base).select("LoanAccountId", "OpenDateId", "OpenDate", ACCOUNT.identity_col)


@query
def table_pipeline_log(spark, sf_dir):
    """Every raw table through the pipeline; raw = accepted + rejected."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "cleansed")
    log = pipeline.run_all(spark, {t: (fx.get(RAW[t]), SPEC[t], f"{base}/{SPEC[t].name}") for t in SPEC}, DAY1_TS, base)
    return log.drop("output_name")


@query
def stream_deliveries(spark, sf_dir):
    """Two days of delivery files picked up by the stream, a file per batch."""
    from lendstar.streaming import ingest_deliveries
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "stream")
    for name, df in (("day1", fx.acc), ("day2", fx.acc2)):
        files.write_delimited(df, f"{base}/incoming/{name}")
    ingest_deliveries(spark, f"{base}/incoming/*", ACCOUNT, f"{base}/{ACCOUNT.name}", DAY1_TS,
                      checkpoint=f"{base}/checkpoint", max_files_per_batch=1)
    return versioned.read_current(spark, f"{base}/{ACCOUNT.name}").select("LoanAccountId", "OpenDateId")


# --------------------------------------------------------------- sources and sinks

from lendstar.functions.dates import date_from_key  # noqa: E402
from lendstar.specs import TRANSACTION_SCHEMA  # noqa: E402

RUN_MONTH = 202506


@query
def scan_csv_roundtrip(spark, sf_dir):
    """Raw transactions written as a ';' delivery file, read back with the declared schema."""
    path = work_path(spark, "csv", "Raw_Loan_Transaction")
    files.write_delimited(_fx(spark, sf_dir).txn, path)
    good, _bad = files.split_corrupt(files.read_delimited(spark, path, TRANSACTION_SCHEMA))
    return good


@query
def scan_csv_layouts(spark, sf_dir):
    """Raw transactions in files of three layouts (declared order; reversed; one column
    left out and one added): one table, by the names in the headers."""
    txn = _fx(spark, sf_dir).txn
    path, third = work_path(spark, "csv", "layouts"), F.col("LoanAccountTransactionId") % 3
    files.write_delimited(txn.filter(third == 0), f"{path}/declared")
    files.write_delimited(txn.filter(third == 1).select(*reversed(txn.columns)), f"{path}/reversed")
    files.write_delimited(txn.filter(third == 2).drop("TransactionReference").withColumn("Remark", F.lit("x")), f"{path}/other")
    good, _bad = files.split_corrupt(files.read_delimited(spark, f"{path}/*", TRANSACTION_SCHEMA))
    return good


@query
def scan_csv_inferred(spark, sf_dir):
    """Raw balances written as a ';' file and read back with inferred types."""
    path = work_path(spark, "csv", "Raw_Loan_Balance")
    cols = ["LoanAccountBalanceId", "LoanAccountId", "BalanceDateId", "Balance"]
    files.write_delimited(_fx(spark, sf_dir).bal.select(*cols), path)
    df = files.read_delimited(spark, path)
    return df.select(*[F.col(c).cast("string" if c == "Balance" else "long").alias(c) for c in cols])


@query
def source_fallback(spark, sf_dir):
    """The first source that is there: a missing folder, then the stored delivery."""
    base = work_path(spark, "fallback")
    versioned.publish(_fx(spark, sf_dir).bal, f"{base}/parquet")
    return pipeline.delivery(spark, f"{base}/database", f"{base}/parquet/v=1")


@query
def source_exists(spark, sf_dir):
    """Existence checks of the delivered tables, and of one that isn't delivered."""
    rows = []
    for t in ("customer", "orders", "lineitem", "part", "no_such_table"):
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        df = files.read_parquet(spark, path)
        counted = spark.range(0).agg(F.count("id").alias("n")) if df is None else df.agg(F.count(F.lit(1)).alias("n"))
        rows.append(counted.select(F.lit(t).alias("table_name"), F.lit(files.exists(spark, path)).alias("found"),
                                   F.lit(files.has_data_files(spark, path)).alias("has_files"), "n"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query
def failed_version_removed(spark, sf_dir):
    """A version whose write never committed is passed over and removed."""
    base = work_path(spark, "versions", "Raw_Loan_Balance")
    bal = _fx(spark, sf_dir).bal
    versioned.publish(bal, base)
    bal.limit(10).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/v=2")
    versioned.publish(bal.withColumn("SourceId", F.col("SourceId") + 1), base)
    gone = versioned.remove_failed(spark, base)
    return versioned.read_current(spark, base).select("LoanAccountBalanceId", "SourceId", F.lit(str(gone)).alias("removed"))


@query
def columns_without_identity(spark, sf_dir):
    """What a database sink gets: no identity column, the database assigns its own."""
    snap = _snapshot(_fx(spark, sf_dir)).drop(*AUDIT_COLS)
    return files.drop_columns_like(snap, "IdentityId")


@query
def scan_parquet(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir.rstrip('/')}/orders.parquet")


@query
def sink_parquet_roundtrip(spark, sf_dir):
    """Raw balances published as a new version of a dataset, read back as current."""
    base = work_path(spark, "versioned", "Raw_Loan_Balance")
    versioned.publish(_fx(spark, sf_dir).bal, base)
    return versioned.read_current(spark, base)


@query
def month_partition_select(spark, sf_dir):
    """Cleansed transactions stored by yyyymm; one month read back (partition pruning)."""
    path = work_path(spark, "by_month", "Loan_Transaction_cleansed")
    versioned.write_by_month(_clean(_fx(spark, sf_dir), "transaction"), path, "TransactionDate")
    return versioned.read_month(spark, path, RUN_MONTH)


# --------------------------------------------------------------- star schema

from lendstar.fixtures import CALENDAR_END, CALENDAR_START  # noqa: E402
from lendstar.operators import marts, star  # noqa: E402


@query
def dim_date(spark, sf_dir):
    """Calendar over the warehouse span, widened to every date the deliveries carry.

    Only rows dated outside the span can widen it, so no others are cleansed."""
    fx = _fx(spark, sf_dir)
    dated = (("transaction", date_from_key("TransactionDateId")), ("balance", date_from_key("BalanceDateId")),
             ("account", F.col("OpenDate")))
    span = [F.lit(d).cast("date") for d in (CALENDAR_START, CALENDAR_END)]
    dates = [cleanse.accepted(fx.get(RAW[t]).filter(~d.between(*span)), SPEC[t]).select(d.alias("d")) for t, d in dated]
    every = dates[0].unionByName(dates[1]).unionByName(dates[2])
    lo, hi = star.calendar_bounds((every, "d"), start=CALENDAR_START, end=CALENDAR_END, within=star.CALENDAR_LIMITS)
    return star.date_dimension(spark, lo, hi)


def _dims(fx: Fixtures) -> dict:
    acc = _clean_shared(fx, "account")
    return {"account": star.dim_account(acc), "organization": star.dim_organization(acc),
            "product": star.dim_product(acc), "currency": star.dim_currency(acc)}


@query
def dim_account(spark, sf_dir):
    return star.dim_account(_clean(_fx(spark, sf_dir), "account"))


@query
def dim_organization(spark, sf_dir):
    return star.dim_organization(_clean(_fx(spark, sf_dir), "account"))


@query
def dim_product(spark, sf_dir):
    return star.dim_product(_clean(_fx(spark, sf_dir), "account"))


@query
def dim_currency(spark, sf_dir):
    return star.dim_currency(_clean(_fx(spark, sf_dir), "account"))


@query
def dim_transaction_type(spark, sf_dir):
    return star.dim_transaction_type(_clean(_fx(spark, sf_dir), "transaction"))


@query
def fact_balance(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return star.fact_balance(_clean(fx, "balance"), star.account_ids(_clean(fx, "account")))


@query
def fact_transaction(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return star.fact_transaction(_clean(fx, "transaction"), star.account_ids(_clean(fx, "account")))


@query
def fact_balance_joined(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    d = _dims(fx)
    fb = star.fact_balance(_clean(fx, "balance"), star.account_ids(_clean_shared(fx, "account")))
    return star.balance_star(fb, d["account"], d["product"], d["organization"], d["currency"])


def _day2_accounts(fx: Fixtures) -> DataFrame:
    """Account keys of the day-2 delivery (some accounts dropped)."""
    return star.account_ids(_clean(fx, "account", day2=True))


@query
def orphan_balances(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return star.balance_orphans(_clean(fx, "balance"), _day2_accounts(fx))


@query
def orphan_transactions(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return star.transaction_orphans(_clean_shared(fx, "transaction"), _day2_accounts(fx))


SCD_TRACKED = [c for c in star.ACCOUNT_DIM_COLUMNS if c != "account_id"]


@query
def dim_account_scd2(spark, sf_dir):
    """Account history: day-1 rows, then the day-2 delivery closes changed rows."""
    fx = _fx(spark, sf_dir)
    day1 = upsert.scd2_initial(star.account_rows(_clean(fx, "account")), "account_id",
                               SCD_TRACKED, DAY1_DATE)
    day2 = star.account_rows(_clean(fx, "account", day2=True))
    return upsert.scd2_apply(day1, day2, "account_id", SCD_TRACKED, RUN_DATE)


@query
def account_history_late_delivery(spark, sf_dir):
    """Three deliveries, the middle one last: the history as if they came in order."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "history")
    first, last = (star.account_rows(_clean_shared(fx, "account", day2)) for day2 in (False, True))
    middle = first.filter("account_id % 7 <> 3").withColumn(
        "invoice_day", (F.col("invoice_day") + (F.col("account_id") % 3 == 0).cast("int")).cast(first.schema["invoice_day"].dataType))
    for rows, day in ((first, DAY1_DATE), (last, RUN_DATE), (middle, "2025-06-08")):
        pipeline.update_account_history(rows, base, day)
    return versioned.read_current(spark, base).drop("version_key")


# --------------------------------------------------------------- marts, reports

@query
def mart_balance_by_month(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    acc = _clean_shared(fx, "account")
    rows = star.balance_rows(_clean(fx, "balance"), star.account_ids(acc))
    return marts.balance_by_month(rows, star.dim_product(acc, keyed=False),
                                  star.dim_currency(acc, keyed=False))


@query
def mart_month_end_balance(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    acc = _clean_shared(fx, "account")
    rows = star.balance_rows(_clean(fx, "balance"), star.account_ids(acc))
    return marts.month_end_balance(rows, star.dim_product(acc, keyed=False), star.dim_currency(acc, keyed=False))


@query
def mart_transactions_by_type(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    rows = star.transaction_rows(_clean(fx, "transaction"), star.account_ids(_clean(fx, "account")))
    return marts.transactions_by_type(rows)


def _transaction_deliveries(fx: Fixtures) -> list[DataFrame]:
    """New rows, other amounts, types and dates in the second delivery; the third is
    the table as it is, where rows that the second dated later stay."""
    key = F.col("LoanAccountTransactionId")
    second = (fx.txn.withColumn("TransactionAmount", F.when(key % 100 == 1, "777,70").otherwise(F.col("TransactionAmount")))
              .withColumn("TransactionTypeId", F.when(key % 100 == 2, F.col("TransactionTypeId") + 1000)
                          .otherwise(F.col("TransactionTypeId")).cast(fx.txn.schema["TransactionTypeId"].dataType))
              .withColumn("TransactionDateId", F.when(key % 100 == 3, 20601231).otherwise(F.col("TransactionDateId"))))
    return [fx.txn.filter(key % 50 != 7), second, fx.txn]


@query
def mart_kept_by_changes(spark, sf_dir):
    """The transactions mart, adjusted by each of three deliveries."""
    fx = _fx(spark, sf_dir)
    base, mart = work_path(spark, "deliveries", TRANSACTION.name), work_path(spark, "kept")
    out = []
    for i, delivery in enumerate(_transaction_deliveries(fx), 1):
        pipeline.run_table_etl(delivery, TRANSACTION, base, DAY1_TS)
        kept.keep_transactions_by_type(spark, base, mart)
        totals = versioned.read_current(spark, f"{mart}/totals")
        out.append(totals.select(F.lit(i).alias("delivery"), "month", "transaction_type_id", "accounts", "transactions",
                                 F.col("amount").cast(marts.MONEY).alias("amount")))
        for table in (base, f"{mart}/cells"):  # the totals stand for the current version, the next run starts from it
            versioned.retire(spark, table, 1)
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def changed_transactions(spark, sf_dir):
    """Rows that the second delivery changed, as they were and as they are."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "deliveries", TRANSACTION.name)
    first, second, _ = _transaction_deliveries(fx)
    pipeline.run_table_etl(first, TRANSACTION, base, DAY1_TS)
    pipeline.run_table_etl(second, TRANSACTION, base, DAY2_TS)
    cols = ["TransactionDate", "TransactionTypeId", "TransactionAmount"]
    return kept.changed_rows(spark, base, 1, cols).select(
        TRANSACTION.key, *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("before", "after") for c in cols])


@query
def latest_transactions_top10(spark, sf_dir):
    return marts.latest(_clean(_fx(spark, sf_dir), "transaction"), "LoanAccountTransactionId", 10,
                        ["LoanAccountTransactionId", "TransactionDate", "LoanAccountId",
                         "TransactionAmount"])


@query
def profile_accounts(spark, sf_dir):
    return marts.profile(_clean(_fx(spark, sf_dir), "account"))


@query
def profile_numeric_balances(spark, sf_dir):
    """Mean, deviation and exact quartiles of every numeric column."""
    return marts.numeric_profile(_clean_shared(_fx(spark, sf_dir), "balance"))


def _publish_month(fx: Fixtures, cars: DataFrame, run_date: str, base: str) -> DataFrame:
    return pipeline.publish_profit_month(cars, fx.interest_rates, fx.energy_class_margin,
                                         fx.credit_risk_tier, fx.depreciation_rates, run_date, base)


@query
def run_log(spark, sf_dir):
    """The log of a run that published its month; counts come from the writes."""
    fx = _fx(spark, sf_dir)
    return _publish_month(fx, fx.cars, RUN_DATE, work_path(spark, "profit"))


@query
def publish_profit_month(spark, sf_dir):
    """Two months published, the later one twice with other prices first: the second
    run replaces its month and leaves the other alone."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "profit")
    may = fx.cars.withColumn("FileMonth", F.lit("2025-05-01").cast("date"))
    both = fx.cars.unionByName(may)
    _publish_month(fx, both, "2025-05-20", base)
    _publish_month(fx, both.withColumn("BasePrice", F.col("BasePrice") * 2), RUN_DATE, base)
    _publish_month(fx, both, RUN_DATE, base)
    months = [pipeline.read_profit_month(spark, base, d) for d in ("2025-05-20", RUN_DATE)]
    return months[0].unionByName(months[1])


# --------------------------------------------------------------- star publishing

def _run_star(fx: Fixtures, base: str, accounts: DataFrame, run_ts: str) -> DataFrame:
    return pipeline.run_star(fx.spark, accounts, with_audit(_clean_shared(fx, "balance"), DAY1_TS),
                             with_audit(_clean_shared(fx, "transaction"), DAY1_TS), base, run_ts)


def _log_columns(log: DataFrame) -> DataFrame:
    return log.select("step", "status", "message", "row_count")


@query
def star_first_load(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return _log_columns(_run_star(fx, work_path(spark, "star"), _clean_shared(fx, "account"), DAY1_TS))


@query
def star_rerun_is_noop(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "star")
    _run_star(fx, base, _clean_shared(fx, "account"), DAY1_TS)
    return _log_columns(_run_star(fx, base, _clean_shared(fx, "account"), DAY2_TS))


@query
def star_second_delivery_keys_stable(spark, sf_dir):
    """Keys and versions of the accounts after a second delivery."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "star")
    _run_star(fx, base, _clean_shared(fx, "account"), DAY1_TS)
    _run_star(fx, base, _clean_shared(fx, "account", day2=True), DAY2_TS)
    dim = versioned.read_current(spark, f"{base}/dim_account").select("account_key", "account_id")
    history = versioned.read_current(spark, f"{base}/dim_account_history").groupBy("account_id").agg(
        F.count(F.lit(1)).alias("versions"), F.min("version_key").alias("first_version"),
        F.max("version_key").alias("last_version"))
    return dim.join(history, "account_id")


@query
def fact_balance_versions(spark, sf_dir):
    """Which account version each published balance reaches by its date."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "star")
    _run_star(fx, base, _clean_shared(fx, "account"), DAY1_TS)
    _run_star(fx, base, _clean_shared(fx, "account", day2=True), DAY2_TS)
    fact = versioned.read_current(spark, f"{base}/fact_balance")
    history = versioned.read_current(spark, f"{base}/dim_account_history").select(
        F.col("version_key").alias("account_version_key"), "valid_from")
    return fact.join(history, "account_version_key").select("balance_id", "account_id", "balance_date", "valid_from")


@query
def star_orphans_retried(spark, sf_dir):
    """Facts before their accounts: kept, and loaded when the accounts arrive."""
    fx = _fx(spark, sf_dir)
    base = work_path(spark, "star")
    none = lambda t: with_audit(_clean_shared(fx, t), DAY1_TS).filter("false")
    logs = [_run_star(fx, base, _clean_shared(fx, "account", day2=True), DAY1_TS),
            pipeline.run_star(spark, _clean_shared(fx, "account"), none("balance"), none("transaction"), base, DAY2_TS)]
    out = [_log_columns(x).filter("step LIKE 'fact%'").select(F.lit(i).alias("run"), "*") for i, x in enumerate(logs, 1)]
    return out[0].unionByName(out[1])
