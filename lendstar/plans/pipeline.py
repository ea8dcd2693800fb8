"""End-to-end runs: the monthly profit run, the generic raw -> cleansed table
pipeline and the star schema, each publishing versions and a run log.

A step writes first and logs what the write counted (``Observation`` metrics of
the write itself, never a collect of data).  What several parts of a step read
is stored once below a work folder that is removed after its publish.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lendstar.operators import cleanse, keys, star, upsert
from lendstar.operators.profit import estimate_profits, rate_at, stage_cars
from lendstar.plans.buckets import BUCKETS, touched, upsert_buckets
from lendstar.session import remove, stored, work_folder, work_path
from lendstar.sources.files import CORRUPT, first_available, has_data_files
from lendstar.sources.versioned import (bucket_listing, current_version, publish, publish_buckets, read_buckets,
                                        read_current, remove_failed)
from lendstar.specs import TableSpec

LOG_SCHEMA = "step string, status string, message string, row_count long, output_name string"
TABLE_LOG_SCHEMA = LOG_SCHEMA + ", raw_rows long, accepted_rows long, rejected_rows long, duplicate_rows long"


class SourceMissing(RuntimeError):
    """A run stops because its input for the month isn't there."""


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def log_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(c) for c in _columns(schema)) for r in rows], schema)


def publish_counted(df: DataFrame, base: str) -> tuple[str, int]:
    """Publish the next version; its path and the rows that the write counted."""
    obs = Observation()
    path = publish(df.observe(obs, F.count(F.lit(1)).alias("rows")), base)
    remove_failed(df.sparkSession, base)
    return path, int(obs.get["rows"])


# ----------------------------------------------------------------- monthly profit run

def _iso(d) -> str:
    return d.isoformat() if isinstance(d, _dt.date) else str(d)


def estimates_table_name(run_date) -> str:
    d = _dt.date.fromisoformat(_iso(run_date)[:10])
    return f"LoanProfitEstimates_{d.year:04d}{d.month:02d}"


def publish_profit_month(cars: DataFrame, rates: DataFrame, margins: DataFrame, tiers: DataFrame,
                         bands: DataFrame, run_date, base: str,
                         source_name: str = "CarInformation") -> DataFrame:
    """Estimate the run month's cars and publish them under the month's name.

    ``base/LoanProfitEstimates_yyyymm`` gets a new version, which replaces the
    month for readers when it's committed; other months aren't touched.  The
    name is also registered as a view.  Returns the run log.  A month without
    cars stops the run (``SourceMissing``); a run month without a rate of its own
    is a warning (the latest earlier rate is used); no rate at all is an error
    and publishes nothing.
    """
    spark, name = cars.sparkSession, estimates_table_name(run_date)
    run = F.lit(_iso(run_date)).cast("date")
    month = cars.filter(F.trunc("FileMonth", "month") == F.trunc(run, "month"))
    if month.isEmpty():
        raise SourceMissing(f"{source_name} for {_iso(run_date)[:7]} not found")
    log = []

    def add(step: str, status: str, message: str, count: int, output: str) -> None:
        log.append(dict(zip(_columns(LOG_SCHEMA), (step, status, message, count, output))))

    with work_folder(spark):
        source, staging = Observation(), Observation()
        one = F.count(F.lit(1)).alias("rows")
        staged = stored(stage_cars(month.observe(source, one), run_date).observe(staging, one), "staged")
        add("source_check", "ok", f"{source_name} found", int(source.get["rows"]), source_name)
        rate = rate_at(rates, run_date).first()
        if rate is None:
            add("rate_lookup", "error", "no interest rate on or before the run date", 0, "InterestRates")
            return log_frame(spark, log, LOG_SCHEMA)
        late = " (run month missing, latest earlier rate used)" if rate["is_fallback"] else ""
        add("rate_lookup", "warning" if late else "ok",
            f"base rate {rate['BaseInterestRate']} effective {rate['EffectiveDate']}{late}", 1, "InterestRates")
        add("staging", "ok", "cars passing required-field and price checks", int(staging.get["rows"]), "staging")
        estimates = estimate_profits(staged, rates, margins, tiers, bands, run_date, staged=True)
        path, n = publish_counted(estimates, f"{base.rstrip('/')}/{name}")
        add("estimates", "ok" if n else "warning", f"rows written for {_iso(run_date)[:7]}", n, name)
        written = spark.read.parquet(path)
        unmatched = staged.join(written.select("RecordID"), "RecordID", "left_anti").count()
        add("unmatched_cars", "warning" if unmatched else "ok",
            "staged cars without margin, risk tier or depreciation band", unmatched, name)
        written.createOrReplaceTempView(name)
    return log_frame(spark, log, LOG_SCHEMA)


def read_profit_month(spark: SparkSession, base: str, run_date) -> DataFrame | None:
    return read_current(spark, f"{base.rstrip('/')}/{estimates_table_name(run_date)}")


# ----------------------------------------------------------------- table pipeline

FREQUENT = 1000  # rows of a key, from which on they are cut to the latest one before they move
WHOLE_RUN = -1  # batch_id of the rejects of a run that isn't cut into batches


def rejects_path(target_base: str) -> str:
    return f"{target_base.rstrip('/')}_rejects"


def delivery(spark: SparkSession, *sources) -> DataFrame:
    """The first source that is there: a DataFrame, or the path of parquet files."""
    def candidate(s):
        if isinstance(s, DataFrame):
            return lambda: True, lambda: s
        return lambda: has_data_files(spark, s), lambda: spark.read.parquet(s)

    df = first_available(*[candidate(s) for s in sources if s is not None])
    if df is None:
        raise SourceMissing("no source of the delivery found")
    return df


def run_table_etl(raw: DataFrame, spec: TableSpec, target_base: str, run_ts, batch_id: int = WHOLE_RUN) -> dict:
    """Cleanse one delivery and publish a new snapshot version if anything changed.

    First load: dense identities + audit columns.  Later loads: MERGE semantics
    against the current version (matched rows keep identity and CreatedDate; a
    row older than the snapshot's by the spec's order column doesn't replace it);
    only buckets with changes are written.
    An unchanged delivery publishes nothing (idempotent).  Rejected rows are kept
    beside the target with their reason, by run time and batch, so that a repeated
    batch replaces its own only; lines that could not be parsed count as rejected.  Returns a log record; raw = accepted + rejected.
    """
    spark = raw.sparkSession
    biz = spec.business_cols + spec.computed_cols
    with work_folder(spark):
        obs = Observation()
        bad_line = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
        conf = cleanse.conform(raw, spec, keep=[CORRUPT] if CORRUPT in raw.columns else [])
        conf = conf.withColumn(cleanse.REASON, F.when(bad_line, "malformed line").otherwise(F.col(cleanse.REASON)))
        ok = F.col(cleanse.REASON) == ""
        conformed = work_path(spark, "conformed")
        conf = stored(conf.observe(obs, F.count(F.lit(1)).alias("raw"), F.count(F.when(ok, 1)).alias("accepted")),
                      "conformed", path=conformed)
        n_raw, n_ok = int(obs.get["raw"]), int(obs.get["accepted"])
        if not n_raw:
            return {"step": spec.name, "status": "ok", "message": "empty delivery", "row_count": 0,
                    "output_name": target_base, "raw_rows": 0, "accepted_rows": 0, "rejected_rows": 0, "duplicate_rows": 0}
        if n_raw > n_ok:
            (conf.filter(~ok).withColumn("run_ts", F.lit(str(run_ts))).withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_ts", "batch_id")
             .parquet(rejects_path(target_base)))
        accepted = conf.filter(ok).select(*spec.business_cols)
        n_clean, most, null_key = cleanse.key_counts(accepted, spec.key)
        counts = {"raw_rows": n_raw, "accepted_rows": n_ok, "rejected_rows": n_raw - n_ok,
                  "duplicate_rows": n_ok - n_clean}

        def record(message: str, rows: int, output: str) -> dict:
            return {"step": spec.name, "status": "ok", "message": message, "row_count": rows,
                    "output_name": output, **counts}

        latest = None
        if n_clean < n_ok and (null_key or most > FREQUENT):
            clean = stored(cleanse.clean_accepted(accepted, spec), "clean")
        else:
            clean = cleanse.with_computed(cleanse.null_sentinels(accepted, spec.sentinel_cols), spec)
            if n_clean < n_ok:
                ties = [c for c in spec.business_cols if c not in (spec.key, spec.order_col)]
                latest = lambda df, within: cleanse.dedup_latest(df, spec.key, spec.order_col, ties, within)
        done = upsert_buckets(clean, target_base, spec.key, spec.identity_col, biz, spec.order_col, run_ts,
                              unique=not null_key, latest=latest, read=lambda: remove(spark, conformed))
        path = f"{target_base}/v={current_version(spark, target_base)}"
        return {**record(done["message"], done["row_count"], path), "buckets": done["buckets"]}


def _isolated(rows: list[dict], step: str, output: str, fn) -> None:
    try:
        done = fn()
        rows += done if isinstance(done, list) else [done]
    except Exception as e:  # noqa: BLE001 - isolation is the point
        rows.append({"step": step, "status": "error", "message": str(e), "row_count": 0, "output_name": output})


def store_log(log: DataFrame, base: str, run_ts) -> None:
    """Keep a run's log beside the tables, one folder per run time."""
    (log.withColumn("run_ts", F.lit(str(run_ts))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").parquet(f"{base.rstrip('/')}/run_log"))


def run_all(spark: SparkSession, deliveries: dict[str, tuple], run_ts, log_base: str | None = None) -> DataFrame:
    """Run every table; one failing table does not stop the others.

    A delivery is (source, spec, target); a source is a DataFrame, a path, or a
    list of them of which the first that exists is taken.  Returns the run log
    (one row per table) and stores it below ``log_base``.
    """
    rows: list[dict] = []
    for source, spec, target in deliveries.values():
        sources = source if isinstance(source, (list, tuple)) else [source]
        _isolated(rows, spec.name, target,
                  lambda s=sources, sp=spec, t=target: run_table_etl(delivery(spark, *s), sp, t, run_ts))
    log = log_frame(spark, rows, TABLE_LOG_SCHEMA)
    if log_base:
        store_log(log, log_base, run_ts)
    return log


# ----------------------------------------------------------------- star schema

def _load_fact(rows: DataFrame, refs: list[tuple], base: str, id_col: str, key_col: str, finish=None) -> list[dict]:
    """Load the rows whose foreign keys exist, among them those that waited for
    their dimension rows; the others are stored beside the fact and tried again
    by each run.  A delivered row replaces a waiting one.  Returns log rows."""
    spark, kept, name = rows.sparkSession, f"{base}_orphans", base.rsplit("/", 1)[-1]
    waiting = read_current(spark, kept)
    if waiting is not None:
        rows = rows.unionByName(waiting.select(*rows.columns).join(rows.select(id_col), id_col, "left_anti"))
    with work_folder(spark):
        whole = finish(rows) if finish else rows
        all_rows = stored(star.marked(whole, refs), "marked")
        good = all_rows.filter("missing_key IS NULL").select(*whole.columns)
        log = [upsert_star_table(good, base, id_col, key_col, is_stored=True)]
        bad = all_rows.filter("missing_key IS NOT NULL").select(*rows.columns, "missing_key")
        n = bad.count()
        if waiting is None and not n:
            return log
        if waiting is None or waiting.count() != n or not bad.exceptAll(waiting.select(*bad.columns)).isEmpty():
            publish_counted(bad, kept)
        log.append({"step": f"{name}_orphans", "status": "warning" if n else "ok", "row_count": n, "output_name": kept,
                    "message": "rows without dimension row kept for a later run" if n else "no rows waiting"})
    return log


CODE_TABLE = 1  # bucket of a table with a row for each code or day


def upsert_star_table(rows: DataFrame, base: str, id_col: str, key_col: str, count: int = BUCKETS,
                      is_stored: bool = False) -> dict:
    """Publish a dimension or fact: keys of known ids never move, new ids get
    keys after the largest one, changed rows take the new values, ids that are
    not delivered stay.  Nothing is published when nothing changed."""
    name = base.rstrip("/").rsplit("/", 1)[-1]
    with work_folder(rows.sparkSession):
        if not is_stored:
            rows = stored(rows, name)  # compared first, then written from
        done = upsert_buckets(rows, base, id_col, key_col, [c for c in rows.columns if c != id_col], count=count)
    return {"step": name, "status": "ok", "message": done["message"], "row_count": done["row_count"],
            "output_name": base, "buckets": done["buckets"]}


def sightings_path(base: str) -> str:
    return f"{base.rstrip('/')}_sightings"


def _sighted(rows: DataFrame, base: str, as_of) -> None:
    """Note which accounts the delivery of this day holds, each once."""
    spark, path = rows.sparkSession, sightings_path(base)
    seen = rows.select("account_id", F.lit(str(as_of)).cast("date").alias("as_of"))
    if has_data_files(spark, path):
        seen = seen.join(spark.read.parquet(path).filter(F.col("as_of") == F.lit(str(as_of)).cast("date"))
                         .select("account_id"), "account_id", "left_anti")
    seen.write.mode("append").partitionBy("as_of").parquet(path)


def update_account_history(rows: DataFrame, base: str, as_of) -> dict:
    """Account versions by validity (SCD2), each with a ``version_key`` that stays.

    Deliveries may come in any order: an older one splits the versions that it
    falls into.  For that, the accounts of each delivery are noted beside the
    table, a folder a day; a delivery that isn't late reads none of them.  Only
    buckets with changed accounts are written.
    """
    spark, key, ids = rows.sparkSession, "account_id", ["account_id", "valid_from"]
    tracked = [c for c in rows.columns if c != key]
    done = {"step": "dim_account_history", "status": "ok", "message": "versions published", "output_name": base}
    with work_folder(spark):
        rows = stored(rows, "delivery")
        listing = bucket_listing(spark, base)
        if listing is None:
            current = read_current(spark, base)
            if current is None:
                first = keys.assign_dense_identity(upsert.scd2_initial(rows, key, tracked, as_of), ids, "version_key")
                publish_buckets(first, base, key, BUCKETS)
                _sighted(rows, base, as_of)
                return {**done, "row_count": read_current(spark, base).count()}
            listing = publish_buckets(current, base, key, BUCKETS)  # a table of an earlier layout
        versions = read_buckets(spark, base, listing, touched(rows, key, listing.count))
        seen = spark.read.parquet(sightings_path(base)) if has_data_files(spark, sightings_path(base)) else None
        changed = stored(upsert.scd2_merge(versions, rows, key, tracked, as_of, seen), "changed")
        buckets = touched(changed, key, listing.count)
        if not buckets:
            _sighted(rows, base, as_of)
            return {**done, "message": "no changes", "row_count": 0}
        old_keys = versions.select(*ids, "version_key")
        new = changed.join(old_keys, ids, "left_anti")
        top = keys.max_identity(read_buckets(spark, base, listing), "version_key")
        new = keys.assign_dense_identity(new, ids, "version_key", base=top)
        rest = read_buckets(spark, base, listing, buckets).join(changed.select(key).distinct(), key, "left_anti")
        out = rest.unionByName(changed.join(old_keys, ids)).unionByName(new)
        publish_buckets(out.select(*listing.schema.names), base, key, listing.count, listing, buckets)
        remove_failed(spark, base)
        _sighted(rows, base, as_of)
        return {**done, "row_count": changed.count()}


def account_version_at(fact: DataFrame, date_col: str, history: DataFrame) -> DataFrame:
    """``fact`` with ``account_version_key``: the account's version on the row's
    date; before the first version, that one."""
    h = history.groupBy("account_id").agg(F.array_sort(F.collect_list(
        F.struct("valid_from", "version_key"))).alias("versions"))  # the versions of one account
    begun = F.filter("versions", lambda v: v["valid_from"] <= F.col(date_col))
    version = F.coalesce(F.get(begun, F.size(begun) - 1), F.get("versions", F.lit(0)))
    return fact.join(h, "account_id", "left").withColumn(
        "account_version_key", version["version_key"]).drop("versions")


def _calendar_warnings(dated: tuple, output: str) -> list[dict]:
    """A log row per column with dates outside the widest calendar."""
    found = star.outside_calendar(*dated).groupBy("column_name").agg(
        F.sum("rows").alias("n"), F.count(F.lit(1)).alias("dates"),
        F.min("date").cast("string").alias("lo"), F.max("date").cast("string").alias("hi"))
    lo, hi = star.CALENDAR_LIMITS
    return [{"step": "calendar_check", "status": "warning", "row_count": r["n"], "output_name": output,
             "message": f"{r['column_name']}: {r['dates']} dates outside {lo}..{hi}, from {r['lo']} to {r['hi']}"}
            for r in found.orderBy("column_name").collect()]  # one per column


def run_star(spark: SparkSession, accounts: DataFrame, balances: DataFrame, transactions: DataFrame,
             base: str, run_ts, as_of=None) -> DataFrame:
    """Build, upsert and publish the star schema from cleansed tables below
    ``base``: dimensions first, then facts, one log row per table.  A failing
    table does not stop the others, but facts only follow published dimensions.
    Facts without their account or type are kept, logged and tried again.
    Each date column with dates that the calendar may not cover adds a warning.
    """
    base = base.rstrip("/")
    day = str(as_of or str(run_ts)[:10])
    at = lambda name: f"{base}/{name}"
    rows: list[dict] = []
    dated = ((balances, "BalanceDate"), (transactions, "TransactionDate"), (accounts, "OpenDate"))
    lo, hi = star.calendar_bounds(*dated, within=star.CALENDAR_LIMITS)
    acc = star.account_rows(accounts)
    dims = {
        "dim_date": lambda: upsert_star_table(
            star.date_dimension(spark, lo, hi), at("dim_date"), "full_date", "calendar_key", CODE_TABLE),
        "dim_account": lambda: upsert_star_table(acc, at("dim_account"), "account_id", "account_key"),
        "dim_organization": lambda: upsert_star_table(
            star.dim_organization(accounts, keyed=False), at("dim_organization"), "organization_id", "organization_key", CODE_TABLE),
        "dim_product": lambda: upsert_star_table(
            star.dim_product(accounts, keyed=False), at("dim_product"), "product_id", "product_key", CODE_TABLE),
        "dim_currency": lambda: upsert_star_table(
            star.dim_currency(accounts, keyed=False), at("dim_currency"), "currency_id", "currency_key", CODE_TABLE),
        "dim_transaction_type": lambda: upsert_star_table(
            star.dim_transaction_type(transactions, keyed=False), at("dim_transaction_type"),
            "transaction_type_id", "transaction_type_key", CODE_TABLE),
        "dim_account_history": lambda: update_account_history(acc, at("dim_account_history"), day),
    }
    for name, build in dims.items():
        _isolated(rows, name, at(name), build)

    def published(name: str) -> DataFrame:
        df = read_current(spark, at(name))
        if df is None:
            raise SourceMissing(f"{name} isn't published")
        return df

    def balance() -> list[dict]:
        history = published("dim_account_history")
        return _load_fact(star.rename(balances, star.audited(star.BALANCE_FACT_MAP)), [(published("dim_account"), "account_id")],
                          at("fact_balance"), "balance_id", "balance_key",
                          lambda good: account_version_at(good, "balance_date", history))

    def transaction() -> list[dict]:
        refs = [(published("dim_account"), "account_id"), (published("dim_transaction_type"), "transaction_type_id")]
        return _load_fact(star.rename(transactions, star.audited(star.TRANSACTION_FACT_MAP)), refs,
                          at("fact_transaction"), "transaction_id", "transaction_key")

    _isolated(rows, "fact_balance", at("fact_balance"), balance)
    _isolated(rows, "fact_transaction", at("fact_transaction"), transaction)
    try:
        rows += _calendar_warnings(dated, at("dim_date"))
    except Exception as e:  # noqa: BLE001 - the tables are published
        rows.append({"step": "calendar_check", "status": "error", "message": str(e), "row_count": 0,
                     "output_name": at("dim_date")})
    log = log_frame(spark, rows, LOG_SCHEMA)
    store_log(log, base, run_ts)
    return log
