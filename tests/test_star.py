"""Calendar, dimensions, facts, referential checks, marts."""

import datetime as dt
import re
from decimal import Decimal

from lendstar.operators import marts, star



def test_calendar_span_and_attributes(spark):
    cal = star.date_dimension(spark, "2017-01-01", "2025-12-31")
    assert cal.count() == 3287
    r = {x.full_date: x for x in cal.filter("full_date IN (DATE'2017-01-01', DATE'2017-01-07', "
                                            "DATE'2024-02-29')").collect()}
    jan1 = r[dt.date(2017, 1, 1)]
    # 2017-01-01 is a Sunday: weekday 1, US week 1 (ISO would say 52), weekend.
    assert (jan1.date_key, jan1.day_of_week, jan1.week_of_year, jan1.is_weekend) == (20170101, 1, 1, 1)
    assert (jan1.month_name, jan1.day_name, jan1.quarter) == ("January", "Sunday", 1)
    assert r[dt.date(2017, 1, 7)].is_weekend == 1 and r[dt.date(2017, 1, 7)].week_of_year == 1
    assert r[dt.date(2024, 2, 29)].date_key == 20240229


def test_code_dimension_one_row_per_id_with_dense_keys(spark):
    df = spark.createDataFrame([(2, "B"), (1, "A"), (1, "A"), (2, "A"), (None, "Z")],
                               "OrganizationId int, OrganizationName string")
    df = df.selectExpr("*", "8 AS SourceId")
    got = sorted(tuple(r) for r in star.dim_organization(df).collect())
    assert got == [(1, 1, "A", 8), (2, 2, "A", 8)]


def test_facts_reject_orphans(spark):
    bal = spark.createDataFrame(
        [(10, None, 1, 1, 1, 49, Decimal("1"), Decimal("1"), Decimal("5"), Decimal("5"), dt.date(2025, 1, 1)),
         (11, 10, 2, 1, 1, 49, Decimal("1"), Decimal("1"), Decimal("7"), Decimal("7"), dt.date(2025, 1, 2))],
        "LoanAccountBalanceId int, PrecedingId int, LoanAccountId int, AccountStatusId int, ProductId int, "
        "AccountCurrencyId int, AccruedInterest decimal(15,5), AccruedInterestSEK decimal(15,5), "
        "Balance decimal(15,5), BalanceSek decimal(15,5), BalanceDate date")
    accounts = spark.createDataFrame([(1,)], "account_id int")
    facts = star.fact_balance(bal, accounts).collect()
    assert [(r.balance_key, r.balance_id) for r in facts] == [(1, 10)]
    orphans = star.balance_orphans(bal, accounts).collect()
    assert [(r.balance_id, r.missing_key, r.key_value) for r in orphans] == [(11, "account_id", 2)]


def test_rollup_mart(spark):
    rows = spark.createDataFrame(
        [(1, 1, 1, 49, dt.date(2025, 1, 5), Decimal("10.00")), (2, 1, 1, 49, dt.date(2025, 1, 9), Decimal("5.00")),
         (3, 2, 1, 49, dt.date(2025, 2, 1), Decimal("1.00"))],
        "balance_id int, account_id int, product_id int, currency_id int, balance_date date, balance_eur decimal(15,5)")
    prod = spark.createDataFrame([(1, "CAR")], "product_id int, product_name string")
    cur = spark.createDataFrame([(49, "SEK")], "currency_id int, currency_code string")
    out = {(r.month, r.product_name, r.currency_code): (r.accounts, r.balance, r.rollup_level)
           for r in marts.balance_by_month(rows, prod, cur).collect()}
    assert out[(202501, "CAR", "SEK")] == (1, Decimal("5.00"), 0)  # the month's last balance
    assert out[(None, None, None)] == (2, Decimal("6.00"), 7)


def test_month_end_balance_carries_idle_accounts(spark):
    rows = [(1, 1, 1, 49, dt.date(2024, 11, 5), Decimal("10.00")), (2, 1, 1, 49, dt.date(2025, 2, 9), Decimal("5.00")),
            (3, 2, 1, 49, dt.date(2025, 1, 1), Decimal("1.00")), (4, 2, 2, 49, dt.date(2025, 1, 1), Decimal("2.00")),
            (5, 3, 2, 50, dt.date(2025, 3, 31), Decimal("7.50")), (6, 3, 1, 49, None, Decimal("99.00")),
            (7, 3, 2, 50, dt.date(2025, 3, 30), Decimal("8.00")), (8, 1, 2, 49, dt.date(2025, 5, 1), Decimal("-4.00"))]
    df = spark.createDataFrame(rows, "balance_id int, account_id int, product_id int, currency_id int, balance_date date, "
                                     "balance_eur decimal(15,5)")
    prod = spark.createDataFrame([(1, "CAR"), (2, "HOME")], "product_id int, product_name string")
    cur = spark.createDataFrame([(49, "SEK"), (50, "EUR")], "currency_id int, currency_code string")
    want = {}
    for m in (202411, 202412, 202501, 202502, 202503, 202504, 202505):
        for a in (1, 2, 3):
            seen = [r for r in rows if r[1] == a and r[4] and r[4].year * 100 + r[4].month <= m]
            if seen:
                b = max(seen, key=lambda r: (r[4], r[0]))
                p, c = {1: "CAR", 2: "HOME"}[b[2]], {49: "SEK", 50: "EUR"}[b[3]]
                for k in ((m, p, c, 0), (m, p, None, 1), (m, None, None, 3)):
                    n, t = want.get(k, (0, Decimal(0)))
                    want[k] = (n + 1, t + b[5])
    got = {(r.month, r.product_name, r.currency_code, r.rollup_level): (r.accounts, r.balance)
           for r in marts.month_end_balance(df, prod, cur).collect()}
    assert got == want


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "x int, y string")
    got = {r.column_name: tuple(r)[1:] for r in marts.profile(df).collect()}
    assert got == {"x": (3, 2, "1", "2"), "y": (2, 2, "a", "b")}


def test_no_fact_is_exchanged_on_a_code_key(spark, sf_dir):
    """With broadcasts off, facts move on the account id only."""
    from lendstar.fixtures import Fixtures
    from lendstar.operators import cleanse, marts, star
    from lendstar.specs import ACCOUNT, BALANCE, TRANSACTION
    fx = Fixtures(spark, sf_dir)
    acc, bal, txn = (cleanse.clean(df, s) for df, s in ((fx.acc, ACCOUNT), (fx.bal, BALANCE), (fx.txn, TRANSACTION)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [marts.transactions_by_type(star.transaction_rows(txn, star.account_ids(acc))),
                  star.transaction_orphans(txn, star.account_ids(acc)),
                  marts.balance_by_month(star.balance_rows(bal, star.account_ids(acc)),
                                         star.dim_product(acc, keyed=False), star.dim_currency(acc, keyed=False))]
        for df in frames:
            plan = df._jdf.queryExecution().executedPlan().toString()
            joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[([a-zA-Z_]+)#", plan)
            codes = {"transaction_type_id", "product_id", "currency_id",
                     "TransactionTypeId", "ProductId", "AccountCurrencyId"}
            assert joins and codes.isdisjoint(joins), joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
