"""Cleansing: European decimals, quarantine, sentinels, keep-latest."""

from decimal import Decimal

from pyspark.sql import functions as F

from lendstar.functions.decimals import european_decimal, is_unparseable
from lendstar.operators import cleanse
from lendstar.specs import ACCOUNT_SCHEMA, ACCOUNT


def test_european_decimal_tokens_padding_and_bad_text(spark):
    df = spark.createDataFrame(
        [(" 1234,56 ",), ("NULL",), ("null",), ("",), (None,), ("1.234,56",), ("   ",), ("\t7,5\n",)],
        "s string")
    rows = df.select(european_decimal("s").alias("v"), is_unparseable("s").alias("bad")).collect()
    got = [(r.v, r.bad) for r in rows]
    assert got == [
        (Decimal("1234.56000"), False), (Decimal("0"), False), (Decimal("0"), False),
        (Decimal("0"), False), (Decimal("0"), False), (None, True), (None, True),
        (Decimal("7.50000"), False)]
    # Always DECIMAL, never DOUBLE (the reference's mixed branch gave DOUBLE).
    assert df.select(european_decimal("s").alias("v")).schema["v"].dataType.simpleString() == "decimal(15,5)"


def _acc_row(i, open_id, amount="10,00", cur="SEK", cancelled=-1, iban=None):
    from datetime import date
    return (i, 8, f"A{i}", iban, None, 49, cur, 1, "ORG", None, 3, open_id,
            date(open_id // 10000, open_id // 100 % 100, open_id % 100), cancelled, None,
            date(2020, 1, 1), None, 1, "P", 14, amount, "29,50", None, date(2025, 7, 14), None)


def test_quarantine_reasons_and_accepted_rows(spark):
    rows = [_acc_row(1, 20200101), _acc_row(2, 20200101, amount="1.234,56"),
            _acc_row(3, 20200101, cur="EURO"), _acc_row(4, 20200101, amount="NULL")]
    df = spark.createDataFrame(rows, ACCOUNT_SCHEMA)
    ok = {r.LoanAccountId for r in cleanse.accepted(df, ACCOUNT).collect()}
    bad = {r.LoanAccountId: r.reject_reason for r in cleanse.rejected(df, ACCOUNT).collect()}
    assert ok == {1, 4}
    assert bad == {2: "CurrentInstallmentAmount unparseable", 3: "AccountCurrency length <> 3"}


def test_clean_keeps_latest_nulls_sentinels_and_sets_is_active(spark):
    rows = [_acc_row(1, 20200101), _acc_row(1, 20210101, amount="20,00"),
            _acc_row(2, 20200101, cancelled=20250131)]
    df = spark.createDataFrame(rows, ACCOUNT_SCHEMA)
    out = {r.LoanAccountId: r for r in cleanse.clean(df, ACCOUNT).collect()}
    assert out[1].OpenDateId == 20210101 and out[1].CurrentInstallmentAmount == Decimal("20.00000")
    assert out[1].CancelledDateId is None and out[1].IsActive == 1
    assert out[2].CancelledDateId == 20250131 and out[2].IsActive == 1  # CancelledDate NULL in row


def test_dedup_tie_break_is_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 4, "z")], "k int, d int, ref string")
    for parts in (1, 3):
        got = cleanse.dedup_latest(df.repartition(parts), "k", "d").collect()
        assert [(r.k, r.d, r.ref) for r in got] == [(1, 5, "a")]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [(r.k, r.n) for r in cleanse.duplicate_keys(df, "k").collect()] == [(1, 2)]


def test_empty_delivery_cleans_to_empty(spark):
    df = spark.createDataFrame([], ACCOUNT_SCHEMA)
    assert cleanse.clean(df, ACCOUNT).isEmpty()
    assert F is not None
