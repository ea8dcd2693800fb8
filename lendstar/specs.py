"""Declared table layouts of the lending data and the per-table cleansing rules.

A ``TableSpec`` carries everything the generic pipeline needs for one raw
delivery: declared schema, business key, ordering column for keep-latest,
European-decimal amount columns, -1 sentinels, NOT NULL / default / length
constraints, integer date keys to expand, and the identity column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

I, L, S, D, TS = T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.TimestampType()


def _schema(cols: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# The declared delivery layouts (column names, order, nullability).
# Raw delivery layouts (';'-separated, header).  Business ids that grow with the
# portfolio are 64 bit.  Amounts arrive as European
# decimal strings.  nullable=False documents the declared NOT NULL; CSV reads
# ignore it, so conformance enforces it explicitly.
ACCOUNT_SCHEMA = _schema([
    ("LoanAccountId", L, False), ("SourceId", I, False), ("AccountNumber", S, False),
    ("IBAN", S, True), ("BBAN", S, True), ("AccountCurrencyId", I, False),
    ("AccountCurrency", S, False), ("OrganizationId", I, False), ("OrganizationName", S, False),
    ("ChannelID", I, True), ("BrokerId", I, False), ("OpenDateId", I, False),
    ("OpenDate", D, False), ("CancelledDateId", I, True), ("CancelledDate", D, True),
    ("ValueDate", D, False), ("MaturityDate", D, True), ("ProductId", I, False),
    ("Product", S, False), ("InvoiceDay", I, False), ("CurrentInstallmentAmount", S, False),
    ("CurrentInvoiceFee", S, False), ("RepaymentRate", S, True), ("NextInvoiceDate", D, False),
    ("CalculatedMaturityDate", D, True),
])

BALANCE_SCHEMA = _schema([
    ("LoanAccountBalanceId", L, False), ("SourceId", I, False), ("BalanceDateId", I, False),
    ("LoanAccountId", L, False), ("ProductId", I, False), ("AccountCurrencyId", I, False),
    ("AccountStatusId", I, False), ("NumOfTransactions", I, False),
    ("NetTransactionAmount", S, False), ("NetTransactionAmountSek", S, False),
    ("AccruedInterest", S, False), ("AccruedInterestSEK", S, False), ("Balance", S, False),
    ("BalanceSek", S, False), ("LTV", I, False), ("PrecedingId", L, True),
])

TRANSACTION_SCHEMA = _schema([
    ("LoanAccountTransactionId", L, False), ("SourceId", I, False), ("TransactionDateId", I, False),
    ("ValueDateId", I, False), ("EntryDateID", I, False), ("LoanAccountId", L, False),
    ("TransactionTypeId", I, False), ("TransactionStatus", S, True), ("RectifyStatus", S, True),
    ("TransactionCurrencyId", I, False), ("TransactionAmount", S, False),
    ("TransactionAmountSEK", S, False), ("CounterpartClearingNumber", S, True),
    ("CounterPartBic", S, True), ("CounterPartIban", S, True), ("TransactionReference", S, True),
    ("ExchangeRateId", I, False), ("TransactionText", S, True), ("AccountServicerReference", S, True),
    ("CounterPartId", I, True), ("CounterPartAccountNumber", S, True), ("CounterPartBankName", S, True),
    ("TransactionDateTime", TS, True), ("IsDirectDebit", I, True), ("GLAccount", S, True),
    ("EventName", S, True), ("InvoiceId", L, True),
])

# Cleansed amounts: the cleansed tables declare DECIMAL(15,5).
AMOUNT_PRECISION, AMOUNT_SCALE = 15, 5
AUDIT_COLS = ["CreatedDate", "UpdatedDate", "UpdatedTime"]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: str
    order_col: str
    identity_col: str
    amount_cols: tuple[str, ...] = ()
    sentinel_cols: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)
    length_checks: dict = field(default_factory=dict)
    date_keys: dict = field(default_factory=dict)      # date column -> integer key column
    is_active_from: str | None = None                  # IsActive = <col> IS NULL

    @property
    def business_cols(self) -> list[str]:
        """Columns compared for change detection (the raw layout)."""
        return [f.name for f in self.schema.fields]

    @property
    def not_null_cols(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def computed_cols(self) -> list[str]:
        out = list(self.date_keys)
        if self.is_active_from:
            out.append("IsActive")
        return out


ACCOUNT = TableSpec(
    name="Loan_Account_cleansed", schema=ACCOUNT_SCHEMA, key="LoanAccountId",
    order_col="OpenDateId", identity_col="LoanAccountIdentityId",
    amount_cols=("CurrentInstallmentAmount", "CurrentInvoiceFee"),
    sentinel_cols=("CancelledDateId",),
    defaults={"SourceId": 8, "InvoiceDay": 14},
    length_checks={"AccountCurrency": 3},
    is_active_from="CancelledDate",
)

BALANCE = TableSpec(
    name="Loan_Balance_cleansed", schema=BALANCE_SCHEMA, key="LoanAccountBalanceId",
    order_col="BalanceDateId", identity_col="LoanAccountBalanceIdentityId",
    amount_cols=("NetTransactionAmount", "NetTransactionAmountSek", "AccruedInterest",
                 "AccruedInterestSEK", "Balance", "BalanceSek"),
    sentinel_cols=("PrecedingId",),
    defaults={"NumOfTransactions": 0, "LTV": 0},
    date_keys={"BalanceDate": "BalanceDateId"},
)

TRANSACTION = TableSpec(
    name="Loan_Transaction_cleansed", schema=TRANSACTION_SCHEMA, key="LoanAccountTransactionId",
    order_col="TransactionDateId", identity_col="LoanAccountTransactionIdentityId",
    amount_cols=("TransactionAmount", "TransactionAmountSEK"),
    sentinel_cols=("CounterPartId", "InvoiceId"),
    defaults={"SourceId": 8},
    date_keys={"TransactionDate": "TransactionDateId", "ValueDate": "ValueDateId",
               "EntryDate": "EntryDateID"},
)

SPECS = {"account": ACCOUNT, "balance": BALANCE, "transaction": TRANSACTION}
