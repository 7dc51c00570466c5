"""The unified payment table: payments with accounts, risk at payment time and fraud labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.operators.asof import VersionIndex, asof_join, index_versions

MART_COLUMNS = (
    "payment_id",
    "source_account_id",
    "destination_account_id",
    "amount",
    "timestamp",
    "source_opening_date",
    "destination_opening_date",
    "source_risk_flag",
    "destination_risk_flag",
    "is_fraud_flag",
    "fraud_type",
    "fraud_reported_date",
)


def date_window_filter(payments: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """Payments of ``[start_date, end_date)``, all of them unless both are given.

    The comparison stays on the bare column, so it reaches the scan.
    """
    if not (start_date and end_date):
        return payments
    kind = payments.schema["payment_timestamp"].dataType
    low, high = (F.lit(str(v)).cast(kind) for v in (start_date, end_date))
    return payments.filter((F.col("payment_timestamp") >= low) & (F.col("payment_timestamp") < high))


def join_account(payments: DataFrame, accounts: DataFrame, role: str) -> DataFrame:
    side = accounts.select(
        F.col("account_id").alias(f"_{role}_account"), F.col("opening_date").alias(f"{role}_opening_date")
    )
    return payments.join(side, F.col(f"{role}_account_id") == F.col(f"_{role}_account"), "left").drop(f"_{role}_account")


def join_accounts_twice(payments: DataFrame, accounts: DataFrame) -> DataFrame:
    """Opening dates of the source and the destination account."""
    return join_account(join_account(payments, accounts, "source"), accounts, "destination")


def index_risk(history: DataFrame, versions_bound: int | None = None) -> VersionIndex:
    return index_versions(history, "account_id", N.VALID_FROM, N.VALID_TO, ["risk_flag"], versions_bound)


def join_risk(payments: DataFrame, risk: VersionIndex, role: str) -> DataFrame:
    return asof_join(payments, risk, f"{role}_account_id", "payment_timestamp", {"risk_flag": f"{role}_risk_flag"})


def asof_risk_join(payments: DataFrame, history: DataFrame, versions_bound: int | None = None) -> DataFrame:
    """Risk flags of both accounts at payment time; null where there was no history."""
    risk = index_risk(history, versions_bound)
    return join_risk(join_risk(payments, risk, "source"), risk, "destination")


def join_fraud_cases(payments: DataFrame, fraud_cases: DataFrame) -> DataFrame:
    """Fraud label of the payment. The flag says that a case names a fraud type."""
    cases = fraud_cases.select(F.col("payment_id").alias("_case_payment"), "fraud_type", "fraud_reported_date")
    joined = payments.join(cases, F.col("payment_id") == F.col("_case_payment"), "left").drop("_case_payment")
    return joined.withColumn("is_fraud_flag", F.col("fraud_type").isNotNull())


def unified_payment_intelligence(
    payments: DataFrame,
    accounts: DataFrame,
    history: DataFrame,
    fraud_cases: DataFrame,
    start_date=None,
    end_date=None,
    versions_bound: int | None = None,
) -> DataFrame:
    """One row per payment.

    Joins on the same account stand side by side, so large dimensions cost one
    exchange of the payments per role and one for the fraud cases; small ones are
    broadcast by their measured size.
    """
    facts = date_window_filter(payments, start_date, end_date).drop("payment_reference")
    if start_date and end_date:
        kind = history.schema[N.VALID_FROM].dataType
        low, high = (F.lit(str(v)).cast(kind) for v in (start_date, end_date))
        valid_to = F.col(N.VALID_TO)
        history = history.filter((F.col(N.VALID_FROM) < high) & (valid_to.isNull() | (valid_to > low)))
    risk = index_risk(history, versions_bound)
    for role in ("source", "destination"):
        facts = join_risk(join_account(facts, accounts, role), risk, role)
    facts = join_fraud_cases(facts, fraud_cases)
    flags = [f"{role}_risk_flag" for role in ("source", "destination")]
    facts = facts.withColumns({flag: F.coalesce(flag, F.lit(False)) for flag in flags})
    return facts.withColumnRenamed("payment_timestamp", "timestamp").select(*MART_COLUMNS)
