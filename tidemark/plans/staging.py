"""Staging projections of the raw tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_payments(raw_payments: DataFrame) -> DataFrame:
    return raw_payments.select(
        "payment_id",
        "source_account_id",
        "destination_account_id",
        "payment_reference",
        "amount",
        "payment_timestamp",
    )


def stg_accounts(raw_accounts: DataFrame) -> DataFrame:
    return raw_accounts.select("account_id", "opening_date")


def stg_risk_feed(raw_risk_feed: DataFrame) -> DataFrame:
    return raw_risk_feed.select("account_id", "risk_score")


def stg_fraud_cases(raw_fraud_cases: DataFrame) -> DataFrame:
    return raw_fraud_cases.select(
        "payment_id", F.col("is_fraud").alias("is_fraud_flag"), "fraud_type", "fraud_reported_date"
    )
