"""Schemas of the landed files and of the payment event."""

from pyspark.sql import types as T


def _schema(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_PAYMENTS = _schema(
    ("payment_id", T.StringType()),
    ("source_account_id", T.StringType()),
    ("destination_account_id", T.StringType()),
    ("payment_reference", T.StringType()),
    ("amount", T.DoubleType()),
    ("payment_timestamp", T.TimestampType()),
)
RAW_ACCOUNTS = _schema(("account_id", T.StringType()), ("opening_date", T.DateType()))
RAW_RISK_FEED = _schema(("account_id", T.StringType()), ("risk_score", T.DoubleType()))
RAW_FRAUD_CASES = _schema(
    ("payment_id", T.StringType()),
    ("is_fraud", T.BooleanType()),
    ("fraud_type", T.StringType()),
    ("fraud_reported_date", T.DateType()),
)

# Landed file -> (table, schema).
LANDED_FILES = {
    "payment_transactions.csv": ("raw_payments", RAW_PAYMENTS),
    "account_details.csv": ("raw_accounts", RAW_ACCOUNTS),
    "risk_feed.csv": ("raw_risk_feed", RAW_RISK_FEED),
    "fraud_cases.csv": ("raw_fraud_cases", RAW_FRAUD_CASES),
}

PAYMENT_EVENT = _schema(
    ("transaction_id", T.StringType()),
    ("user_id", T.StringType()),
    ("user_name", T.StringType()),
    ("amount", T.DoubleType()),
    ("currency", T.StringType()),
    ("merchant_id", T.StringType()),
    ("event_timestamp", T.TimestampType()),
)
