"""The declared data tests of the staging tables and the mart."""

from pyspark.sql import functions as F

from tidemark.operators.reporting import KeyTest, TableTest

MART = "unified_payment_intelligence"


def _not_null(table, column):
    return TableTest(f"not_null_{column}", table, row_fails=F.col(column).isNull())


def _unique(table, column):
    return TableTest(f"unique_{column}", table, keys=KeyTest("unique", column))


def _accepted(table, column, values, severity="error"):
    outside = F.when(~F.col(column).isin(list(values)), F.col(column))
    return TableTest(f"accepted_values_{column}", table, failures=F.count_distinct(outside), severity=severity)


def declared_tests(min_rows: int = 100) -> list[TableTest]:
    return [
        TableTest("row_count", MART, failures=F.when(F.count("*") < min_rows, 1)),
        _unique(MART, "payment_id"),
        _not_null(MART, "payment_id"),
        _not_null(MART, "source_account_id"),
        TableTest(
            "relationships_source_account_id",
            MART,
            keys=KeyTest("known", "source_account_id", "stg_accounts", "account_id"),
        ),
        _accepted(MART, "is_fraud_flag", [True, False], severity="warn"),
        TableTest(
            "is_after_timestamp", MART, row_fails=F.col("timestamp") < F.col("source_opening_date").cast("timestamp_ntz")
        ),
        _not_null(MART, "source_risk_flag"),
        _accepted(MART, "source_risk_flag", [True, False]),
        _not_null(MART, "destination_risk_flag"),
        _accepted(MART, "destination_risk_flag", [True, False]),
        TableTest(
            "fraud_counts_match",
            MART,
            keys=KeyTest("as_many", "payment_id", "stg_fraud_cases", "payment_id"),
            where="is_fraud_flag",
        ),
        _unique("stg_payments", "payment_id"),
        _not_null("stg_payments", "payment_id"),
        TableTest("amount_not_negative", "stg_payments", row_fails=~(F.col("amount") >= 0), severity="warn"),
        _unique("stg_accounts", "account_id"),
        _not_null("stg_accounts", "account_id"),
        _not_null("stg_risk_feed", "account_id"),
        _unique("stg_fraud_cases", "payment_id"),
        _not_null("stg_fraud_cases", "payment_id"),
    ]
