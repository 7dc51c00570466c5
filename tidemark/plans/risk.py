"""Risk flags and their history per account."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.operators.history import HistoryRules, snapshot

RISK_RULES = HistoryRules(keys=("account_id",), check=("risk_score", "risk_flag", "risk_flag_text"))


def risk_flagging(risk_feed: DataFrame) -> DataFrame:
    """Feed with flag and label; without a score the flag is null and the label low."""
    high = F.col("risk_score") > N.HIGH_RISK_ABOVE
    return risk_feed.select(
        "account_id",
        "risk_score",
        high.alias("risk_flag"),
        F.when(high, N.HIGH_RISK_TEXT).otherwise(N.LOW_RISK_TEXT).alias("risk_flag_text"),
    )


def account_risk_snapshot(history: DataFrame | None, risk_feed: DataFrame, as_of, stage=None) -> DataFrame:
    """Risk history after one more load of the feed."""
    return snapshot(history, risk_flagging(risk_feed), RISK_RULES, as_of, stage)


def fold_snapshots(loads, stage=None) -> DataFrame:
    """History after several loads, given as (as_of, feed) in time order."""
    history = None
    for as_of, feed in loads:
        history = account_risk_snapshot(history, feed, as_of, stage)
    return history


def amount_risk_score(events: DataFrame) -> DataFrame:
    return events.withColumn("risk_score", F.col("amount") * N.AMOUNT_SCORE_RATE)
