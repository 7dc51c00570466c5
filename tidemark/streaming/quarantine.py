"""A stream of messages split into good events and dead letters."""

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.monitoring import with_failed_rules
from tidemark.sources.events import parse_or_keep
from tidemark.streaming.layers import append_micro_batch, run_of

PARSED = "parsed"


def split_messages(messages: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Typed events with ``raw``, the message, and ``failed_rules``.

    A message that doesn't parse fails the rule ``parsed`` alone and has no event; the
    other rules judge what did parse. Nothing is dropped.
    """
    events = parse_or_keep(messages)
    ok = F.col(PARSED)
    return with_failed_rules(events, {PARSED: ok, **{name: ~ok | holds for name, holds in rules.items()}}).drop(PARSED)


def write_split(judged: DataFrame, epoch: int, good: str, bad: str, run: str) -> None:
    """One micro-batch into both folders, each under its run and number.

    A retry overwrites both, so whatever a failed attempt left in one of them
    counts once. The messages are judged once.
    """
    judged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        failed = F.size("failed_rules") > 0
        append_micro_batch(judged.filter(~failed).drop("raw", "failed_rules"), epoch, good, run)
        append_micro_batch(judged.filter(failed), epoch, bad, run)
    finally:
        judged.unpersist()


def start_quarantine(
    messages: DataFrame, rules: Mapping[str, Column], good: str, bad: str, checkpoint: str, interval: str | None = "1 minute"
):
    """Good events to one layer, dead letters with their message and failed rules to another."""
    run = run_of(messages.sparkSession, checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        split_messages(messages, rules)
        .writeStream.foreachBatch(lambda batch, epoch: write_split(batch, epoch, good, bad, run))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
