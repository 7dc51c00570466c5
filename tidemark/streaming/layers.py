"""Event stream into lake layers."""

import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.risk import amount_risk_score
from tidemark.sources.events import parse_payment_events

RUN, EPOCH = "run_id", "epoch_id"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that owns a checkpoint, written into it once.

    Epochs count from 0 again under a new checkpoint; the run's id keeps its
    micro-batches apart from those of earlier runs.
    """
    path = f"{checkpoint}/run"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException:  # no such path yet
        run = uuid.uuid4().hex
        spark.createDataFrame([(run,)], "value string").coalesce(1).write.text(path)
        return run


def append_micro_batch(batch: DataFrame, epoch: int, path: str, run: str, partition_by=()) -> None:
    """Add one micro-batch to a Parquet layer.

    The batch has its own partition folder and overwrites it, so a retry after a
    failure does not add rows twice.
    """
    batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{RUN}={run}/{EPOCH}={epoch}")


def write_layers(batch: DataFrame, epoch: int, bronze: str, silver: str, run: str) -> None:
    """One micro-batch into both layers; the source is read once."""
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append_micro_batch(batch.withColumn("processing_ts", F.current_timestamp()), epoch, bronze, run)
        append_micro_batch(amount_risk_score(batch), epoch, silver, run)
    finally:
        batch.unpersist()


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def start_bronze_silver(
    messages: DataFrame, bronze: str, silver: str, checkpoint: str, interval: str | None = "1 minute"
):
    """Messages to typed events to bronze (stamped) and silver (scored).

    Without an interval the query works off what is there and stops.
    """
    events, run = parse_payment_events(messages), run_of(messages.sparkSession, checkpoint)
    return (
        events.writeStream.foreachBatch(lambda batch, epoch: write_layers(batch, epoch, bronze, silver, run))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def start_landing(messages: DataFrame, path: str, checkpoint: str, interval: str | None = "1 minute"):
    """Messages to typed, stamped events in one Parquet folder, each exactly once."""
    events = parse_payment_events(messages).withColumn("processing_timestamp", F.current_timestamp())
    return (
        events.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )
