"""Volume of a stream, kept as counts of every micro-batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.monitoring import volume_drops
from tidemark.streaming.layers import append_micro_batch, run_of


def count_micro_batch(batch: DataFrame, epoch: int, moment: str, period: str, path: str, run: str) -> None:
    """Rows of one micro-batch per period, with its earliest and latest moment there.

    Rows without a moment are counted under a null period. A retry overwrites what
    the failed attempt wrote, so each row counts once.
    """
    counts = batch.groupBy(F.date_trunc(period, moment).alias("period")).agg(
        F.count("*").alias("n_rows"), F.min(moment).alias("earliest"), F.max(moment).alias("latest")
    )
    append_micro_batch(counts, epoch, path, run)


def start_volume(events: DataFrame, moment: str, period: str, path: str, checkpoint: str, interval: str | None = "1 minute"):
    """Count a stream into a table of metrics, a few rows a micro-batch.

    The stream holds no state: late rows are further counts of their period.
    """
    run = run_of(events.sparkSession, checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        events.select(moment)
        .writeStream.foreachBatch(lambda batch, epoch: count_micro_batch(batch, epoch, moment, period, path, run))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def volume_so_far(metrics: DataFrame, period: str = "month", least_share: float = 0.5) -> DataFrame:
    """``volume_check`` over all that was streamed so far; only the metrics are read."""
    counted = metrics.filter(F.col("period").isNotNull()).groupBy("period").agg(F.sum("n_rows").alias("n_rows"))
    return volume_drops(counted, period, least_share)
