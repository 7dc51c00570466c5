"""Activity of the last hour on a stream of events."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RESULT = "at long, n_rows long, n_recent long, cents_recent long"
SUMS = ["n", "valued", "cents"]


def _per_second(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds up the events of each key and second within a batch of rows."""
    for frame in frames:
        yield frame.groupby(["key", "at"], as_index=False).sum()


def _trailing(seconds: int):
    """Sums over the last ``seconds`` for every second that has closed, for all keys of
    a bucket at once.

    The state holds the sums of the seconds that are still open and of the last
    ``seconds`` before the watermark, each with the place of its key in ``names``; older
    ones leave it. It goes altogether once the watermark has left all behind.
    """

    def step(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        answered, known = -(1 << 62), None
        if state.exists:
            answered, names, whose, *held = state.get
            known = pd.DataFrame(dict(zip(["at", *SUMS], held)), dtype="int64")
            known.insert(0, "key", pd.Series(names)[whose].to_numpy())
        watermark = state.getCurrentWatermarkMs()
        closed = watermark // 1_000 - 1  # the last second that the watermark has passed
        if not state.hasTimedOut:
            new = pd.concat(list(frames))[["key", "at", *SUMS]]
            new = new[new["at"] > closed]
            known = new if known is None else pd.concat([known, new]) if len(new) else known
            known = known.groupby(["key", "at"], as_index=False).sum()
        whose = known.groupby("key").ngroup().to_numpy(np.int64)
        at = known["at"].to_numpy(np.int64)
        due = np.flatnonzero((at > answered) & (at <= closed))
        if len(due):
            # Keys lie one behind the other, too far apart for one's hour to reach another.
            place = at - at.min()
            place = place + whose * (place.max() + seconds + 1)
            # The last hour is a difference of two running totals.
            first = np.searchsorted(place, place[due] - seconds)
            totals = [np.concatenate([[0], np.cumsum(known[c].to_numpy(np.int64))]) for c in SUMS]
            n, valued, cents = (t[due + 1] - t[first] for t in totals)
            result = pd.DataFrame({"key": known["key"].to_numpy()[due], "at": at[due], "n_rows": known["n"].to_numpy(np.int64)[due], "n_recent": n})
            result["cents_recent"] = pd.Series(cents, dtype="Int64").where(valued > 0)
            yield result
        # An open second without events so far may get some and look back as well.
        known = known[at > closed - seconds]
        if not len(known):
            state.remove()
            return
        whose, names = pd.factorize(known["key"])
        state.update((max(answered, closed), names.tolist(), whose.tolist(), *(known[c].tolist() for c in ["at", *SUMS])))
        waiting = known["at"][known["at"] > closed]
        until = (waiting.min() + 1) * 1_000 - 1 if len(waiting) else (known["at"].max() + seconds + 2) * 1_000
        state.setTimeoutTimestamp(int(max(until, watermark)))

    return step


def recent_activity_stream(events: DataFrame, key: str, moment: str, cents: str, seconds: int = 3_600, delay: str = "10 minutes", buckets: int = 256) -> DataFrame:
    """For every key and second with events: their number and, over the last ``seconds``,
    ``n_recent`` and ``cents_recent``, as ``monitoring.recent_activity`` gives them.

    Events are added up per key and second inside every batch of rows before the
    shuffle, so a hot key sends few rows; an answer comes once the watermark (``delay``
    behind the latest event) has passed the second. Events later than that are in no
    count. State is kept in ``buckets`` of keys, so Python is called per bucket and not
    per key; a key has at most one entry a second of ``seconds`` and ``delay`` there. The
    number of buckets stays fixed for the life of the checkpoint.
    Events without key or moment are ignored.
    """
    at = F.unix_seconds(F.col(moment).cast("timestamp")).alias("at")
    valued = F.col(cents).isNotNull().cast("long").alias("valued")
    known = events.select(F.col(key).alias("key"), at, F.lit(1).cast("long").alias("n"), valued, F.coalesce(F.col(cents).cast("long"), F.lit(0)).alias("cents"))
    known = known.filter("key is not null and at is not null")
    kind = known.schema["key"].dataType.simpleString()
    sums = known.mapInPandas(_per_second, f"key {kind}, at long, n long, valued long, cents long")
    timed = sums.withColumn("closes", F.timestamp_seconds(F.col("at") + 1)).withWatermark("closes", delay)
    state = f"answered long, names array<{kind}>, whose array<long>, at array<long>, n array<long>, valued array<long>, cents array<long>"
    dealt = timed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandasWithState(
        _trailing(seconds), f"key {kind}, {RESULT}", state, "append", GroupStateTimeout.EventTimeTimeout
    )


def start_recent_activity(activity: DataFrame, path: str, checkpoint: str, interval: str | None = "1 minute"):
    """Append answers to files; a micro-batch that is repeated adds nothing."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    writer = activity.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(path)
