"""Rows that wait for a deadline, kept as a few files instead of state rows.

What a micro-batch leaves waiting is written once, as a segment with the latest
deadline in it. A segment is out of use when the watermark has passed that
deadline; until then its rows are read, never rewritten, but for merging: ``fan``
segments of one level become one of the next, without rows that are done. So the
segments in use are few (``fan`` a level, levels growing with the logarithm of the
number of micro-batches), and a row is rewritten once a level at most.

All paths carry the number of the micro-batch that wrote them, and a micro-batch
reads only what the one before it recorded: a retry overwrites its own files and
finds the same input.
"""

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DUE = "_due"
# A watermark before any event: nothing has been reached.
NOT_YET = -(2**63)


@dataclass
class Segment:
    path: str
    level: int
    last: int


@dataclass
class Ledger:
    """What one micro-batch hands to the next: greatest moments seen, watermark, segments in use."""

    seen: dict[str, int] = field(default_factory=dict)
    watermark: int = NOT_YET
    segments: dict[str, list[Segment]] = field(default_factory=dict)
    unused: list[str] = field(default_factory=list)


def read_ledger(spark: SparkSession, root: str, epoch: int) -> Ledger:
    """The ledger after micro-batch ``epoch``; an empty one before the first."""
    if epoch < 0:
        return Ledger()
    kept = json.loads(spark.read.text(f"{root}/ledger/{epoch}").first()[0])
    segments = {kind: [Segment(**s) for s in found] for kind, found in kept.pop("segments").items()}
    return Ledger(**kept, segments=segments)


def write_ledger(spark: SparkSession, root: str, epoch: int, before: Ledger, after: Ledger) -> None:
    """Record the ledger, with the files that this micro-batch was the last to read."""
    used = {s.path for found in after.segments.values() for s in found}
    after.unused = sorted({s.path for found in before.segments.values() for s in found} - used)
    value = json.dumps(after, default=lambda o: o.__dict__)
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/ledger/{epoch}")


def remove_unused(spark: SparkSession, root: str, epoch: int, before: Ledger) -> None:
    """Delete what the micro-batch before the last one read for the last time.

    The ledger ``before`` was written by a finished micro-batch, so no retry reads
    these files again. What only that micro-batch itself used goes too.
    """
    outdated = [*before.unused, f"{root}/ledger/{epoch - 2}", f"{root}/found/{epoch - 1}"] if epoch > 1 else before.unused
    for path in outdated:
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def stored_at(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_segments(spark: SparkSession, segments: list[Segment], schema) -> DataFrame:
    """Rows of the segments; no rows without a segment."""
    if not segments:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[s.path for s in segments])


def add_segment(rows: DataFrame, root: str, kind: str, epoch: int, ledger: Ledger) -> DataFrame:
    """Write rows (with a deadline in ``DUE``) as a segment and return what was written."""
    stored, segment = _written(rows, f"{root}/{kind}/{epoch}-0", 0)
    if segment:
        ledger.segments.setdefault(kind, []).append(segment)
    return stored


def _written(rows: DataFrame, path: str, level: int) -> tuple[DataFrame, Segment | None]:
    seen = Observation()
    stored = stored_at(rows.hint("rebalance").observe(seen, F.max(DUE).alias("last")), path)
    last = seen.get["last"]
    return stored, None if last is None else Segment(path, level, last)


def retire(ledger: Ledger) -> None:
    """Give up segments all of whose deadlines the watermark has passed."""
    for kind, found in ledger.segments.items():
        ledger.segments[kind] = [s for s in found if s.last >= ledger.watermark]


def merge_segments(spark: SparkSession, root: str, kind: str, schema, epoch: int, ledger: Ledger, fan: int, still_needed) -> None:
    """Merge ``fan`` segments of a level into one of the next, keeping what ``still_needed`` returns."""
    level = 0
    while True:
        found = ledger.segments.get(kind, [])
        here = [s for s in found if s.level == level]
        if not any(s.level >= level for s in found):
            return
        if len(here) >= fan:
            rows = still_needed(read_segments(spark, here, schema).filter(F.col(DUE) >= ledger.watermark))
            _, merged = _written(rows, f"{root}/{kind}/{epoch}-{level + 1}", level + 1)
            ledger.segments[kind] = [s for s in found if s.level != level] + ([merged] if merged else [])
        level += 1
