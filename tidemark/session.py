"""Session settings and the shared working folder."""

import os
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Skewed sort-merge joins are split at run
# time; the force flag keeps the split even where it costs one more exchange,
# which is the right trade when one key holds a large share of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rank filters shrink groups below the shuffle up to this limit.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def runtime_settings(spark: SparkSession, **settings):
    """Set runtime settings (dots written as ``__``) for the time of a block."""
    wanted = {key.replace("__", "."): str(value) for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    All executors see it. Only on a single machine, as in tests, a temporary folder
    may take its place; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _folder_of_this_machine()


@cache
def _folder_of_this_machine() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return os.path.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")


def staged(spark: SparkSession, purpose: str) -> Callable[[DataFrame], DataFrame]:
    """A function that writes a result to the shared folder and reads it back.

    It cuts the lineage of steps that are read more than once; the files outlive
    lost executors.
    """

    def store(df: DataFrame) -> DataFrame:
        path = fresh_folder(spark, purpose)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return store
