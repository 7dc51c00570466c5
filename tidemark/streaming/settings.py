"""Session settings of stateful streams."""

from pyspark.sql import SparkSession

from tidemark.session import runtime_settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful_stream(spark: SparkSession, state_partitions: int, large_state: bool = False):
    """Context in which a stateful query is started for the first time.

    The number of state partitions stays fixed for the life of the checkpoint.
    Large state belongs into RocksDB on the executors' disks.
    """
    settings = {"spark__sql__shuffle__partitions": state_partitions}
    if large_state:
        settings["spark__sql__streaming__stateStore__providerClass"] = ROCKSDB
    return runtime_settings(spark, **settings)
