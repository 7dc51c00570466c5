"""JDBC tables. The driver jar comes with the session."""

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8) -> None:
    """Overwrite a table through ``connections`` parallel connections.

    Rows are dealt out anew, so that what comes before keeps its own parallelism.
    """
    df.repartition(connections).write.jdbc(url=url, table=table, mode="overwrite", properties=properties)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_column: str | None = None,
    partitions: int = 8,
) -> DataFrame:
    """Read a table; with a number, date or timestamp column to split on, in parallel."""
    if split_column is None:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    # The database finds the bounds; one row comes over the connection.
    bounds = f"(select min({split_column}) as low, max({split_column}) as high from {table}) bounds"
    span = spark.read.jdbc(url=url, table=bounds, properties=properties).first()
    if span.low is None or span.low == span.high:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    return spark.read.jdbc(
        url=url,
        table=table,
        column=split_column,
        lowerBound=str(span.low),
        upperBound=str(span.high),
        numPartitions=partitions,
        properties=properties,
    )
