"""Landed CSV files and seeds."""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import LANDED_FILES


def load_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a fixed schema; a cell that does not parse is null."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def consolidate_batch(spark: SparkSession, folder: str, store, files=None) -> dict[str, int]:
    """Load all landed files through ``store(df, table) -> stored DataFrame``.

    The first error ends the job. Rows are counted in the stored table, so the
    file is read once.
    """
    counts = {}
    for file_name, (table, schema) in (files or LANDED_FILES).items():
        stored = store(load_csv_typed(spark, os.path.join(folder, file_name), schema), table)
        counts[table] = stored.count()
    return counts


def load_seed(spark: SparkSession, path: str, column_types: dict[str, str] | None = None, delimiter: str = ",") -> DataFrame:
    """Small CSV with inferred types and per-column overrides; an empty field is null."""
    options = {"header": "true", "sep": delimiter, "nullValue": ""}
    overrides = {c.lower(): t for c, t in (column_types or {}).items()}
    inferred = spark.read.options(**options).option("inferSchema", "true").csv(path)
    # Overridden columns are read as text first, so that nothing is lost to inference.
    fields = [
        T.StructField(f.name, T.StringType() if f.name.lower() in overrides else f.dataType, True)
        for f in inferred.schema
    ]
    typed = spark.read.options(**options).schema(T.StructType(fields)).csv(path)
    return typed.select(*[F.col(f.name).cast(overrides.get(f.name.lower(), f.dataType)).alias(f.name) for f in fields])


def reload_seed(spark: SparkSession, seed: DataFrame, table: str, full_refresh: bool = False) -> DataFrame:
    """Seed into its table: new shape on full refresh, else the rows are replaced in the old shape."""
    if full_refresh or not spark.catalog.tableExists(table):
        seed.write.mode("overwrite").saveAsTable(table)
    else:
        seed.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    return spark.table(table)
