"""Session set-up shared by the text operators."""

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, fresh_folder

# Rows and bytes of one Arrow batch: texts can be long, so a batch is bounded by
# bytes as well as by rows.
BATCH_ROWS = 1_000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings, and the package's code for executors that lack it."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if not getattr(context, "_tidemark_shipped", False):
        context.addPyFile(_package_archive())
        context._tidemark_shipped = True
    return spark


def _package_archive() -> str:
    """The package as a zip; Spark's file server hands it to the executors."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    return target


_remembered: dict = {}


def remembered(key, make):
    """What a Python worker keeps from task to task, such as a table of seen words.

    One thing at a time: a worker serves many steps, and its memory is one task's.
    """
    if key not in _remembered:
        _remembered.clear()
        _remembered[key] = make()
    return _remembered[key]


def forget():
    """Gives back what an earlier step remembered."""
    _remembered.clear()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: later steps neither repeat the
    work nor depend on executors that may be lost."""
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str | Column) -> Column:
    """The text's bytes, empty for null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")
