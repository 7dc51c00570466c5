"""Stored tables: build aside and swap in, incremental runs, materialized results."""

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.names import SCD_ID
from tidemark.operators import history, incremental
from tidemark.session import runtime_settings, staged


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether a stored table exists, after undoing a swap that stopped between its two renames."""
    if spark.catalog.tableExists(table):
        return True
    backup = f"{table}__old"
    if not spark.catalog.tableExists(backup):
        return False
    spark.sql(f"alter table {backup} rename to {table}")
    return True


def materialize_table(df: DataFrame, table: str, partition_by=(), folder: str | None = None) -> DataFrame:
    """Build the result beside the table and swap it in.

    The query may read the table it replaces; a failed build leaves it untouched.
    With a ``folder`` every version has its own folder below it and only the name
    moves; what replaced versions leave there is the caller's to clean. A
    partitioned table always works so (below the warehouse by default), because
    the partitions of a managed table would not follow its new name.
    """
    spark = df.sparkSession
    replaces = table_exists(spark, table)
    aside, backup = f"{table}__next", f"{table}__old"
    spark.sql(f"drop table if exists {aside}")
    spark.sql(f"drop table if exists {backup}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        folder = folder or spark.conf.get("spark.sql.warehouse.dir")
    if folder:
        writer = writer.option("path", f"{folder}/{table}-{uuid.uuid4().hex}")
    writer.saveAsTable(aside)
    if replaces:
        spark.sql(f"alter table {table} rename to {backup}")
    spark.sql(f"alter table {aside} rename to {table}")
    spark.sql(f"drop table if exists {backup}")
    return spark.table(table)


def refresh_materialized(spark: SparkSession, build: Callable[[], DataFrame], table: str) -> DataFrame:
    """Create or refresh a stored result from the function that defines it."""
    return materialize_table(build(), table)


# --- partitions --------------------------------------------------------------------

def _in_partitions(df: DataFrame, values: DataFrame) -> DataFrame:
    """Rows in the given partitions. Plain equality lets the scan skip all other
    partitions at run time; only a null partition value needs the null-safe form."""
    columns = values.columns
    if values.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])).isEmpty():
        return df.join(values, columns, "left_semi")
    return df.join(values, _same_partition(df, values), "left_semi")


def _same_partition(left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in right.columns])


def replace_partitions(df: DataFrame, table: str, emptied_among: DataFrame | None = None) -> DataFrame:
    """Overwrite only the partitions of a partitioned table that the rows fall in.

    Of the partition values in ``emptied_among`` (a table of partition columns)
    those without rows are dropped. ``df`` is read twice then; pass a stored result.
    """
    spark = df.sparkSession
    emptied = []
    if emptied_among is not None:
        present = df.select(*emptied_among.columns).distinct()
        gone = emptied_among.distinct().join(present, _same_partition(emptied_among, present), "left_anti")
        emptied = gone.collect()  # partitions of one table, which the catalogue lists anyway
    with runtime_settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    for value in emptied:
        spec = ", ".join(f"{c}={_literal(v)}" for c, v in value.asDict().items())
        spark.sql(f"alter table {table} drop if exists partition ({spec})")
    return spark.table(table)


def _literal(value) -> str:
    if value is None:
        return "null"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


# --- stored history ----------------------------------------------------------------

# Layout column of a stored history: the run that closed a row, or that it is open.
CLOSED_IN, OPEN = "closed_in", "open"


def read_history(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(CLOSED_IN)


def run_snapshot(
    spark: SparkSession, table: str, source: DataFrame, rules: history.HistoryRules, as_of, folder: str | None = None
) -> DataFrame:
    """One snapshot run against a stored history table.

    The table is partitioned by the run that closed a row. A run reads and
    rewrites the open rows and one partition of newly closed ones; older
    partitions are neither read nor written. A run that failed midway can be
    repeated.
    """

    def laid_out(rows):
        run = F.when(history.is_open(rules), OPEN).otherwise(str(as_of))
        return rows.withColumn(CLOSED_IN, run)

    if not table_exists(spark, table):
        materialize_table(laid_out(history.initial_history(source, rules, as_of)), table, [CLOSED_IN], folder)
        return read_history(spark, table)
    stored = spark.table(table)
    still_open = stored.filter(F.col(CLOSED_IN) == OPEN).drop(CLOSED_IN)
    stage = staged(spark, "changes")
    result = laid_out(history.snapshot(still_open, source, rules, as_of, stage))
    if set(result.columns) != set(stored.columns):
        closed = stored.filter(F.col(CLOSED_IN) != OPEN)
        materialize_table(closed.unionByName(result, allowMissingColumns=True), table, [CLOSED_IN], folder)
    else:
        # Computed once; the table is then written from the staged result.
        written = staged(spark, "history")(result)
        earlier = stored.filter(F.col(CLOSED_IN) == str(as_of))
        if not earlier.isEmpty():
            # Rows an earlier run of the same time has closed stay with those closed now.
            own_id = rules.meta(SCD_ID)
            closed_now = written.filter(F.col(CLOSED_IN) != OPEN).select(own_id)
            before = staged(spark, "closed-before")(earlier.join(closed_now, own_id, "left_anti"))
            written = written.unionByName(before)
        replace_partitions(written, table, spark.createDataFrame([(OPEN,)], f"{CLOSED_IN} string"))
    return read_history(spark, table)


# --- stored incremental tables -----------------------------------------------------


def run_incremental(
    spark: SparkSession,
    table: str,
    build: Callable[[DataFrame | None], DataFrame],
    strategy: str | None = None,
    unique_key=None,
    on_schema_change: str = "ignore",
    full_refresh: bool = False,
    partition_by=(),
    folder: str | None = None,
    **options,
) -> DataFrame:
    """Incremental table: the first run and a full refresh create it, later runs apply the strategy.

    ``build`` gets the current table, or None when it builds from scratch. An
    append writes only the batch. On a partitioned table the keyed strategies
    rewrite only the partitions that hold a key of the batch or receive its rows;
    an overwrite with predicates those that hold a row to be replaced or receive one.
    """
    if full_refresh or not table_exists(spark, table):
        return materialize_table(build(None), table, partition_by, folder)
    current = spark.table(table)
    batch = build(current)
    target, columns = incremental.reconcile_schema(current, batch, on_schema_change)
    unchanged = target.schema == current.schema
    strategy = strategy or "default"
    if strategy == "default":
        strategy = "delete+insert" if unique_key else "append"
    if strategy == "append" and unchanged:
        added = incremental.append(current.limit(0), batch, columns)
        added.select(*current.columns).write.mode("append").insertInto(table)
        return spark.table(table)
    batch = staged(spark, "batch")(batch)
    if partition_by and unchanged and unique_key and strategy in ("delete+insert", "merge"):
        touched = staged(spark, "touched")(_touched_partitions(current, batch, unique_key, partition_by))
        reached = _in_partitions(current, touched)
        result = incremental.apply_strategy(reached, batch, strategy, unique_key, columns, **options)
        return replace_partitions(staged(spark, "rewritten")(result), table, touched)
    if partition_by and unchanged and strategy == "insert_overwrite" and options.get("predicates"):
        replaced = current.filter(incremental.all_hold(options["predicates"]))
        touched = replaced.select(*partition_by).unionByName(batch.select(*partition_by)).distinct()
        touched = staged(spark, "touched")(touched)
        result = incremental.insert_overwrite(_in_partitions(current, touched), batch, columns=columns, **options)
        return replace_partitions(staged(spark, "rewritten")(result), table, touched)
    result = incremental.apply_strategy(target, batch, strategy, unique_key, columns, **options)
    return materialize_table(result, table, partition_by, folder)


def _touched_partitions(current: DataFrame, batch: DataFrame, unique_key, partition_by) -> DataFrame:
    """Partitions with a key of the batch (found on the key columns alone) or with rows of the batch."""
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    holding = current.select(*dict.fromkeys([*keys, *partition_by])).join(batch.select(*keys), keys, "left_semi")
    return holding.select(*partition_by).unionByName(batch.select(*partition_by)).distinct()
