"""The whole batch run: staging, risk history, mart, tests."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.reporting import run_suite
from tidemark.plans import staging
from tidemark.plans.checks import MART, declared_tests
from tidemark.plans.mart import unified_payment_intelligence
from tidemark.plans.risk import RISK_RULES, risk_flagging
from tidemark.session import staged
from tidemark.sources.files import consolidate_batch
from tidemark.sources.tables import materialize_table, replace_partitions, run_snapshot

STAGING = {
    "stg_payments": ("raw_payments", staging.stg_payments),
    "stg_accounts": ("raw_accounts", staging.stg_accounts),
    "stg_risk_feed": ("raw_risk_feed", staging.stg_risk_feed),
    "stg_fraud_cases": ("raw_fraud_cases", staging.stg_fraud_cases),
}
HISTORY, REPORT = "account_risk_snapshot", "test_report"


def stage_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(raw[source]) for name, (source, build) in STAGING.items()}


def run_batch(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    as_of,
    schema: str = "",
    start_date=None,
    end_date=None,
    folder: str | None = None,
    stop_on_error: bool = True,
) -> DataFrame:
    """Run all steps in order against stored tables and return the stored test report.

    ``raw`` holds the four raw tables (``load_raw`` reads landed files), ``schema``
    is put before the table names (``"mart_db."``). The tests are run and their
    report stored; then a failing test of severity error ends the run, unless
    ``stop_on_error`` is off.
    """
    stored = {name: materialize_table(df, schema + name, folder=folder) for name, df in stage_tables(raw).items()}
    flagged = risk_flagging(stored["stg_risk_feed"])
    history = run_snapshot(spark, schema + HISTORY, flagged, RISK_RULES, as_of, folder)
    mart = unified_payment_intelligence(
        stored["stg_payments"], stored["stg_accounts"], history, stored["stg_fraud_cases"], start_date, end_date
    )
    stored[MART] = materialize_table(mart, schema + MART, folder=folder)
    report = materialize_table(run_suite(stored, declared_tests()), schema + REPORT, folder=folder)
    failed = [r.test_name for r in report.filter("status = 'error'").select("test_name").collect()]
    if failed and stop_on_error:
        raise RuntimeError(f"data tests failed: {', '.join(sorted(failed))}")
    return report


def load_raw(spark: SparkSession, landed: str, schema: str = "", folder: str | None = None) -> dict[str, DataFrame]:
    """The landed files as stored raw tables; the first error ends the load."""
    loaded = {}

    def store(df, table):
        loaded[table] = materialize_table(df, schema + table, folder=folder)
        return loaded[table]

    consolidate_batch(spark, landed, store)
    return loaded


# Layout column of a stored mart: the first day of the payment's period.
PERIOD = "payment_period"


def _with_period(mart: DataFrame, unit: str) -> DataFrame:
    return mart.withColumn(PERIOD, F.date_trunc(unit, "timestamp").cast("date"))


def store_mart(mart: DataFrame, table: str, unit: str = "day", folder: str | None = None) -> DataFrame:
    """The mart as a table partitioned by period of payment (``day``, ``month`` ...).

    Rows are dealt by period; adaptive execution splits a large period over tasks and
    puts small ones together. Payments without a time have a partition of their own.
    """
    return materialize_table(_with_period(mart, unit).hint("rebalance", PERIOD), table, [PERIOD], folder)


def stored_window(spark: SparkSession, table: str, start_date: str, end_date: str, unit: str = "day") -> DataFrame:
    """Rows of the partitions that ``[start_date, end_date)`` touches; the scan lists no other."""
    first = F.date_trunc(unit, F.lit(start_date).cast("timestamp_ntz")).cast("date")
    last = F.date_trunc(unit, F.lit(end_date).cast("timestamp_ntz") - F.expr("interval 1 microsecond")).cast("date")
    return spark.table(table).filter((F.col(PERIOD) >= first) & (F.col(PERIOD) <= last))


def date_range_rebuild(
    spark: SparkSession, table: str, build: Callable[[str, str], DataFrame], start_date: str, end_date: str, unit: str = "day"
) -> DataFrame:
    """Rebuild the payments of ``[start_date, end_date)`` of a mart stored by ``store_mart``.

    ``build(start_date, end_date)`` gives the window's rows, cut at the source. Only
    the partitions that the window touches are read, for their rows beyond its ends,
    and written; a partition that has no rows any more is dropped. All others keep
    their files. A run that failed midway can be repeated. An empty window changes nothing.
    """
    if str(start_date) >= str(end_date):
        return spark.table(table)
    touched = stored_window(spark, table, start_date, end_date, unit)
    kind = touched.schema["timestamp"].dataType
    low, high = (F.lit(str(v)).cast(kind) for v in (start_date, end_date))
    beyond = touched.filter((F.col("timestamp") < low) | (F.col("timestamp") >= high))
    rows = beyond.unionByName(_with_period(build(start_date, end_date), unit))
    rewritten = staged(spark, "window")(rows.hint("rebalance", PERIOD))
    return replace_partitions(rewritten, table, touched.select(PERIOD).distinct())
