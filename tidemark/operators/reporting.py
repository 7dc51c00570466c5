"""From failing rows to verdicts: test runs, suites, freshness, contracts, fixtures."""

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import replicate


def run_test(
    failing: DataFrame,
    fail_calc: str = "count(*)",
    warn_if: str = "!= 0",
    error_if: str = "!= 0",
    limit: int | None = None,
) -> DataFrame:
    """One row: failures, should_warn, should_error.

    A filter on the tested table goes before the test, ``limit`` after it.
    """
    rows = failing.limit(limit) if limit is not None else failing
    return rows.agg(
        F.expr(fail_calc).alias("failures"),
        F.expr(f"({fail_calc}) {warn_if}").alias("should_warn"),
        F.expr(f"({fail_calc}) {error_if}").alias("should_error"),
    )


@dataclass(frozen=True)
class TableTest:
    """A declared test: a row condition of failing rows, an aggregate that counts
    failures, a test of keys, or a function to failing rows.

    Tests given by ``row_fails`` or ``failures`` share one scan of the table, all tests
    of keys another one, whatever their number.
    """

    name: str
    table: str
    row_fails: Column | None = None
    failures: Column | None = None
    failing: Callable[[dict[str, DataFrame]], DataFrame] | None = None
    keys: "KeyTest | None" = None
    fail_calc: str = "count(*)"
    severity: str = "error"
    where: str | None = None


@dataclass(frozen=True)
class KeyTest:
    """What must hold of a column's non-null values, within the table or beside another.

    ``unique``: no value stands in two rows; failures are values. ``known``: each
    row's value stands in column ``field`` of table ``to``; failures are rows.
    ``as_many``: both columns have as many different values; one failure if not.
    Both columns have one type. A ``where`` of the test holds for its own table.
    """

    kind: str
    column: str
    to: str | None = None
    field: str | None = None


# Failures of a test of keys from the sums over its values.
KEY_FAILURES = {
    "unique": "repeated",
    "known": "orphans",
    "as_many": "if(own_values <> other_values, 1, 0)",
}


def _key_text(df: DataFrame, column: str) -> Column:
    """A value as text, equal for equal values: minus zero is zero."""
    fraction = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    return (F.col(column) + F.lit(0.0).cast(df.schema[column].dataType) if fraction else F.col(column)).cast("string")


def _key_counts(tables: dict[str, DataFrame], tests: list[TableTest]) -> DataFrame:
    """``test`` (its place) and ``failures`` of tests of keys.

    Each table is read once: a row gives one (test, value) for each test it takes part
    in. These are counted before the shuffle and grouped once for all tests.
    """
    marks: dict[str, list[Column]] = {}
    for i, t in enumerate(tests):
        sides = [(t.table, t.keys.column, t.where, 0)]
        if t.keys.to is not None:
            sides.append((t.keys.to, t.keys.field, None, 1))
            types = {tables[name].schema[column].dataType for name, column, _, _ in sides}
            if len(types) > 1:
                raise ValueError(f"{t.name}: {t.keys.column} and {t.keys.field} have different types")
        for name, column, where, side in sides:
            value = _key_text(tables[name], column)
            value = F.when(F.expr(where), value) if where else value
            mark = F.struct(F.lit(i).alias("test"), value.alias("value"), F.lit(1 - side).alias("own"), F.lit(side).alias("other"))
            marks.setdefault(name, []).append(mark)
    parts = [tables[name].select(F.inline(F.array(*found))) for name, found in marks.items()]
    values = reduce(DataFrame.unionByName, parts).filter(F.col("value").isNotNull())
    counted = values.groupBy("test", "value").agg(F.sum("own").alias("own"), F.sum("other").alias("other"))

    def total(condition: Column, amount=1) -> Column:
        return F.sum(F.when(condition, amount).otherwise(0))

    sums = counted.groupBy("test").agg(
        total(F.col("own") > 1).alias("repeated"),
        total(F.col("other") == 0, F.col("own")).alias("orphans"),
        total(F.col("own") > 0).alias("own_values"),
        total(F.col("other") > 0).alias("other_values"),
    )
    failures = F.lit(None).cast("long")
    for i, t in enumerate(tests):
        failures = F.when(F.col("test") == i, F.expr(KEY_FAILURES[t.keys.kind])).otherwise(failures)
    return sums.select("test", failures.cast("long").alias("failures"))


def _verdicts(counts: DataFrame) -> DataFrame:
    """Status per test row with columns test_name, severity, failures."""
    failed = F.col("failures") != 0
    status = F.when(failed & (F.col("severity") == "warn"), "warn").when(failed, "error").otherwise("pass")
    return counts.withColumn("status", status)


def run_suite(tables: dict[str, DataFrame], tests: list[TableTest]) -> DataFrame:
    """Report with one row per test: table_name, test_name, severity, failures, status.

    All row conditions and aggregates on a table become one aggregation, all tests of
    keys one grouping, whatever their number; the other tests run as their own
    branches of one union.
    """
    parts = []
    keyed = [t for t in tests if t.keys is not None]
    if keyed:
        known = F.array(
            *(F.struct(F.lit(t.table).alias("table_name"), F.lit(t.name).alias("test_name"), F.lit(t.severity).alias("severity")) for t in keyed)
        )
        named = tables[keyed[0].table].sparkSession.range(1).select(F.posexplode(known).alias("test", "of"))
        found = named.join(_key_counts(tables, keyed), "test", "left")  # a test without values has no counts
        parts.append(found.select("of.*", F.coalesce("failures", F.lit(0).cast("long")).alias("failures")))
    for table in dict.fromkeys(t.table for t in tests):
        fused = [t for t in tests if t.table == table and t.failing is None and t.keys is None]
        if fused:
            sums = []
            for i, t in enumerate(fused):
                if t.failures is not None:
                    if t.where:
                        raise ValueError(f"{t.name}: an aggregate takes no filter")
                    sums.append(F.coalesce(t.failures, F.lit(0)).cast("long").alias(f"_{i}"))
                    continue
                fails = t.row_fails & F.expr(t.where) if t.where else t.row_fails
                sums.append(F.coalesce(F.sum(F.when(fails, 1)), F.lit(0)).cast("long").alias(f"_{i}"))
            labels = [
                F.struct(
                    F.lit(t.table).alias("table_name"),
                    F.lit(t.name).alias("test_name"),
                    F.lit(t.severity).alias("severity"),
                    F.col(f"_{i}").alias("failures"),
                )
                for i, t in enumerate(fused)
            ]
            parts.append(tables[table].agg(*sums).select(F.inline(F.array(*labels))))
    for t in tests:
        if t.failing is not None:
            source = dict(tables)
            if t.where:
                source[t.table] = source[t.table].filter(t.where)
            counted = t.failing(source).agg(F.coalesce(F.expr(t.fail_calc), F.lit(0)).cast("long").alias("failures"))
            parts.append(
                counted.select(
                    F.lit(t.table).alias("table_name"),
                    F.lit(t.name).alias("test_name"),
                    F.lit(t.severity).alias("severity"),
                    "failures",
                )
            )
    return _verdicts(reduce(DataFrame.unionByName, parts))


def store_failures(failing: DataFrame, name: str, as_view: bool = False) -> None:
    """Keep failing rows as a table, or as a view that is computed on use."""
    if as_view:
        failing.createOrReplaceTempView(name)
    else:
        failing.write.mode("overwrite").saveAsTable(name)


# --- freshness -------------------------------------------------------------------

# Periods of a freshness threshold.
FRESHNESS_SECONDS = {"minute": 60, "hour": 3_600, "day": 86_400}


@dataclass(frozen=True)
class Freshness:
    """Age limits of a source table as (count, period); None is no limit."""

    warn_after: tuple[int, str] | None = (2, "day")
    error_after: tuple[int, str] | None = (4, "day")
    filter: str | None = None


# Limits of the raw tables.
RAW_FRESHNESS = {
    "raw_payments": Freshness((12, "hour"), (24, "hour")),
    "raw_accounts": Freshness(),
    "raw_risk_feed": Freshness(),
    "raw_fraud_cases": Freshness(),
}


def source_freshness(
    name: str, df: DataFrame, loaded_at, now, limits: Freshness = Freshness(), query: DataFrame | None = None
) -> DataFrame:
    """One row: source_name, max_loaded_at, snapshotted_at, age_seconds, status.

    ``loaded_at`` is a column of ``df``; ``query``, when given, is a one-row table
    with ``max_loaded_at`` that takes its place. A source without rows is an error.
    """
    moment = F.lit(str(now)).cast("timestamp_ntz")
    if query is None:
        rows = df.filter(limits.filter) if limits.filter else df
        latest = F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at
        query = rows.agg(F.max(latest).cast("timestamp_ntz").alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), moment)
    found = query.select(F.lit(name).alias("source_name"), "max_loaded_at", moment.alias("snapshotted_at"))
    found = found.withColumn("age_seconds", age)

    def over(limit):
        return F.lit(False) if limit is None else F.col("age_seconds") > limit[0] * FRESHNESS_SECONDS[limit[1]]

    status = (
        F.when(F.col("max_loaded_at").isNull() | over(limits.error_after), "error")
        .when(over(limits.warn_after), "warn")
        .otherwise("pass")
    )
    return found.withColumn("status", status)


# --- contracts -------------------------------------------------------------------


def schema_mismatches(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Differences in number, names and types of columns, in any order."""
    have = {f.name.lower(): f.dataType for f in actual}
    want = {f.name.lower(): f.dataType for f in declared}
    out = []
    if len(actual) != len(declared):
        out.append(f"{len(actual)} columns, declared {len(declared)}")
    for name in sorted(want.keys() - have.keys()):
        out.append(f"{name}: missing")
    for name in sorted(have.keys() - want.keys()):
        out.append(f"{name}: not declared")
    for name in sorted(have.keys() & want.keys()):
        if have[name] != want[name]:
            out.append(f"{name}: is {have[name].simpleString()}, declared {want[name].simpleString()}")
    return out


def enforce_contract(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The table with its columns in declared order; raises when it does not fit."""
    mismatches = schema_mismatches(df.schema, declared)
    if mismatches:
        raise ValueError("table does not fit its contract: " + "; ".join(mismatches))
    return df.select(*[f.name for f in declared])


def columns_match_set(df: DataFrame, column_list, transform: Callable[[str], str] = str.upper) -> DataFrame:
    """Columns only the table or only the list has, as rows (column_name, found_in)."""
    have, want = {transform(c) for c in df.columns}, {transform(c) for c in column_list}
    rows = [(c, "table") for c in sorted(have - want)] + [(c, "list") for c in sorted(want - have)]
    return df.sparkSession.createDataFrame(rows, "column_name string, found_in string")


# --- unit fixtures ---------------------------------------------------------------


def fixture(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Hand-written rows as a typed table; columns left out are null, unknown ones an error."""
    names = {f.name.lower(): f.name for f in schema}
    unknown = {c for row in rows for c in row if c.lower() not in names}
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}, accepted are {schema.names}")
    full = [{names[c.lower()]: v for c, v in row.items()} for row in rows]
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in full], schema)


def tagged_comparison(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Actual and expected rows in one table, tagged in ``actual_or_expected``."""
    columns = expected.columns
    tag = "actual_or_expected"
    return actual.select(*columns, F.lit("actual").alias(tag)).unionByName(
        expected.select(*columns, F.lit("expected").alias(tag))
    )


def fixture_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows (with multiplicity) on one side only, tagged; empty when the unit test passes."""
    columns = expected.columns
    both = tagged_comparison(actual, expected)
    surplus = F.sum(F.when(F.col("actual_or_expected") == "actual", 1).otherwise(-1))
    counted = both.groupBy(*columns).agg(surplus.alias("_surplus")).filter("_surplus != 0")
    tag = F.when(F.col("_surplus") > 0, "actual").otherwise("expected").alias("actual_or_expected")
    return replicate(counted.select(*columns, tag, F.abs("_surplus").alias("_copies")), "_copies")
