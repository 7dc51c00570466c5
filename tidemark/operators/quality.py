"""Data tests. Each returns the failing rows of a table as a DataFrame."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import dateadd
from tidemark.functions.scalars import NUMERIC, cast_to
from tidemark.operators.skew import HOT_ROWS, adjacent_values, replicate


def _condition(text: str | None) -> Column:
    return F.expr(text) if text else F.lit(True)


# --- one column ------------------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values seen more than once."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count("*").alias("n_records")).filter("n_records > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Values outside the list with their count; null passes."""
    outside = df.filter(~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    return df.filter(F.col(column).isin(list(values))).select(F.col(column).alias("value_field")).distinct()


def is_after(df: DataFrame, column: str, other: str) -> DataFrame:
    """Rows where the first moment lies before the second; null passes."""
    return df.filter(F.col(column) < F.col(other))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    value, failed = F.col(column), F.lit(False)
    low, high = (F.expr(v) if isinstance(v, str) else F.lit(v) for v in (min_value, max_value))
    if min_value is not None:
        failed = failed | (value < low if inclusive else value <= low)
    if max_value is not None:
        failed = failed | (value > high if inclusive else value >= high)
    return df.filter(failed)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows the expression is false for; null passes. With a column it stands before the expression."""
    return df.filter(F.expr(f"not ({column + ' ' if column else ''}{expression})"))


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.filter(F.col(actual) != F.col(expected))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    value = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.select(value.alias(column)).filter(F.col(column) == "")


# --- whole tables and groups -----------------------------------------------------


def row_count(df: DataFrame, min_rows: int = 1) -> DataFrame:
    """The row count when it is under ``min_rows``."""
    return df.agg(F.count("*").alias("total_rows")).filter(F.col("total_rows") < min_rows)


def unique_combination(df: DataFrame, columns) -> DataFrame:
    """Column tuples seen more than once; nulls group together."""
    return df.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")


def at_least_one(df: DataFrame, column: str, group_by=()) -> DataFrame:
    """Groups (or the table) without any non-null value.

    Over the whole table one non-null row answers it, so the scan stops early.
    """
    if not group_by:
        probe = df.select(column).filter(F.col(column).isNotNull()).limit(1)
        return probe.agg(F.count(column).alias("filler_column")).filter("filler_column = 0")
    counted = df.groupBy(*group_by).agg(F.count(column).alias("filler_column"))
    return counted.filter("filler_column = 0")


def not_constant(df: DataFrame, column: str, group_by=()) -> DataFrame:
    """Groups (or the table) with exactly one distinct value; all null passes.

    One distinct value means smallest and largest agree, which needs no distinct
    and combines map-side.
    """
    spread = df.groupBy(*group_by).agg(
        F.when(F.min(column) == F.max(column), F.lit(1).cast("long")).alias("filler_column")
    )
    return spread.filter(F.col("filler_column").isNotNull())


def not_null_proportion(df: DataFrame, column: str, at_least, at_most=1, group_by=()) -> DataFrame:
    """Groups (or the table) whose share of non-null values is outside the limits."""
    share = F.count(column).cast("double") / F.count("*").cast("double")
    found = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    value = F.col("not_null_proportion")
    return found.filter((value < F.lit(at_least).cast("double")) | (value > F.lit(at_most).cast("double")))


def recency(
    df: DataFrame, column: str, part: str, interval: int, now, ignore_time_component: bool = False, group_by=()
) -> DataFrame:
    """Groups (or the table) whose latest moment is older than ``now`` minus the interval.

    ``now`` is given, so a run can be repeated. An empty table passes.
    """
    kind = "date" if ignore_time_component else "timestamp_ntz"
    moment = F.lit(str(now)).cast("timestamp_ntz")
    latest = df.groupBy(*group_by).agg(F.max(column).cast(kind).alias("most_recent"))
    latest = latest.withColumn("threshold", dateadd(part, F.lit(-interval), moment).cast(kind))
    return latest.filter("most_recent < threshold")


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, part: str | None = None, group_by=(), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows that do not follow the previous value by exactly the interval; the first row passes."""
    group_by = list(group_by)
    found, collapsed = adjacent_values(df, group_by, [column], column, ahead=False, hot_rows=hot_rows)
    previous = F.col("_adjacent")
    wanted = dateadd(part, F.lit(interval), previous) if part else previous + interval
    failed = found.filter(~(F.col(column) == wanted))
    failed = failed.withColumnRenamed("_adjacent", f"previous_{column}").drop("_edge")
    return replicate(failed, "_copies") if collapsed else failed


# How the upper bound must relate to the next lower bound, and result column wording.
GAP_RULES = {
    "allowed": ("less_than_or_equal_to", lambda a, b: a <= b),
    "not_allowed": ("equal_to", lambda a, b: a == b),
    "required": ("less_than", lambda a, b: a < b),
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Ranges that overlap the next one, break the gap rule, or are empty, reversed or without a bound."""
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(GAP_RULES)}, got {gaps!r}")
    words, follows = GAP_RULES[gaps]
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    groups = ["partition_by_col"] if partition_by else []
    shaped = df.select(
        *([F.col(partition_by).alias("partition_by_col")] if partition_by else []),
        F.col(lower).alias("lower_bound"),
        F.col(upper).alias("upper_bound"),
    )
    found, collapsed = adjacent_values(shaped, groups, ["lower_bound", "upper_bound"], "lower_bound", hot_rows=hot_rows)
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("_adjacent")
    ordered = low <= high if zero_length_range_allowed else low < high
    ordered_name, follows_name = f"lower_bound_{length_words}_upper_bound", f"upper_bound_{words}_next_lower_bound"
    checked = (
        found.withColumn(ordered_name, F.coalesce(ordered, F.lit(False)))
        .withColumn(follows_name, F.coalesce(follows(high, following), F.col("_edge")))
        .withColumnRenamed("_adjacent", "next_lower_bound")
        .withColumnRenamed("_edge", "is_last_record")
    )
    failed = checked.filter(~(F.col(ordered_name) & F.col(follows_name)))
    return replicate(failed, "_copies") if collapsed else failed


# --- two tables ------------------------------------------------------------------


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """One row per child row whose key has no parent; null keys pass."""
    child = df.select(F.col(column).alias("from_field")).filter(F.col("from_field").isNotNull())
    parent = to.select(F.col(field).alias("_to"))
    return child.join(parent, F.col("from_field") == F.col("_to"), "left_anti")


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str | None = None, to_condition: str | None = None
) -> DataFrame:
    """Like :func:`relationships` for the rows both conditions keep; ``right_id`` is always null."""
    child = df.filter(_condition(from_condition)).select(F.col(column).alias("id")).filter(F.col("id").isNotNull())
    parent = to.filter(_condition(to_condition)).select(F.col(field).alias("_to"))
    orphans = child.join(parent, F.col("id") == F.col("_to"), "left_anti")
    return orphans.withColumn("right_id", F.lit(None).cast(to.schema[field].dataType))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Value and count pairs that only one side has; null equals null.

    Both sides are counted before they meet, so the comparison moves one row per value.
    """
    a = df.groupBy(F.col(column).alias(column)).agg(F.count("*").alias("num_rows"))
    b = to.groupBy(F.col(field).alias(column)).agg(F.count("*").alias("num_rows"))
    return _one_sided(a, b).drop("_side")


def _one_sided(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that only one side has, with ``_side`` 1 for a and 2 for b.

    One grouping of the tagged union replaces two set differences.
    """
    sides = F.bit_or(F.col("_tag")).alias("_side")
    tagged = a.withColumn("_tag", F.lit(1)).unionByName(b.withColumn("_tag", F.lit(2)))
    return tagged.groupBy(*a.columns).agg(sides).filter("_side in (1, 2)")


def _grouped_counts(df, compare, group_by, marker, names):
    """Counts of both tables per group, joined on equal (never null) groups."""
    sides = []
    for table, side, name in ((df, "a", names[0]), (compare, "b", names[1])):
        counted = table.groupBy(*group_by).agg(F.count("*").alias(name))
        sides.append(
            counted.select(
                F.lit(1).alias(f"{marker}_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in group_by], name
            )
        )
    a, b = sides
    condition = a[f"{marker}_a"] == b[f"{marker}_b"]
    for c in group_by:
        condition = condition & (a[f"{c}_a"] == b[f"{c}_b"])
    keys = [f"{c}_{side}" for c in [marker, *group_by] for side in "ab"]
    return a.join(b, condition, "full").select(*keys, *names)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by=()) -> DataFrame:
    """All groups with the distance of their counts.

    Failures are ``EQUAL_ROWCOUNT_FAILURES`` over it; a group on one side only
    has no distance and does not fail.
    """
    # Fixed value: stem of the constant join column in the result.
    marker = "id_dbtutils_test_equal_rowcount"
    found = _grouped_counts(df, compare, list(group_by), marker, ("count_a", "count_b"))
    return found.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by=()) -> DataFrame:
    """All groups with a delta: the surplus if there are more rows, 1 if as many, 0 if fewer."""
    # Fixed value: stem of the constant join column in the result.
    marker = "id_dbtutils_test_fewer_rows_than"
    ours, theirs = "count_our_model", "count_comparison_model"
    found = _grouped_counts(df, compare, list(group_by), marker, (ours, theirs))
    surplus = F.col(ours) - F.col(theirs)
    return found.withColumn("row_count_delta", F.when(surplus > 0, surplus).when(surplus == 0, 1).otherwise(0))


EQUAL_ROWCOUNT_FAILURES = "sum(coalesce(diff_count, 0))"
FEWER_ROWS_FAILURES = "sum(coalesce(row_count_delta, 0))"
EQUALITY_FAILURES = (
    "count(*) + coalesce(abs(sum(case when which_diff = 'a_minus_b' then 1 else 0 end)"
    " - sum(case when which_diff = 'b_minus_a' then 1 else 0 end)), 0)"
)


def equality(
    df: DataFrame, compare: DataFrame, compare_columns=None, exclude_columns=None, precision: int | None = None
) -> DataFrame:
    """Distinct rows only one side has, tagged by side; failures are ``EQUALITY_FAILURES`` over them.

    ``precision`` rounds number columns, after a cast to six decimal places.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        columns = list(compare_columns)
    else:
        skip = {c.lower() for c in exclude_columns or ()}
        columns = [c for c in df.columns if c.lower() not in skip]
        if {c.lower() for c in columns} != {c.lower() for c in compare.columns if c.lower() not in skip}:
            raise ValueError("the two tables have different columns, choose some with compare_columns")

    def shaped(table):
        def column(c):
            kind = df.schema[c].dataType
            rounds = precision is not None and isinstance(kind, (T.FractionalType,))
            return (F.round(cast_to(c, NUMERIC), precision) if rounds else F.col(c)).alias(c)

        return table.select(*[column(c) for c in columns])

    found = _one_sided(shaped(df), shaped(compare))
    side = F.when(F.col("_side") == 1, "a_minus_b").otherwise("b_minus_a")
    return found.select(side.alias("which_diff"), *columns)


def fraud_counts_match(mart: DataFrame, fraud_cases: DataFrame) -> DataFrame:
    """The two counts of distinct fraud payments when they differ."""
    ids = mart.filter("is_fraud_flag").select("payment_id", F.lit(1).alias("_tag")).unionByName(
        fraud_cases.select("payment_id", F.lit(2).alias("_tag"))
    )
    # Distinct ids first (combined map-side), then two plain sums.
    per_id = ids.filter(F.col("payment_id").isNotNull()).groupBy("payment_id").agg(F.bit_or("_tag").alias("_tags"))

    def having(tag):
        return F.coalesce(F.sum(F.when(F.col("_tags").bitwiseAND(tag) > 0, 1)), F.lit(0)).cast("long")

    counts = per_id.agg(having(1).alias("final_model_count"), having(2).alias("staging_model_count"))
    return counts.filter("final_model_count != staging_model_count")
