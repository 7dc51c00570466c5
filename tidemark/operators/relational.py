"""Relational helpers: projections, pivots, unions of unlike tables, deduplication."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import nullcheck
from tidemark.names import SOURCE_RELATION


def _lower(names):
    return {name.lower() for name in names or ()}


# --- projections -----------------------------------------------------------------


def filtered_columns(df: DataFrame, exclude=()) -> list[str]:
    """Column names without the excluded ones, case-insensitive."""
    skip = _lower(exclude)
    return [c for c in df.columns if c.lower() not in skip]


def star_except(df: DataFrame, exclude=(), prefix: str = "", suffix: str = "") -> list[Column]:
    """Columns to select: all but ``exclude``, renamed when a prefix or suffix is given."""
    return [df[c].alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, exclude)]


def nullcheck_table(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every text column."""
    return df.select(
        *[
            nullcheck(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


def group_by_n(df: DataFrame, n: int):
    """Grouping by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


# --- rows to columns and back ----------------------------------------------------

_COMPARE = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def pivot_columns(
    column,
    values,
    agg="sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, for use in ``groupBy(...).agg(*columns)``.

    A value that never occurs gives the aggregate of ``else_value`` (0), not null.
    All of them are partial aggregates of one pass. ``then_value`` and
    ``else_value`` may be columns.
    """
    column = F.col(column) if isinstance(column, str) else column
    then_value, else_value = (v if isinstance(v, Column) else F.lit(v) for v in (then_value, else_value))
    out = []
    for value in values:
        picked = F.when(_COMPARE[cmp](column, F.lit(value)), then_value).otherwise(else_value)
        name = f"{prefix}{value}{suffix}"
        out.append(F.call_function(agg, picked).alias(name) if not distinct else _distinct(agg, picked).alias(name))
    return out


def _distinct(agg: str, value: Column) -> Column:
    if agg in ("min", "max", "any_value"):
        return F.call_function(agg, value)
    if agg not in ("sum", "count"):
        raise ValueError(f"no distinct form of {agg}")
    return F.sum_distinct(value) if agg == "sum" else F.count_distinct(value)


def unpivot(
    df: DataFrame, cast_to="string", exclude=(), remove=(), field_name: str = "field_name", value_name: str = "value"
) -> DataFrame:
    """Columns to rows: keep ``exclude``, drop ``remove``, cast the rest to one type.

    Null values keep their row. One scan, whatever the number of columns.
    """
    values = filtered_columns(df, [*exclude, *remove])
    if not values:
        raise ValueError("no columns left to unpivot")
    cast = df.select(*exclude, *[F.col(c).cast(cast_to).alias(c) for c in values])
    return cast.unpivot(list(exclude), values, field_name, value_name)


# --- unions ----------------------------------------------------------------------


def union_relations(
    relations: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include=(),
    exclude=(),
    source_column_name: str | None = SOURCE_RELATION,
    where: str | None = None,
) -> DataFrame:
    """Union of tables with different columns.

    The columns are the superset in first-seen order, each with the type it has
    where first seen (or the override); a table without the column gives null.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = column_override or {}
    keep, skip = _lower(include), _lower(exclude)
    types: dict[str, object] = {}
    for df in relations.values():
        for field in df.schema:
            low = field.name.lower()
            if (keep and low not in keep) or low in skip:
                continue
            types.setdefault(field.name, override.get(field.name, field.dataType))
    if not types:
        raise ValueError("no columns to union")

    def shaped(name, df):
        present = set(df.columns)
        columns = [(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        if source_column_name is not None:
            columns.insert(0, F.lit(name).alias(source_column_name))
        return (df.filter(where) if where else df).select(*columns)

    return reduce(DataFrame.unionByName, [shaped(name, df) for name, df in relations.items()])


def _like(pattern: str):
    """Regular expression for a case-insensitive SQL LIKE pattern."""
    body = "".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in pattern)
    return re.compile(body, re.IGNORECASE | re.DOTALL)


def relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> dict[str, DataFrame]:
    """Tables whose schema and name match LIKE patterns, minus an excluded name pattern.

    Temporary views have no schema; they match an empty one.
    """
    schema_like, table_like, skip = _like(schema_pattern), _like(table_pattern), _like(exclude)
    # The catalogue narrows the names down where the pattern has only plain characters.
    plain = re.fullmatch(r"[\w%]*", table_pattern)
    listed = table_pattern.replace("%", "*").replace("_", ".") if plain else "*"
    databases = [d.name for d in spark.catalog.listDatabases() if schema_like.fullmatch(d.name)]
    if schema_like.fullmatch("") and spark.catalog.currentDatabase() not in databases:
        databases.append(spark.catalog.currentDatabase())  # lists the temporary views
    found = {}
    for database in databases:
        for table in spark.catalog.listTables(database, listed):
            schema = "" if table.isTemporary else database
            if not schema_like.fullmatch(schema) or not table_like.fullmatch(table.name):
                continue
            if skip.fullmatch(table.name):
                continue
            name = f"{schema}.{table.name}" if schema else table.name
            found.setdefault(name, spark.table(name))
    return dict(sorted(found.items()))


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> dict[str, DataFrame]:
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def union_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "", **union_options
) -> DataFrame:
    """Union of the tables found by :func:`relations_by_pattern`."""
    relations = relations_by_pattern(spark, schema_pattern, table_pattern, exclude)
    if not relations:
        raise ValueError(f"no table matches {schema_pattern}.{table_pattern}")
    return union_relations(relations, **union_options)


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


# --- rows of a group -------------------------------------------------------------


def deduplicate(df: DataFrame, partition_by, order_by) -> DataFrame:
    """First row of each partition under the order; null keys form one partition.

    The rank filter is pushed below the shuffle as a group limit, so a hot
    partition sends one row per map task.
    """
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def listagg(measure: str, delimiter: str, order_by: str | None = None) -> Column:
    """Texts of a group joined in the order of an SQL order clause; nulls are skipped.

    The result is one value per group by definition; use :func:`listagg_first`
    where only the first entries are wanted.
    """
    order = f" within group (order by {order_by})" if order_by else ""
    return F.expr(f"listagg({measure}, '{delimiter}'){order}")


def listagg_first(
    df: DataFrame, keys, measure: str, delimiter: str, order_by, limit: int, name: str = "list"
) -> DataFrame:
    """Per group, the first ``limit`` texts joined.

    Null texts take a place among the first but are not printed. The rank filter
    runs below the shuffle, so no group is ever collected whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    first = df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= limit)
    joined = F.expr(f"listagg({measure}, '{delimiter}') within group (order by _rank)")
    return first.groupBy(*keys).agg(F.coalesce(joined, F.lit("")).alias(name))


# --- values to steer other steps -------------------------------------------------


def column_values(
    df: DataFrame | None,
    column,
    order_by: list[Column] | None = None,
    max_records: int | None = None,
    default=None,
    where: str | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Distinct values of a column as column ``value``, most frequent first.

    Null is a value. Ties are broken by the value. ``order_by`` may use the
    columns ``value`` and ``n``. Without a table (``df`` is None) the default
    values are returned.
    """
    if df is None:
        if default is None or spark is None:
            raise ValueError("table does not exist and no default values (with a session) were given")
        return spark.createDataFrame([(v,) for v in default], "value string")
    source = df.filter(where) if where else df
    column = F.col(column) if isinstance(column, str) else column
    counted = source.groupBy(column.alias("value")).agg(F.count("*").alias("n"))
    order_by = order_by or [F.col("n").desc(), F.col("value").asc_nulls_last()]
    ordered = counted.orderBy(*order_by)
    return (ordered.limit(max_records) if max_records is not None else ordered).select("value")


def single_value(df: DataFrame, default=None) -> DataFrame:
    """One row ``value``: first column of the first row, or the default without rows."""
    first = df.select(F.col(df.columns[0]).alias("value")).limit(1)
    row = first.agg(F.count("*").alias("n"), F.first("value").alias("value"))
    return row.select(F.when(F.col("n") == 0, F.lit(default)).otherwise(F.col("value")).alias("value"))


def results_as_dict(df: DataFrame, max_rows: int = 10_000) -> dict[str, tuple]:
    """Column name to the tuple of its values, nulls kept, on the driver.

    Meant for small control tables: more than ``max_rows`` rows is an error.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows, keep it a DataFrame")
    return {name: tuple(row[i] for row in rows) for i, name in enumerate(df.columns)}
