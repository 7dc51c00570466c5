"""Helpers that keep hot groups from ending up in one task.

Joins leave skew to adaptive execution, which splits an oversized partition of
the outer side at run time. Ordered windows have no such help: a window over a
group runs in one task however large the group is. The helpers here find the
few groups that are too large by a count (combined map-side), cut them into
blocks along the order columns, and stitch the block edges together.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import staged

# A group over this many rows is cut into blocks.
HOT_ROWS = 2_000_000
# Most blocks one cut makes; the bounds travel inside the plan, so this bounds their size.
MAX_BLOCKS = 4096
# Rows one output row is copied to within one task.
COPY_CHUNK = 10_000
# Most keys sent to every executor by a broadcast.
BROADCAST_KEYS = 100_000


def as_number(column: Column, data_type: T.DataType) -> Column:
    """A double that never falls when the column rises, for choosing blocks."""
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(data_type, T.StringType):
        prefix = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        return F.conv(prefix, 16, 10).cast("double")
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    raise TypeError(f"cannot cut blocks along a column of type {data_type.simpleString()}")


def quantile_bounds(df: DataFrame, number: Column, blocks: int) -> list[float]:
    """At most ``blocks - 1`` rising bounds that cut the rows into even parts.

    One aggregate with a mergeable sketch; only the bounds come to the driver.
    """
    blocks = min(blocks, MAX_BLOCKS)
    if blocks < 2:
        return []
    shares = [i / blocks for i in range(1, blocks)]
    row = df.agg(F.percentile_approx(number, shares, max(10_000, 4 * blocks)).alias("bounds")).first()
    return sorted(set(row.bounds or []))


def block_of(number: Column, bounds: list[float]) -> Column:
    """How many bounds are at or below the number; null counts as the greatest."""
    if not bounds:
        return F.when(number.isNull(), 1).otherwise(0)
    step = max(1, math.isqrt(len(bounds)))
    runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def at_or_below(values: Column) -> Column:
        return F.size(F.filter(values, lambda bound: bound <= number))

    coarse = at_or_below(F.array(*[F.lit(run[0]) for run in runs]))
    table = F.array(*[F.array(*[F.lit(b) for b in run]) for run in runs])
    fine = at_or_below(F.element_at(table, F.greatest(coarse, F.lit(1))))
    inside = F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)
    return F.when(number.isNull(), len(bounds) + 1).otherwise(inside)


def replicate(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as column ``copies`` says, the copies spread over tasks."""
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(1), F.ceil(F.col(copies) / COPY_CHUNK))))
    spread = chunks.repartition(*[F.col(c) for c in df.columns], "_chunk")
    here = F.least(F.lit(COPY_CHUNK), F.col(copies) - (F.col("_chunk") - 1) * COPY_CHUNK)
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), here.cast("int")))).drop("_chunk", "_copy", copies)


def _ordering(columns, ahead: bool):
    """Nulls are the greatest values in both directions."""
    return [F.col(c).asc_nulls_last() if ahead else F.col(c).desc_nulls_first() for c in columns]


def in_blocks(df: DataFrame, groups: list[str], order: list[str], blocks: int, ahead: bool = True) -> DataFrame:
    """Distinct rows with ``_block``, rising along the order: ranges of about equal size.

    Spark draws the ranges over all group and order columns of any type, so rows
    that agree in the first column, or in how their text begins, are cut too, and
    no bound travels in the plan. Written down, since the cut must stay the same.
    """
    ranges = [F.col(g).asc_nulls_first() for g in groups] + _ordering(order, ahead)
    placed = df.repartitionByRange(max(2, blocks), *ranges).withColumn("_block", F.spark_partition_id())
    return staged(df.sparkSession, "blocks")(placed)


def adjacent_values(
    df: DataFrame, groups: list[str], order: list[str], carry: str, ahead: bool = True, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, bool]:
    """Value of ``carry`` in the next (or previous) row of the group.

    Returns the group and order columns with ``_adjacent`` and ``_edge`` (true
    where no such row exists), and whether rows come collapsed: then ``_copies``
    says how many equal rows each one stands for.
    """
    rows = df.select(*groups, *order)
    counted = rows.groupBy(*groups).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    # At most total / hot_rows groups can pass the filter; the sum needs only one row.
    hot_total = counted.agg(F.sum("_n").alias("n"), F.count("*").alias("groups")).first()
    if not hot_total.groups:
        window = Window.partitionBy(*groups).orderBy(*_ordering(order, ahead))
        return _finish(rows, F.lead(F.struct(carry)).over(window)), False

    hot_groups = counted.select(*[F.col(g).alias(f"_hot_{g}") for g in groups])
    if groups:
        hot_groups = staged(df.sparkSession, "hot-groups")(hot_groups)
        match = F.lit(True)
        for g in groups:
            match = match & F.col(g).eqNullSafe(F.col(f"_hot_{g}"))
        if hot_total.groups <= BROADCAST_KEYS:
            hot_groups = F.broadcast(hot_groups)
        hot = rows.join(hot_groups, match, "left_semi")
        cold = rows.join(hot_groups, match, "left_anti")
    else:
        hot, cold = rows, rows.limit(0)

    # Copies of one row collapse before the shuffle, so a group of equal rows is one row.
    distinct = hot.groupBy(*groups, *order).agg(F.count("*").alias("_copies"))
    distinct = in_blocks(distinct, groups, order, 2 * math.ceil(hot_total.n / hot_rows), ahead)

    inside = Window.partitionBy(*groups, "_block").orderBy(*_ordering(order, ahead))
    within = distinct.withColumn("_next", F.lead(F.struct(carry)).over(inside)).withColumn(
        "_first", F.first(F.struct(carry)).over(inside)
    )
    middle = within.filter(F.col("_next").isNotNull()).drop("_first", "_block")
    # One row per block and group is left.
    across = Window.partitionBy(*groups).orderBy("_block")
    last = within.filter(F.col("_next").isNull()).withColumn("_next", F.lead("_first").over(across))
    stitched = middle.unionByName(last.select(*middle.columns))

    # Of several equal rows only the last one looks past its copies.
    own = F.struct(F.col(carry).alias(carry))
    split = stitched.withColumn(
        "_part",
        F.explode(
            F.array(
                F.struct(F.col("_next").alias("next"), F.lit(1).cast("long").alias("n")),
                F.struct(own.alias("next"), (F.col("_copies") - 1).alias("n")),
            )
        ),
    ).filter(F.col("_part.n") > 0)
    hot_out = _finish(
        split.select(*groups, *order, F.col("_part.n").alias("_copies"), F.col("_part.next").alias("_next")),
        F.col("_next"),
    ).drop("_next")
    window = Window.partitionBy(*groups).orderBy(*_ordering(order, ahead))
    cold_out = _finish(cold.withColumn("_copies", F.lit(1).cast("long")), F.lead(F.struct(carry)).over(window))
    return hot_out.unionByName(cold_out), True


def _finish(df: DataFrame, following: Column) -> DataFrame:
    found = df.withColumn("_following", following)
    return (
        found.withColumn("_adjacent", F.col("_following").getField(_only_field(found, "_following")))
        .withColumn("_edge", F.col("_following").isNull())
        .drop("_following")
    )


def _only_field(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.names[0]
