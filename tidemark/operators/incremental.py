"""Incremental writes as functions ``(target, batch) -> new target``."""

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

SCHEMA_CHANGE_MODES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


def _keys(unique_key) -> list[str]:
    if not unique_key:
        return []
    return [unique_key] if isinstance(unique_key, str) else list(unique_key)


def all_hold(predicates):
    return F.expr(" and ".join(f"({p})" for p in predicates))


def _split(target: DataFrame, predicates):
    """Target rows the predicates hold for, and all others (null counts as not held)."""
    if not predicates:
        return target, None
    holds = all_hold(predicates)
    return target.filter(holds), target.filter(~F.coalesce(holds, F.lit(False)))


def _with(rest: DataFrame | None, df: DataFrame) -> DataFrame:
    return df if rest is None else rest.unionByName(df)


def _insert(target: DataFrame, batch: DataFrame, columns) -> DataFrame:
    """Batch rows added; target columns not inserted are null in them."""
    return target.unionByName(batch.select(*columns), allowMissingColumns=True)


def append(target: DataFrame, batch: DataFrame, columns=None) -> DataFrame:
    return _insert(target, batch, columns or target.columns)


def delete_insert(target: DataFrame, batch: DataFrame, unique_key, predicates=(), columns=None) -> DataFrame:
    """Target rows whose key is in the batch go, then the whole batch comes in.

    Copies of a key inside the batch all stay; null keys delete nothing.
    """
    keys = _keys(unique_key)
    columns = columns or target.columns
    if not keys:
        return append(target, batch, columns)
    reached, rest = _split(target, predicates)
    return _insert(_with(rest, reached.join(batch.select(*keys), keys, "left_anti")), batch, columns)


def update_columns(columns, merge_update_columns=None, merge_exclude_columns=None) -> list[str]:
    """Columns an upsert overwrites."""
    if merge_update_columns and merge_exclude_columns:
        raise ValueError("give merge_update_columns or merge_exclude_columns, not both")
    if merge_update_columns:
        return list(merge_update_columns)
    skip = {c.lower() for c in merge_exclude_columns or ()}
    return [c for c in columns if c.lower() not in skip]


def merge(
    target: DataFrame,
    batch: DataFrame,
    unique_key,
    predicates=(),
    columns=None,
    merge_update_columns=None,
    merge_exclude_columns=None,
) -> DataFrame:
    """Upsert: matched target rows take the chosen columns, unmatched batch rows come in.

    One full join: target and batch are shuffled once each. Without a key everything
    is inserted. Two batch rows for one matched target
    row raise an error when the result is computed. Target rows outside the
    predicates are never matched.
    """
    keys = _keys(unique_key)
    columns = columns or target.columns
    changing = update_columns(columns, merge_update_columns, merge_exclude_columns)
    if not keys:
        return append(target, batch, columns)
    reached, rest = _split(target, predicates)

    # Rows without a key never match, so they stay out of the exchange: many of them
    # would meet in one task of a full join, which can't be split.
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    old = reached.filter(known).select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct(*target.columns).alias("_old"))
    copies = F.count("*").over(Window.partitionBy(*keys)).alias("_n")
    new = batch.filter(known).select(*[F.col(k).alias(f"_new_{k}") for k in keys], F.struct(*columns).alias("_new"), copies)
    same = reduce(lambda a, b: a & b, [F.col(f"_old_{k}") == F.col(f"_new_{k}") for k in keys])
    joined = old.join(new, same, "full_outer")

    hit = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    once = F.when(hit & (F.col("_n") > 1), F.raise_error(F.lit("more than one batch row matches a target row"))).otherwise(hit)
    lowered, inserted = {c.lower() for c in changing}, {c.lower() for c in columns}

    def merged(c):
        before, after = F.col(f"_old.{c}"), F.col(f"_new.{c}") if c.lower() in inserted else F.lit(None)
        found = F.when(F.col("_hit"), after if c.lower() in lowered else before).when(F.col("_old").isNotNull(), before)
        return found.otherwise(after).cast(target.schema[c].dataType).alias(c)

    result = joined.withColumn("_hit", once).select(*[merged(c) for c in target.columns])
    keyless = reached.filter(~known)
    return _insert(_with(rest, keyless).unionByName(result), batch.filter(~known), columns)


def insert_overwrite(target: DataFrame, batch: DataFrame, predicates=(), columns=None) -> DataFrame:
    """Batch in place of the target rows the predicates hold for (of all rows without any)."""
    _, rest = _split(target, predicates)
    return _insert(rest if rest is not None else target.limit(0), batch, columns or target.columns)


def microbatch(target: DataFrame, batch: DataFrame, unique_key, event_time: str, bounds, store=None) -> DataFrame:
    """Upsert one time slice after the other; ``bounds`` are the rising slice edges.

    Rows before the first edge, or without a time, form a slice of their own that
    comes first, rows from the last edge on one that comes last: every batch row
    arrives. Of a key in several slices the latest slice counts, so all slices are
    merged in one step. ``store`` may instead write the state after each slice and
    hand back the written table.
    """
    keys = _keys(unique_key)
    if not keys:
        raise ValueError("the microbatch strategy needs a unique key")
    edges = sorted({str(bound) for bound in bounds})
    moment = F.col(event_time)
    kind = batch.schema[event_time].dataType
    number = reduce(lambda n, edge: n + F.when(moment >= F.lit(edge).cast(kind), 1).otherwise(0), edges, F.lit(0))
    sliced = batch.withColumn("_slice", number)
    if store:
        for k in range(len(edges) + 1):
            target = store(merge(target, sliced.filter(F.col("_slice") == k).drop("_slice"), keys))
        return target
    latest = sliced.groupBy(*keys).agg(F.max("_slice").alias("_latest"))
    same = reduce(lambda a, b: a & b, [sliced[k].eqNullSafe(latest[k]) for k in keys])
    kept = sliced.join(latest, same & (sliced["_slice"] == latest["_latest"]), "left_semi").drop("_slice")
    return merge(target, kept, keys)


def apply_strategy(
    target: DataFrame, batch: DataFrame, strategy: str | None, unique_key=None, columns=None, **options
) -> DataFrame:
    """Run a strategy by name; the default is delete+insert with a key and append without."""
    strategy = strategy or "default"
    if strategy == "default":
        strategy = "delete+insert" if _keys(unique_key) else "append"
    if strategy == "append":
        return append(target, batch, columns)
    if strategy == "delete+insert":
        return delete_insert(target, batch, unique_key, columns=columns, **options)
    if strategy == "merge":
        return merge(target, batch, unique_key, columns=columns, **options)
    if strategy == "insert_overwrite":
        return insert_overwrite(target, batch, columns=columns, **options)
    if strategy == "microbatch":
        return microbatch(target, batch, unique_key, **options)
    raise ValueError(f"unknown strategy {strategy!r}")


# --- schema change ---------------------------------------------------------------


@dataclass(frozen=True)
class SchemaDifference:
    added: tuple[T.StructField, ...]
    removed: tuple[T.StructField, ...]
    retyped: tuple[T.StructField, ...]

    def __bool__(self):
        return bool(self.added or self.removed or self.retyped)


def diff_schemas(source: T.StructType, target: T.StructType) -> SchemaDifference:
    """Columns only in the source, only in the target, and with another type in the source."""
    have, want = {f.name: f for f in target}, {f.name: f for f in source}
    return SchemaDifference(
        tuple(f for f in source if f.name not in have),
        tuple(f for f in target if f.name not in want),
        tuple(f for f in source if f.name in have and f.dataType != have[f.name].dataType),
    )


def reconcile_schema(target: DataFrame, source: DataFrame, mode: str = "ignore") -> tuple[DataFrame, list[str]]:
    """Target in its new shape and the columns to insert.

    ``ignore`` inserts the target's columns, all other modes the source's. An
    unknown mode counts as ``ignore``.
    """
    if mode not in SCHEMA_CHANGE_MODES:
        log.warning("unknown schema change mode %r, using 'ignore'", mode)
        mode = "ignore"
    if mode == "ignore":
        return target, target.columns
    difference = diff_schemas(source.schema, target.schema)
    if difference and mode == "fail":
        raise ValueError(
            "source and target schemas differ: "
            f"added {[f.name for f in difference.added]}, removed {[f.name for f in difference.removed]}, "
            f"retyped {[f.name for f in difference.retyped]}"
        )
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in difference.added]
    if mode == "append_new_columns":
        return target.select("*", *added), source.columns
    if mode == "sync_all_columns":
        gone = {f.name for f in difference.removed}
        retyped = {f.name: f.dataType for f in difference.retyped}
        kept = [F.col(c).cast(retyped[c]).alias(c) if c in retyped else F.col(c) for c in target.columns if c not in gone]
        return target.select(*kept, *added), source.columns
    return target, source.columns
