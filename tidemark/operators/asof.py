"""Point-in-time join: the history rows that were valid at the moment of a fact."""

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.names import END_OF_TIME
from tidemark.operators.skew import (
    BROADCAST_KEYS,
    HOT_ROWS,
    MAX_BLOCKS,
    adjacent_values,
    as_number,
    block_of,
    in_blocks,
    quantile_bounds,
)
from tidemark.session import staged

# A key with more versions than this is joined slice by slice.
LONG_HISTORY = 64


@dataclass(frozen=True)
class VersionIndex:
    """History ready for point-in-time joins (several joins may share one).

    ``versions`` has columns _key, _from, _to, _slice and the carried columns.
    For keys with a long history a version stands once in every time slice it
    touches, ``long_keys`` tells in how many slices such a key is cut. ``swept``
    holds the versions of keys that have too many for slices, ``swept_keys`` names them.
    """

    versions: DataFrame
    long_keys: DataFrame | None = None
    long_key_count: int = 0
    bounds: tuple[float, ...] = ()
    swept: DataFrame | None = None
    swept_keys: DataFrame | None = None
    swept_blocks: int = 0


def index_versions(
    history: DataFrame,
    key: str,
    valid_from: str,
    valid_to: str,
    carry: list[str],
    versions_bound: int | None = None,
    long_history: int = LONG_HISTORY,
    most_slices: int = MAX_BLOCKS,
) -> VersionIndex:
    """Prepare a history table.

    An equi-join on the key alone pairs each fact with all versions of its key.
    That is fine for short histories. Keys with more than ``long_history``
    versions are cut into slices of about that many versions along quantiles of
    their start, so pairs stay linear in the facts. Keys with more versions than
    ``most_slices`` slices hold are not joined but swept (``_sweep``), if their
    versions don't overlap; overlapping ones stay in slices. ``versions_bound`` is
    a known bound on versions per key (say, the number of snapshot runs); without
    it the versions are counted.
    """
    end = F.coalesce(F.col(valid_to), F.lit(END_OF_TIME).cast(history.schema[valid_to].dataType))
    versions = history.select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_from"), end.alias("_to"), *carry
    )
    whole = VersionIndex(versions.withColumn("_slice", F.lit(0)))
    if versions_bound is not None and versions_bound <= long_history:
        return whole
    counted = versions.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.count("*").alias("_n"))
    counted = counted.filter(F.col("_n") > long_history)
    found = counted.agg(F.count("*").alias("keys"), F.max("_n").alias("longest"), F.sum("_n").alias("rows")).first()
    if not found.keys:
        return whole
    if found.longest > long_history * most_slices:
        keys = _swept_keys(versions, counted.filter(F.col("_n") > long_history * most_slices))
        names = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
        swept = versions.filter("_from < _to").join(names, "_key", "left_semi")
        rest = index_versions(
            versions.join(names, "_key", "left_anti"), "_key", "_from", "_to", carry, None, long_history, math.inf
        )
        blocks = max(int(history.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(found.rows / HOT_ROWS))
        return replace(rest, swept=swept, swept_keys=names.withColumnRenamed("_key", "_swept_key"), swept_blocks=blocks)

    # Slices are powers of two, so a key with fewer versions uses every 2nd, 4th, ... bound.
    levels = min(math.ceil(math.log2(found.longest / long_history)), int(math.log2(MAX_BLOCKS)))
    wanted = F.least(F.lit(levels), F.ceil(F.log2(F.col("_n") / long_history)))
    long_keys = counted.select("_key", (F.lit(levels) - wanted).cast("int").alias("_shift"))
    store = staged(history.sparkSession, "versions")
    long_keys = store(long_keys)
    hinted = F.broadcast(long_keys) if found.keys <= BROADCAST_KEYS else long_keys
    number = as_number(F.col("_from"), versions.schema["_from"].dataType)
    long_versions = versions.join(hinted, "_key", "left_semi")
    bounds = quantile_bounds(long_versions, number, 2**levels)

    marked = versions.join(hinted, "_key", "left")
    low = block_of(as_number(F.col("_from"), versions.schema["_from"].dataType), bounds)
    high = block_of(as_number(F.col("_to"), versions.schema["_to"].dataType), bounds)
    # An empty or reversed range never matches; its start slice is enough.
    slices = F.when(F.col("_shift").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(_shifted(low), F.greatest(_shifted(low), _shifted(high)))
    )
    sliced = marked.withColumn("_slice", F.explode(slices)).drop("_shift")
    return VersionIndex(store(sliced), long_keys, found.keys, tuple(bounds))


def _swept_keys(versions: DataFrame, counted: DataFrame) -> DataFrame:
    """Those of the counted keys whose versions don't overlap, stored.

    The next version's start is found in blocks (``adjacent_values``), so no key's
    history has to fit one task. Empty and reversed ranges never match and don't count.
    """
    spans = versions.filter("_from < _to").join(counted, "_key", "left_semi").select("_key", "_from", "_to")
    following, _ = adjacent_values(spans, ["_key"], ["_from", "_to"], "_from")
    overlapping = following.filter(~F.col("_edge") & (F.col("_adjacent") < F.col("_to"))).select("_key").distinct()
    return staged(versions.sparkSession, "swept-keys")(counted.select("_key").join(overlapping, "_key", "left_anti"))


def _sweep(facts: DataFrame, index: VersionIndex, key: str, moment: str, renamed: dict[str, str]) -> DataFrame:
    """``asof_join`` for keys whose versions don't overlap: one pass in order of key and time.

    Versions and facts are put in one order and cut into blocks by range, ties of
    facts by chance. Inside a block the last version goes along; what is open at a
    block's start is the last version of the blocks before, one row per key and
    block. Each version and each fact is moved once, however many there are.
    """
    version = F.struct(F.col("_to"), *[F.col(c).alias(n) for c, n in renamed.items()]).alias("_version")
    starts = index.swept.select("_key", F.col("_from").alias("_at"), F.lit(0).alias("_rank"), F.lit(0.0).alias("_tie"), version)
    moments = facts.select(
        F.col(key).alias("_key"),
        F.col(moment).alias("_at"),
        F.lit(1).alias("_rank"),
        F.rand(11).alias("_tie"),
        F.struct(*facts.columns).alias("_fact"),
    )
    order = ["_at", "_rank", "_tie"]
    placed = in_blocks(starts.unionByName(moments, allowMissingColumns=True), ["_key"], order, index.swept_blocks)
    so_far = Window.partitionBy("_block", "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.withColumn("_open", F.last("_version", ignorenulls=True).over(so_far)).filter("_rank = 1")

    started = F.when(F.col("_rank") == 0, F.col("_at"))
    ends = placed.groupBy("_block", "_key").agg(F.max_by("_version", started).alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    edges = ends.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier)).filter("_before is not null")
    found = inside.join(edges.drop("_last"), ["_block", "_key"], "left").withColumn("_open", F.coalesce("_open", "_before"))
    valid = F.col("_at") < F.col("_open._to")
    return found.select("_fact.*", *[F.when(valid, F.col("_open")[n]).alias(n) for n in renamed.values()])


def _shifted(block):
    """Slice of a block: blocks divided by two to the power of the key's shift."""
    return F.floor(block / F.pow(F.lit(2), F.col("_shift"))).cast("int")


def asof_join(facts: DataFrame, index: VersionIndex, key: str, moment: str, renamed: dict[str, str]) -> DataFrame:
    """Left join of facts to the versions valid at ``moment``.

    ``renamed`` maps carried columns to result names. A fact matches every
    version of its key with ``_from <= moment < _to``; without one the columns
    are null.
    """
    if index.swept is not None:
        swept = F.col("_swept_key").isNotNull() & F.col(moment).isNotNull()
        marked = facts.join(index.swept_keys, F.col(key) == F.col("_swept_key"), "left")
        through = marked.filter(swept).select(*facts.columns)
        others = marked.filter(~swept).select(*facts.columns)
        rest = replace(index, swept=None, swept_keys=None)
        return asof_join(others, rest, key, moment, renamed).unionByName(_sweep(through, index, key, moment, renamed))
    right = index.versions.select(
        "_key", "_from", "_to", "_slice", *[F.col(c).alias(n) for c, n in renamed.items()]
    )
    at = F.col(moment)
    condition = (F.col(key) == F.col("_key")) & (at >= F.col("_from")) & (at < F.col("_to"))
    if index.long_keys is not None:
        lookup = index.long_keys.withColumnRenamed("_key", "_long_key")
        if index.long_key_count <= BROADCAST_KEYS:
            lookup = F.broadcast(lookup)
        block = block_of(as_number(at, facts.schema[moment].dataType), list(index.bounds))
        here = facts.join(lookup, F.col(key) == F.col("_long_key"), "left")
        here = here.withColumn("_at_slice", F.when(F.col("_shift").isNull(), 0).otherwise(_shifted(block)))
        condition = condition & (F.col("_at_slice") == F.col("_slice"))
    else:
        here = facts
    return here.join(right, condition, "left").select(*facts.columns, *renamed.values())
