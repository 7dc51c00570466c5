"""Watching what comes in: rows set aside, recent activity, volume and drift."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged


def with_failed_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows with ``failed_rules``: the names, in order, of the rules that don't hold.

    A rule whose condition is null doesn't hold. All rules share one pass.
    """
    failed = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*failed)))


def quarantine_split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all rules, and the others with ``failed_rules``."""
    judged = with_failed_rules(df, rules)
    bad = F.size("failed_rules") > 0
    return judged.filter(~bad).drop("failed_rules"), judged.filter(bad)


def recent_activity(df: DataFrame, key: str, moment: str, cents: str, seconds: int = 3_600) -> DataFrame:
    """Rows with ``n_recent`` and ``cents_recent``: count and sum over the key's rows of
    the last ``seconds``, the row itself and rows of the same second included.

    Rows are added up per key and second before any shuffle. A sum is copied into
    the time slice after its own, so a slice knows all that its seconds look back on:
    a window holds at most ``2 * seconds`` sums, however many rows a key has in an
    hour. The rows then look their second up in a join, which adaptive execution
    splits for hot keys. Rows without a key or a moment see nothing but nulls.
    """
    rows = df.alias("row")
    at = F.unix_seconds(F.col(f"row.{moment}").cast("timestamp"))
    known = rows.select(F.col(f"row.{key}").alias("key"), at.alias("at"), F.col(f"row.{cents}").alias("cents"))
    sums = known.where("key is not null and at is not null").groupBy("key", "at")
    sums = sums.agg(F.count("*").alias("n"), F.sum("cents").alias("cents")).withColumn("slice", F.floor(F.col("at") / seconds))
    copies = F.explode(F.array(F.struct("slice", F.lit(True).alias("own")), F.struct((F.col("slice") + 1).alias("slice"), F.lit(False).alias("own")))).alias("part")
    window = Window.partitionBy("key", "slice").orderBy("at").rangeBetween(-seconds, 0)
    seen = sums.select("key", "at", "n", "cents", copies).select("key", "at", "n", "cents", "part.*")
    seen = seen.select("key", "at", "own", F.sum("n").over(window).alias("n_recent"), F.sum("cents").over(window).alias("cents_recent"))
    seen = seen.where("own").alias("seen")
    looked = rows.join(seen, (F.col(f"row.{key}") == F.col("seen.key")) & (at == F.col("seen.at")), "left")
    return looked.select("row.*", "seen.n_recent", "seen.cents_recent")


# Names of periods that aren't units of an interval.
STEPS = {"quarter": "3 months", "mon": "1 month", "mm": "1 month", "yyyy": "1 year", "yy": "1 year", "dd": "1 day"}


def _periods(counts: DataFrame, period: str) -> DataFrame:
    """Every period from the first to the last of a table with one row a period."""
    step = F.expr(f"interval {STEPS.get(period.lower(), f'1 {period}')}")
    ends = counts.agg(F.min("period").alias("first"), F.max("period").alias("last"))
    return ends.select(F.explode(F.sequence("first", "last", step)).alias("period"))


def volume_check(df: DataFrame, moment: str, period: str = "month", least_share: float = 0.5) -> DataFrame:
    """Rows per period, those of the period before, and whether they dropped below a
    share of them. A period without rows between the first and the last one has 0."""
    counts = df.filter(F.col(moment).isNotNull()).groupBy(F.date_trunc(period, moment).alias("period"))
    return volume_drops(counts.agg(F.count("*").alias("n_rows")), period, least_share)


def volume_drops(counts: DataFrame, period: str, least_share: float) -> DataFrame:
    """``volume_check`` from the rows of every period that has some."""
    counts = _periods(counts, period).join(counts, "period", "left")
    counts = counts.withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))
    before = F.lag("n_rows").over(Window.orderBy("period"))  # one row per period
    dropped = F.coalesce(F.col("n_rows") < F.lit(least_share) * F.col("n_before"), F.lit(False))
    return counts.withColumn("n_before", before).withColumn("dropped", dropped)


def value_bucket(value: Column) -> Column:
    """Bucket of a whole number: its own below 64, then 32 to every doubling.

    Buckets rise with the value, are at most 3 % wide and mergeable: at most some
    3 700 for any table.
    """
    size = F.abs(value)
    shift = F.greatest(F.length(F.bin(size)) - 6, F.lit(0))
    bucket = (shift * 32 + F.call_function("shiftright", size, shift)).cast("int")
    return F.when(value < 0, -bucket).otherwise(bucket)


def drift_profile(df: DataFrame, moment: str, cents: str, flag: str, period: str = "month", bins: int = 10) -> DataFrame:
    """Level and distribution of a value per period, against the first period with values.

    ``mean_cents`` and ``flag_share`` with their change from the period before; ``psi``,
    the population stability index over ``bins`` bins that hold about equal shares of
    the first period (half a row is added to every bin); and ``largest_gap`` between
    the two distribution functions. A period without rows between the first and the
    last has 0 rows and nulls. Null values count as rows only.

    The rows are read once, into one histogram per period; all else is computed from
    its few thousand buckets a period.
    """
    groups = df.filter(F.col(moment).isNotNull()).select(
        F.date_trunc(period, moment).alias("period"), value_bucket(F.col(cents)).alias("bucket"), F.col(cents).alias("cents"), F.col(flag).alias("flag")
    )
    found = groups.groupBy("period", "bucket").agg(
        F.count("*").alias("n"), F.sum("cents").alias("total"), F.count(F.when(F.col("flag"), 1)).alias("flagged")
    )
    histogram = staged(df.sparkSession, "value-histogram")(found)
    valued = histogram.filter(F.col("bucket").isNotNull())
    per_period = histogram.groupBy("period").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.col("n"))), F.lit(0).cast("long")).alias("n_values"),
        F.sum("total").alias("total"),
        F.sum("flagged").alias("flagged"),
    )
    levels = _periods(per_period, period).join(per_period, "period", "left").select(
        "period",
        F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"),
        (F.col("total") / F.nullif(F.col("n_values"), F.lit(0))).alias("mean_cents"),
        (F.col("flagged") / F.col("n_rows")).alias("flag_share"),
    )
    shifts = _shifts(valued, per_period.select("period", "n_values"), bins)
    window = Window.orderBy("period")  # one row per period
    changes = {f"{c}_change": F.col(c) - F.lag(c).over(window) for c in ("mean_cents", "flag_share")}
    return levels.join(shifts, "period", "left").withColumns(changes)


def _shifts(valued: DataFrame, sizes: DataFrame, bins: int) -> DataFrame:
    """``psi`` and ``largest_gap`` per period from rows ``period``, ``bucket``, ``n``."""
    first = valued.agg(F.min("period").alias("first")).first().first
    along = Window.orderBy("bucket")  # a few thousand buckets
    base = F.sum(F.when(F.col("period") == F.lit(first), F.col("n")).otherwise(0)).alias("base")
    buckets = valued.groupBy("bucket").agg(base).withColumns(
        {"base_below": F.sum("base").over(along) - F.col("base"), "base_total": F.sum("base").over(Window.partitionBy())}
    )
    own = F.when(F.col("base") > 0, F.expr(f"({bins} * base_below) div base_total"))
    buckets = buckets.withColumn("bin", F.coalesce(F.max(own).over(along), F.lit(0).cast("long")))
    # Every period meets every bucket: both are few.
    grid = sizes.filter("n_values > 0").crossJoin(F.broadcast(buckets)).join(valued.select("period", "bucket", "n"), ["period", "bucket"], "left")
    grid = grid.withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    below = F.sum("n").over(Window.partitionBy("period").orderBy("bucket"))
    gap = F.abs(below / F.col("n_values") - (F.col("base_below") + F.col("base")) / F.col("base_total"))
    by_bin = grid.withColumn("gap", gap).groupBy("period", "bin").agg(
        F.sum("n").alias("n"), F.sum("base").alias("base"), F.max("gap").alias("gap"),
        F.first("n_values").alias("n_values"), F.first("base_total").alias("base_total"),
    )
    used = F.count("*").over(Window.partitionBy("period"))
    shares = by_bin.withColumns(
        {
            "p": (F.col("n") + 0.5) / (F.col("n_values") + 0.5 * used),
            "q": (F.col("base") + 0.5) / (F.col("base_total") + 0.5 * used),
        }
    )
    psi = F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))).alias("psi")
    return shares.groupBy("period").agg(psi, F.max("gap").alias("largest_gap"))
