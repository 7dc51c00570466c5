"""Number and date series, generated in parallel by ``spark.range``."""

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import dateadd, datediff


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """Whole numbers 1 to ``upper_bound`` as ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError(f"upper bound must be positive, got {upper_bound}")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def date_spine(spark: SparkSession, part: str, start, end) -> DataFrame:
    """One row per ``part`` from start in column ``date_<part>``.

    The number of rows is the number of boundaries between start and end, so the
    end itself is left out when the distance is exact. Start and end are dates,
    timestamps or their text.
    """

    def moment(value) -> Column:
        return F.lit(str(value)).cast("timestamp_ntz")

    start, end = moment(start), moment(end)
    count = spark.range(1).select(datediff(start, end, part).alias("n")).first().n
    if count <= 0:
        raise ValueError(f"no {part} boundary between start and end")
    name = f"date_{part}"
    spine = spark.range(count).select(dateadd(part, F.col("id"), start).alias(name))
    return spine.filter(F.col(name) <= end)


def date_spine_over(df: DataFrame, column: str, part: str) -> DataFrame:
    """Spine from the first to the last moment of a column (one bounded row is read)."""
    span = df.agg(
        F.min(F.col(column).cast("timestamp_ntz")).alias("a"), F.max(F.col(column).cast("timestamp_ntz")).alias("b")
    ).first()
    return date_spine(df.sparkSession, part, span.a, span.b)


def day_span(raw: str, date_fmt: str = "%Y%m%d") -> tuple[date, date]:
    """First and last day of ``"first"`` or ``"first,last"``."""
    first, *more = (datetime.strptime(part.strip(), date_fmt).date() for part in str(raw).split(","))
    last = more[0] if more else first
    if len(more) > 1 or first > last:
        raise ValueError(f"not a span of days: {raw!r}")
    return first, last


def dates_in_range(start: str, end: str | None = None, in_fmt: str = "%Y%m%d", out_fmt: str = "%Y%m%d") -> list[str]:
    """Labels of the days from start to end, both included (a short list for partition filters)."""
    first, last = day_span(start if end is None else f"{start},{end}", in_fmt)
    return [date.fromordinal(n).strftime(out_fmt) for n in range(first.toordinal(), last.toordinal() + 1)]


def partition_range(raw: str, date_fmt: str = "%Y%m%d") -> list[str]:
    """Labels of the days of a span, in the span's own format."""
    return dates_in_range(raw, in_fmt=date_fmt, out_fmt=date_fmt)


def read_days(df: DataFrame, column: str, raw: str, date_fmt: str = "%Y%m%d") -> DataFrame:
    """Rows of the days in a span; a plain half-open filter, so the scan can skip files."""
    first, last = day_span(raw, date_fmt)
    low, high = (F.lit(f"{day.isoformat()} 00:00:00") for day in (first, last + timedelta(days=1)))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))
