"""Date arithmetic by boundaries crossed, not by whole units elapsed."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_column

# Supported date parts.
DIFF_PARTS = (
    "year", "quarter", "month", "week", "day", "hour", "minute", "second", "millisecond", "microsecond",
)


def date_trunc(part: str, moment) -> Column:
    return F.date_trunc(part, as_column(moment))


def dateadd(part: str, count, moment) -> Column:
    """Moment moved by ``count`` parts; month ends are clamped."""
    return F.timestamp_add(part.upper(), as_column(count).cast("int"), as_column(moment))


def _seconds(moment: Column, scale: int) -> Column:
    """Seconds within the minute times ``scale``, whole."""
    return F.floor(F.extract(F.lit("SECOND"), moment.cast("timestamp")) * scale)


def datediff(first, second, part: str) -> Column:
    """Number of ``part`` boundaries between two moments: 31 January to 1 February is one month."""
    first, second = as_column(first), as_column(second)
    if part == "year":
        out = F.year(second) - F.year(first)
    elif part == "quarter":
        out = datediff(first, second, "year") * 4 + F.quarter(second) - F.quarter(first)
    elif part == "month":
        out = datediff(first, second, "year") * 12 + F.month(second) - F.month(first)
    elif part == "day":
        out = F.date_diff(second.cast("date"), first.cast("date"))
    elif part == "week":
        # Whole sevens of days, then one more when the weekday wrapped around.
        sevens = (datediff(first, second, "day") / 7).cast("long")
        wrapped = F.dayofweek(first) > F.dayofweek(second)
        forward = first <= second
        out = sevens + F.when(wrapped & forward, 1).when(~wrapped & ~forward, -1).otherwise(0)
    elif part == "hour":
        out = datediff(first, second, "day") * 24 + F.hour(second.cast("timestamp")) - F.hour(first.cast("timestamp"))
    elif part == "minute":
        minute = F.minute(second.cast("timestamp")) - F.minute(first.cast("timestamp"))
        out = datediff(first, second, "hour") * 60 + minute
    elif part in ("second", "millisecond", "microsecond"):
        scale = {"second": 1, "millisecond": 1_000, "microsecond": 1_000_000}[part]
        out = datediff(first, second, "minute") * (60 * scale) + _seconds(second, scale) - _seconds(first, scale)
    else:
        raise ValueError(f"unsupported date part {part!r}, expected one of {DIFF_PARTS}")
    return out.cast("long")


def last_day(moment, part: str = "month") -> Column:
    """Last day of the period the moment lies in."""
    moment = as_column(moment)
    if part == "month":
        return F.last_day(moment.cast("date"))
    return F.date_sub(dateadd(part, 1, date_trunc(part, moment)).cast("date"), 1)


def make_date(year: int, month: int, day: int) -> Column:
    return F.make_date(F.lit(year), F.lit(month), F.lit(day))
