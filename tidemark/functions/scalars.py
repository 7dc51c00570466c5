"""Null-aware arithmetic, keys, buckets and comparisons as Column expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import SURROGATE_NULL

NUMERIC = T.DecimalType(28, 6)

# Fixed values of the distance formula: earth radius in miles, kilometres per mile.
EARTH_RADIUS_MILES = 3961
DISTANCE_UNITS = {"mi": 1.0, "km": 1.60934}


def as_column(value) -> Column:
    """A column for a name, the column itself, or a literal."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def _need_list(fields, name):
    if isinstance(fields, (str, dict, Column)) or not fields:
        raise ValueError(f"{name} takes a list of fields")
    return [as_column(field) for field in fields]


def surrogate_key(fields, null_as: str = SURROGATE_NULL) -> Column:
    """MD5 of the fields as text joined by ``-``; a null field counts as ``null_as``.

    Pass ``null_as=""`` for the legacy form where null and empty text collide.
    """
    parts = [F.coalesce(c.cast("string"), F.lit(null_as)) for c in _need_list(fields, "surrogate_key")]
    return F.md5(F.concat_ws("-", *parts))


def text_hash(field) -> Column:
    return F.md5(as_column(field).cast("string"))


def safe_add(fields) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in _need_list(fields, "safe_add")])


def safe_subtract(fields) -> Column:
    return reduce(lambda a, b: a - b, [F.coalesce(c, F.lit(0)) for c in _need_list(fields, "safe_subtract")])


def safe_divide(numerator, denominator) -> Column:
    """Quotient, null when the denominator is zero or null.

    Division is always true division: ``7 / 2`` is ``3.5`` for integers too.
    """
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0))


def width_bucket(value, low, high, buckets) -> Column:
    """Number of the equal-width bucket that ``value`` falls in.

    A value that is a whole multiple of the bucket width belongs to the bucket
    above it. That rule looks at ``value`` and not at ``value - low``, values
    under ``low`` are not clamped, and the bound ``buckets + 1`` is taken before
    the rule is applied, so this is not the built-in function of the same name.
    """
    value, low, high, buckets = (as_column(v) for v in (value, low, high, buckets))
    width = (high - low) / buckets
    on_edge = F.when(value.cast(NUMERIC) % width.cast(NUMERIC) == 0, 1).otherwise(0)
    return on_edge + F.least(F.ceil((value - low) / width), (buckets + 1).cast("long"))


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in DISTANCE_UNITS:
        raise ValueError(f"unit must be one of {sorted(DISTANCE_UNITS)}, got {unit!r}")
    lat1, lon1, lat2, lon2 = (as_column(v) for v in (lat1, lon1, lat2, lon2))

    def half_chord(a, b):
        return F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2))

    h = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    return F.asin(F.sqrt(h)) * (2 * EARTH_RADIUS_MILES * DISTANCE_UNITS[unit])


def equals(left, right, nulls_match: bool = False) -> Column:
    """Equality; with ``nulls_match`` two nulls are equal and the result is never null."""
    left, right = as_column(left), as_column(right)
    return left.eqNullSafe(right) if nulls_match else left == right


def cast_to(field, data_type) -> Column:
    """Cast that raises on text that does not parse."""
    return as_column(field).cast(data_type)


def try_cast_to(field, data_type) -> Column:
    """Cast that gives null on text that does not parse."""
    return as_column(field).try_cast(data_type)


def nullcheck(field) -> Column:
    """Empty text becomes null."""
    return F.nullif(as_column(field), F.lit(""))


def any_value(field) -> Column:
    """One value of the group; the smallest, so that every run gives the same one."""
    return F.min(as_column(field))


def bool_or(condition) -> Column:
    return F.bool_or(as_column(condition))
