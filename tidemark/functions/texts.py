"""Text and array expressions where the plain built-in differs or needs care."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_column


def split_part(text, delimiter: str, part: int) -> Column:
    """n-th part of the text; negative numbers count from the end."""
    return F.split_part(as_column(text), F.lit(delimiter), F.lit(part))


def length(text) -> Column:
    return F.char_length(as_column(text))


def right(text, count) -> Column:
    """Last ``count`` characters; a negative count drops that many from the front."""
    text, count = as_column(text), as_column(count)
    drop = F.when(count < 0, -count).otherwise(F.greatest(F.char_length(text) - count, F.lit(0)))
    return F.substr(text, drop.cast("int") + 1)


def replace(text, old: str, new: str) -> Column:
    return F.replace(as_column(text), F.lit(old), F.lit(new))


def position(needle: str, text) -> Column:
    """1-based place of the first match, 0 without one."""
    return F.position(F.lit(needle), as_column(text))


def concat(fields) -> Column:
    """Joined text; null as soon as one field is null."""
    return F.concat(*[as_column(f).cast("string") for f in fields])


def string_literal(value: str) -> Column:
    return F.lit(value)


def escape_single_quotes(value: str) -> str:
    """Text ready to stand between single quotes in SQL."""
    return value.replace("'", "''")


def bool_to_text(condition) -> Column:
    return as_column(condition).cast("string")


def array_construct(inputs=(), data_type: str = "int") -> Column:
    """Array of the inputs; without inputs an empty array of ``data_type``."""
    if not inputs:
        return F.array().cast(f"array<{data_type}>")
    return F.array(*[as_column(v) for v in inputs])


def array_append(array, element) -> Column:
    return F.array_append(as_column(array), as_column(element))


def array_concat(first, second) -> Column:
    return F.concat(as_column(first), as_column(second))


def url_host(url) -> Column:
    """Host of a URL, found by plain text rules."""
    bare = as_column(url)
    # Schemes that are cut off.
    for scheme in ("android-app://", "http://", "https://"):
        bare = replace(bare, scheme, "")
    return split_part(split_part(bare, "/", 1), "?", 1)


def url_path(url) -> Column:
    """Text after the first slash up to ``?``; without any slash, the text from ``?`` on is empty
    and a text with neither character is returned whole."""
    bare = as_column(url)
    # Schemes that are cut off.
    for scheme in ("http://", "https://"):
        bare = replace(bare, scheme, "")
    start = F.coalesce(F.nullif(position("/", bare), F.lit(0)), position("?", bare) - 1)
    return split_part(F.substr(bare, F.greatest(start, F.lit(0)) + 1), "?", 1)


def url_parameter(url, name: str) -> Column:
    """Value after the first ``name=`` in the text up to ``&``; empty gives null.

    The search is on plain text, so a parameter whose name ends in ``name`` matches too.
    """
    return F.nullif(split_part(split_part(url, f"{name}=", 2), "&", 1), F.lit(""))
