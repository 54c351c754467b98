"""Scalar, string and array column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playtrail.schema import TOKEN_FILTERS

__all__ = ["abs_value", "safe_divide", "round_half_even", "parse_timestamp", "code_text",
           "sliced", "events_add", "normalize_text", "pad_front", "argmax", "round6", "to_int",
           "hash_fraction"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def abs_value(c) -> Column:
    """X1."""
    return F.abs(_c(c))


def safe_divide(a, b) -> Column:
    """A / b as double, null when b is 0 (plain ``/`` raises under ANSI mode)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def round_half_even(c, scale: int = 0) -> Column:
    """Python's ``round`` (banker's rounding)."""
    return F.bround(_c(c), scale)


def to_int(c) -> Column:
    """Cast a rounded value to int."""
    return _c(c).cast("int")


def parse_timestamp(c) -> Column:
    """ISO-8601 text (with Z) to TIMESTAMP."""
    return F.to_timestamp(_c(c))


def code_text(c) -> Column:
    """Integer code as text."""
    return _c(c).cast("string")


def sliced(c, n: int = 4) -> Column:
    """Split a string into chunks of ``n`` characters."""
    return F.regexp_extract_all(_c(c), F.lit(f"(?s).{{1,{n}}}"), 0)


def events_add(c) -> Column:
    """Join an array of codes with single spaces (no trailing space)."""
    return F.array_join(_c(c), " ")


def normalize_text(c) -> Column:
    """Lower-case and turn the tokenizer's filter characters into spaces."""
    return F.translate(F.lower(_c(c)), TOKEN_FILTERS, " " * len(TOKEN_FILTERS))


def pad_front(c, length: int, value=0) -> Column:
    """X11: keep the last ``length`` items, pad in front with ``value``."""
    arr = _c(c)
    kept = F.when(F.size(arr) > length, F.slice(arr, -length, length)).otherwise(arr)
    pad = F.array_repeat(F.lit(value), F.greatest(F.lit(length) - F.size(arr), F.lit(0)))
    return F.concat(pad, kept)


def argmax(c) -> Column:
    """0-based position of the largest item (first on ties)."""
    arr = _c(c)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def round6(c) -> Column:
    return F.round(_c(c).cast("double"), 6)


def hash_fraction(key, seed: int = 0) -> Column:
    """Repeatable uniform number in [0, 1) from a key: the first 8 hex digits of
    md5(seed:key) / 2^32. Unlike ``rand`` it does not depend on partitioning."""
    text = F.concat(F.lit(f"{seed}:"), _c(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
