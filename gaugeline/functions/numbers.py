"""Numeric column helpers that never raise, whatever the ANSI setting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_bigint(text: Column) -> Column:
    """Text to bigint; a decimal fraction is cut off, other text gives null.

    ``'1.5'`` → 1, ``'.5'`` → 0, ``'1e3'`` → null.
    """
    trimmed = F.trim(text)
    whole = F.substring_index(trimmed, ".", 1)
    whole = F.when(whole.isin("", "+", "-"), "0").otherwise(whole)
    fraction_cut = F.when(trimmed.rlike("^[+-]?[0-9]*[.][0-9]*$"), whole.try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), fraction_cut)


def stable_round(value: Column, digits: int) -> Column:
    """Half-up rounding that ignores the last bits of a floating-point sum.

    Averages of many rows differ in the last bits with the order in which
    partitions are merged. Rounding to nine digits first makes a value such as
    1.2349999999999999 the 1.235 it stands for, so results repeat.
    """
    return F.round(F.round(value, 9), digits)


def seconds_between(earlier: Column, later: Column) -> Column:
    """Seconds with microsecond precision."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def percentage(part: Column, whole: Column, empty: float | None) -> Column:
    """``part / whole * 100``; ``empty`` where there is nothing to divide."""
    ratio = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100.0
    return ratio if empty is None else F.when(whole > 0, ratio).otherwise(F.lit(empty))
