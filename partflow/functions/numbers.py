"""Rounding and number texts that agree with IEEE arrays and Python floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(x: Column, digits: int) -> Column:
    """Round a double to ``digits`` decimals, ties to even on the scaled value."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def exact_sum(x: Column) -> Column:
    """Sum of doubles; the same total however rows are spread, for sizes that data has.

    Values from 1e-3 to 1e9 are summed at 8 decimals and smaller ones at 24, as
    decimals. Larger ones, infinities and NaN go to a sum of doubles, so no
    value ends the job or counts as 0.
    """
    size = F.abs(x)
    common = (size >= 1e-3) & (size < 1e9)
    middle = F.sum(F.when(common, round_even(x, 8).cast("decimal(28,10)"))).cast("double")
    small = F.sum(F.when(size < 1e-3, x.cast("decimal(38,24)"))).cast("double")
    rest = F.sum(F.when(~common & (size >= 1e-3), x))
    none = F.lit(0.0)
    return F.when(F.count(x) > 0, F.coalesce(middle, none) + F.coalesce(small, none) + F.coalesce(rest, none))


def exact_mean(x: Column) -> Column:
    """Mean of the non-null values by ``exact_sum``; null if there are none."""
    return exact_sum(x) / F.nullif(F.count(x), F.lit(0))


def sample_std(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation out of a count, a sum and a sum of squares of integers.

    The sums stay exact, so the value does not depend on the order of rows;
    where their products pass 38 digits, doubles take over.
    """
    wide = "decimal(38,0)"
    exact = F.try_subtract(F.try_multiply(n.cast(wide), squares.cast(wide)), F.try_multiply(total.cast(wide), total.cast(wide)))
    rough = n.cast("double") * squares.cast("double") - total.cast("double") * total.cast("double")
    spread = F.greatest(F.coalesce(exact.cast("double"), rough), F.lit(0.0))
    pairs = n.cast("double") * (n.cast("double") - 1)
    return F.when(n > 1, F.sqrt(spread / pairs))


def whole_sum(x: Column) -> Column:
    """Sum of integers without a limit that data could reach."""
    return F.sum(x.cast("decimal(20,0)"))


def square_sum(x: Column) -> Column:
    """Sum of the squares of integers, with the same room."""
    wide = x.cast("decimal(19,0)")
    return F.sum(wide * wide)


def fixed_text(x: Column, digits: int) -> Column:
    """``digits`` decimals, always; null stays null."""
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", x))


def signed_text(x: Column, digits: int) -> Column:
    return F.when(x.isNotNull(), F.format_string(f"%+.{digits}f", x))


def short_text(x: Column, digits: int) -> Column:
    """A rounded double with no trailing zeros, but at least one decimal."""
    return F.regexp_replace(fixed_text(x, digits), r"(\.\d+?)0+$", "$1")
