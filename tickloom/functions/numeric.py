"""Rounding and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the guard added to feature denominators.
EPSILON = 1e-10


# Fixed value: doubles at least this large have no fraction left to round.
WHOLE = 9.0e15


def fixed(x: Column | str, digits: int) -> Column:
    """Round half up on the scaled binary value; the same expression is exact in any SQL engine."""
    x = F.col(x) if isinstance(x, str) else x
    scale = F.lit(float(10**digits))
    scaled = x * scale
    return F.when(F.abs(scaled) < WHOLE, F.floor(scaled + F.lit(0.5)) / scale).otherwise(x)


def mean_of(x: str) -> Column:
    """Mean of quoted values (prices, spreads, volumes).

    Whole parts and hundred-millionths are summed as integers, so the sum is exact to eight decimals and
    does not depend on the order in which tasks deliver their parts. Values too large for that (or not
    finite) make it a plain mean.
    """
    c = F.col(x)
    whole = F.floor(c)
    rest = F.round((c - whole) * F.lit(1e8)).cast("bigint")
    plain = F.coalesce(F.max(F.isnan(c) | (F.abs(c) >= F.lit(WHOLE))), F.lit(False))
    usable = F.when(~F.isnan(c) & (F.abs(c) < F.lit(WHOLE)), F.lit(True))
    total = F.sum(F.when(usable, whole)).cast("double") + F.sum(F.when(usable, rest)).cast("double") / F.lit(1e8)
    return F.when(plain, F.avg(c)).otherwise(F.try_divide(fixed(total, 8), F.count(c)))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, null where the denominator is zero."""
    return F.try_divide(top, bottom)


def percent(top: Column, bottom: Column) -> Column:
    return ratio(top, bottom) * F.lit(100.0)


def percent_change(now: Column, before: Column) -> Column:
    return percent(now - before, before)


def share_of(part: Column, price: Column) -> Column:
    """part as % of price with the feature guard in the denominator."""
    return part / (price + F.lit(EPSILON)) * F.lit(100.0)
