"""Latest rows, samples, down-sampling and search."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import TickSeries
from tickloom.schema import symbol_dim


def first_rows(series: TickSeries, symbol: str, k: int) -> DataFrame:
    """The first k ticks of one symbol."""
    return series.rows.where((F.col("symbol") == symbol) & (F.col("pos") < k))


def downsample(series: TickSeries, points: int = 800) -> DataFrame:
    """At most ``points`` ticks per symbol: the last tick of each of ``points`` equal tiles.

    Tiles follow from place and length (the first n mod points tiles are one longer), so a tick
    knows whether it closes its tile and nothing has to be ordered.
    """
    n, pos = F.col("n"), F.col("pos")
    small = F.floor(n / F.lit(points))
    longer = n % F.lit(points)
    in_longer = pos < longer * (small + 1)
    tile = F.when(in_longer, F.floor(F.try_divide(pos, small + 1))).otherwise(
        longer + F.floor(F.try_divide(pos - longer * (small + 1), small))
    )
    closes = F.when(in_longer, (pos + 1) % (small + 1) == 0).otherwise(
        F.try_mod(pos - longer * (small + 1) + 1, small) == 0
    )
    return (
        series.rows.join(series.lengths, "symbol")
        .withColumn("tile", (tile + 1).cast("int"))
        .where(closes)
        .drop("n")
    )


_BOUND = r"\s*(\+?(?:\d+\.?\d*|\.\d+)(?:[eE][+]?\d+)?)\s*"
# an optional number, a dash, and an optional number that ends there or at a further dash
_RANGE = re.compile(rf"(?:{_BOUND}|\s*)-(?:{_BOUND}(?:-|$))?")


def search_predicate(keyword: str) -> Column:
    """'lo-hi', 'lo-', '-hi' are inclusive price ranges; other text matches symbol or direction.

    A second bound that is not a number is left out; a first one makes the keyword plain text.
    """
    found = _RANGE.match(keyword)
    bounds = found.groups() if found else (None, None)
    tests = [
        test(F.col("price"), float(bound)) for test, bound in zip((Column.__ge__, Column.__le__), bounds) if bound
    ]
    if tests:
        return reduce(Column.__and__, tests)
    return F.col("symbol").contains(keyword.upper()) | F.lower("direction").contains(keyword.lower())


def search(series: TickSeries, keyword: str, limit: int = 10) -> DataFrame:
    """The first matches in listing order of the symbols, then tick order."""
    spark = series.table.sparkSession
    return (
        series.rows.where(search_predicate(keyword))
        .join(symbol_dim(spark).select("symbol", "symbol_rank"), "symbol")
        .orderBy("symbol_rank", "pos")
        .limit(limit)
        .select("symbol", "event_ts", "price", "volume", "direction")
    )
