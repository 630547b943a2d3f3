"""Pearson correlation between symbols, by position or by bar time."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numeric import fixed
from tickloom.operators.series import TickSeries
from tickloom.schema import SYMBOLS, symbol_dim


def pearson(x: str, y: str) -> Column:
    """Correlation over rows where both are present; 0 when a variance is 0 or nothing pairs."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.coalesce(F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0)), F.lit(0.0))


def every_nth(series: TickSeries, step: int) -> DataFrame:
    """Ticks at places 0, step, 2*step, ... of each symbol with their sample index."""
    return series.rows.where(F.col("pos") % step == 0).withColumn(
        "sample_idx", F.floor(F.col("pos") / F.lit(step))
    )


def aligned_samples(series: TickSeries, step: int = 50, symbols=SYMBOLS) -> DataFrame:
    """One row per sample index with a price column per symbol, cut to the shortest series.

    The cut follows from the stored lengths, so it is a filter before the pivot's shuffle.
    """
    shortest = (
        series.lengths.where(F.col("symbol").isin(*symbols))
        .agg(F.min(F.ceil(F.col("n") / F.lit(step))))
        .scalar()
    )
    return (
        every_nth(series, step)
        .where(F.col("sample_idx") < shortest)
        .groupBy("sample_idx")
        .agg(*_price_per_symbol("price", symbols))
    )


def aligned_bars(bars: DataFrame, start: str = "minute", symbols=SYMBOLS) -> DataFrame:
    """One row per bar time with a close column per symbol."""
    return bars.groupBy(start).agg(*_price_per_symbol("close_price", symbols))


def _price_per_symbol(value: str, symbols) -> list[Column]:
    return [F.max(F.when(F.col("symbol") == s, F.col(value))).alias(s) for s in symbols]


def _pair_values(aligned: DataFrame, pairs) -> DataFrame:
    """One row holding an array of (a, b, r) for the given pairs, from a single aggregation."""
    values = aligned.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), fixed(F.col(f"`{a}|{b}`"), 4).alias("r"))
        for a, b in pairs
    ]
    return values.select(F.array(*entries).alias("pairs"))


def correlation_pairs(aligned: DataFrame, symbols=SYMBOLS) -> DataFrame:
    """symbol_a, symbol_b, correlation for each unordered pair."""
    return _pair_values(aligned, list(combinations(symbols, 2))).select(
        F.inline("pairs").alias("symbol_a", "symbol_b", "correlation")
    )


def correlation_matrix(aligned: DataFrame, symbols=SYMBOLS) -> DataFrame:
    """The full square: both orders of each pair, and each symbol with itself (0 if constant)."""
    pairs = list(combinations_with_replacement(symbols, 2))
    mirrored = F.transform(
        F.filter("pairs", lambda p: p["a"] != p["b"]),
        lambda p: F.struct(p["b"].alias("a"), p["a"].alias("b"), p["r"].alias("r")),
    )
    return _pair_values(aligned, pairs).select(
        F.inline(F.concat("pairs", mirrored)).alias("from_symbol", "to_symbol", "value")
    )


def strength(r: Column) -> Column:
    return (
        F.when(r > 0.5, "strong positive")
        .when(r > 0, "weak positive")
        .when(r < -0.5, "strong negative")
        .otherwise("weak negative")
    )


def top_pairs(aligned: DataFrame, symbols=SYMBOLS) -> DataFrame:
    """Three strongest pairs, two strongest positive and two strongest negative, with display data.

    The pairs of all symbols sit in one array of one row, ordered by strength, then listing order.
    """
    pairs = list(combinations(symbols, 2))
    ordered = F.array_sort(
        F.transform("pairs", lambda p, i: F.struct((-F.abs(p["r"])).alias("key"), i.alias("place"), p["a"].alias("a"), p["b"].alias("b"), p["r"].alias("r")))
    )

    def pick(listing: str, chosen: Column, k: int) -> Column:
        return F.transform(
            F.slice(chosen, 1, k),
            lambda p: F.struct(F.lit(listing).alias("listing"), p["a"].alias("a"), p["b"].alias("b"), p["r"].alias("r")),
        )

    listed = _pair_values(aligned, pairs).withColumn("ordered", ordered).select(
        F.inline(
            F.concat(
                pick("top", F.col("ordered"), 3),
                pick("positive", F.filter("ordered", lambda p: p["r"] > 0), 2),
                pick("negative", F.filter("ordered", lambda p: p["r"] < 0), 2),
            )
        ).alias("listing", "symbol_a", "symbol_b", "correlation")
    )
    dim = symbol_dim(aligned.sparkSession)
    a = dim.select(F.col("symbol").alias("symbol_a"), F.col("name").alias("name_a"), F.col("color").alias("color1"))
    b = dim.select(F.col("symbol").alias("symbol_b"), F.col("name").alias("name_b"), F.col("color").alias("color2"))
    return listed.join(a, "symbol_a").join(b, "symbol_b").select(
        F.concat_ws("-", "symbol_a", "symbol_b").alias("pair"),
        F.concat_ws(" vs ", "name_a", "name_b").alias("name"),
        "correlation", "color1", "color2", strength(F.col("correlation")).alias("strength"), "listing",
    )
