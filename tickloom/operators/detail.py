"""Detail layer: typed, enriched ticks with tick-to-tick changes and intraday extremes."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import fixed, percent, percent_change, ratio
from tickloom.operators.series import TickSeries, block_window, earlier_blocks, last_rows


def spread_pct() -> Column:
    """Spread as % of price, null unless the price is positive."""
    return F.when(F.col("price") > 0, percent(F.col("spread"), F.col("price")))


def mid_price() -> Column:
    """Quote midpoint, null unless both sides are positive."""
    return F.when((F.col("bid") > 0) & (F.col("ask") > 0), (F.col("bid") + F.col("ask")) / 2.0)


def enrich(ticks: DataFrame) -> DataFrame:
    """Add spread_pct and mid_price, six decimals."""
    return ticks.withColumns({"spread_pct": fixed(spread_pct(), 6), "mid_price": fixed(mid_price(), 6)})


def previous_price() -> Column:
    return F.lag("price").over(block_window())


def direction_of(now: Column, before: Column) -> Column:
    """UP / DOWN / FLAT from the sign of the move; the first tick is FLAT."""
    return F.when(now > before, "UP").when(now < before, "DOWN").otherwise("FLAT")


def derive_direction(series: TickSeries) -> DataFrame:
    """Own rows plus previous price and the direction derived from it."""
    return (
        series.table.withColumn("previous_price", previous_price())
        .where("own")
        .withColumn("derived_direction", direction_of(F.col("price"), F.col("previous_price")))
    )


def with_changes(series: TickSeries) -> DataFrame:
    """Own rows plus price_change and price_change_pct against the previous tick."""
    return (
        series.table.withColumn("_before", previous_price())
        .where("own")
        .withColumns(
            {
                "price_change": F.col("price") - F.col("_before"),
                "price_change_pct": percent_change(F.col("price"), F.col("_before")),
            }
        )
        .drop("_before")
    )


def tick_detail(series: TickSeries) -> DataFrame:
    """The 16 detail columns plus dt."""
    return enrich(with_changes(series)).select(
        "symbol", F.col("event_ts").alias("event_time"), "seq", "price", "volume", "bid", "ask", "spread",
        "spread_pct", "direction", "volatility", "high", "low", "price_change", "price_change_pct",
        "mid_price", F.hour("event_ts").alias("hour"), F.to_date("event_ts").alias("dt"),
    )


def day_carry(series: TickSeries) -> DataFrame:
    """One row per (symbol, block): the price extremes its first day already reached before it.

    Ticks are in time order, so only the first day of a block can have begun in an earlier block.
    """
    per_day = (
        series.rows.groupBy("symbol", "block", F.to_date("event_ts").alias("dt"))
        .agg(F.max("price").alias("day_high"), F.min("price").alias("day_low"))
    )
    before = earlier_blocks("symbol", "dt")
    return (
        per_day.withColumns(
            {
                "carry_high": F.max("day_high").over(before),
                "carry_low": F.min("day_low").over(before),
            }
        )
        .groupBy("symbol", "block")
        .agg(
            F.min("dt").alias("carry_dt"),
            F.max("carry_high").alias("carry_high"),
            F.min("carry_low").alias("carry_low"),
        )
    )


def intraday_extremes(series: TickSeries) -> DataFrame:
    """Own rows plus day_high / day_low: running extremes of the price within (symbol, day)."""
    in_block = (
        Window.partitionBy("symbol", "block", "_dt")
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same_day = F.col("_dt") == F.col("carry_dt")
    return (
        series.rows.withColumn("_dt", F.to_date("event_ts"))
        .withColumns({"_high": F.max("price").over(in_block), "_low": F.min("price").over(in_block)})
        .join(day_carry(series), ["symbol", "block"], "left")
        .withColumns(
            {
                "day_high": F.greatest("_high", F.when(same_day, F.col("carry_high"))),
                "day_low": F.least("_low", F.when(same_day, F.col("carry_low"))),
            }
        )
        .drop("_dt", "_high", "_low", "carry_dt", "carry_high", "carry_low")
    )


def derive_tick_columns(series: TickSeries) -> DataFrame:
    """Fill the quote-derived tick columns for sources that carry only price, volume and spread."""
    moved = (
        series.table.withColumn("_before", F.first("price").over(last_rows(2)))
        .withColumn("_before", F.when(F.col("pos") > 0, F.col("_before")))
        .withColumns(
            {
                "bid": F.col("price") - F.col("spread") / 2.0,
                "ask": F.col("price") + F.col("spread") / 2.0,
                "direction": direction_of(F.col("price"), F.col("_before")),
                "volatility": F.coalesce(
                    ratio(F.abs(F.col("price") - F.col("_before")), F.col("_before")), F.lit(0.0)
                ),
            }
        )
        .drop("_before")
    )
    with_quotes = replace(series, table=moved)
    return intraday_extremes(with_quotes).withColumnsRenamed({"day_high": "high", "day_low": "low"})
