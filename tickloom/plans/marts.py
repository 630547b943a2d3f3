"""Application tables: daily dashboard metrics and the latest snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import fixed, percent_change
from tickloom.functions.temporal import time_text
from tickloom.operators.detail import spread_pct
from tickloom.operators.indicators import sma
from tickloom.operators.risk import fall_from, latest_ticks
from tickloom.operators.series import TickSeries, earlier_blocks


def dashboard_metrics(series: TickSeries) -> DataFrame:
    """One row per (symbol, day).

    Ticks are reduced to one row per (symbol, day, block) where they lie; only those rows travel.
    """
    day_so_far = (
        Window.partitionBy("symbol", "block", "dt").orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    per_block = (
        series.table.withColumns({"sma_5": sma(5), "sma_10": sma(10), "sma_20": sma(20)})
        .where("own")
        .withColumns({"dt": F.to_date("event_ts"), "_spread_pct": spread_pct()})
        .withColumn("_fall", fall_from(F.max("price").over(day_so_far), F.col("price")))
        .groupBy("symbol", "dt", "block")
        .agg(
            F.min("pos").alias("_first"),
            F.max("pos").alias("_last"),
            F.min_by("price", "pos").alias("_open"),
            F.max_by("price", "pos").alias("_close"),
            F.max("price").alias("_high"),
            F.min("price").alias("_low"),
            F.sum("volume").alias("_volume"),
            F.sum("volatility").alias("_volatility"),
            F.sum("spread").alias("_spread"),
            F.sum("_spread_pct").alias("_pct"),
            F.count("_spread_pct").alias("_pct_n"),
            F.max_by("sma_5", "pos").alias("_sma_5"),
            F.max_by("sma_10", "pos").alias("_sma_10"),
            F.max_by("sma_20", "pos").alias("_sma_20"),
            F.count_if(F.col("direction") == "UP").alias("_up"),
            F.count(F.lit(1)).alias("_n"),
            F.max("_fall").alias("_block_fall"),
            F.max("event_ts").alias("_last_ts"),
        )
        .withColumn("_peak", F.max("_high").over(earlier_blocks("symbol", "dt")))
    )
    n = F.sum("_n")
    across = F.coalesce(fall_from(F.col("_peak"), F.col("_low")), F.lit(0.0))
    return (
        per_block.groupBy("symbol", "dt")
        .agg(
            F.max_by("_close", "_last").alias("latest_price"),
            F.min_by("_open", "_first").alias("open_price"),
            F.max("_high").alias("high_price"),
            F.min("_low").alias("low_price"),
            F.sum("_volume").alias("total_volume"),
            (F.sum("_volatility") / n).alias("avg_volatility"),
            F.greatest(F.max("_block_fall"), F.max(across)).alias("max_drawdown"),
            (fixed(F.sum("_spread"), 8) / n).alias("avg_spread"),
            F.try_divide(F.sum("_pct"), F.sum("_pct_n")).alias("avg_spread_pct"),
            F.max_by("_sma_5", "_last").alias("sma_5"),
            F.max_by("_sma_10", "_last").alias("sma_10"),
            F.max_by("_sma_20", "_last").alias("sma_20"),
            (F.sum("_up") / n).alias("up_ratio"),
            time_text(F.max("_last_ts")).alias("update_time"),
        )
        .withColumns(
            {
                "price_change": F.col("latest_price") - F.col("open_price"),
                "price_change_pct": percent_change(F.col("latest_price"), F.col("open_price")),
            }
        )
    )


def newest_with_change(series: TickSeries) -> DataFrame:
    """The last tick of each symbol with its change against the tick before (two rows per symbol)."""
    before = F.lag("price").over(Window.partitionBy("symbol").orderBy("pos"))
    return (
        latest_ticks(series, 2, days=None)
        .withColumn("_before", before)
        .where(series.newest(1))
        .withColumns(
            {
                "price_change": F.col("price") - F.col("_before"),
                "price_change_pct": percent_change(F.col("price"), F.col("_before")),
            }
        )
        .drop("_before")
    )


def latest_snapshot(series: TickSeries) -> DataFrame:
    """The 12 snapshot columns, one row per symbol."""
    return newest_with_change(series).select(
        "symbol", "price", "volume", "direction", "volatility", "spread",
        spread_pct().alias("spread_pct"), "price_change_pct", "bid", "ask",
        time_text("event_ts").alias("event_time"), F.to_date("event_ts").alias("dt"),
    )
