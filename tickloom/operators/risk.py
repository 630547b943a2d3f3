"""Drawdown and risk metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import mean_of, percent
from tickloom.operators.series import TickSeries, earlier_blocks, running


def fall_from(peak: Column, price: Column) -> Column:
    """% below the peak; 0 while the peak is not positive."""
    return F.when(peak > 0, percent(peak - price, peak)).otherwise(F.lit(0.0))


def max_drawdown(series: TickSeries) -> DataFrame:
    """symbol, max_drawdown_pct: largest fall from an earlier peak, over the whole history.

    Each block yields (max, min, own drawdown); the peak of all earlier blocks then needs only
    the block's minimum, because that row falls furthest from it.
    """
    inside = (
        series.rows.withColumn("_fall", fall_from(F.max("price").over(running()), F.col("price")))
        .groupBy("symbol", "block")
        .agg(
            F.max("price").alias("block_max"),
            F.min("price").alias("block_min"),
            F.max("_fall").alias("block_fall"),
        )
    )
    peak = F.max("block_max").over(earlier_blocks("symbol"))
    across = F.coalesce(fall_from(F.col("_peak"), F.col("block_min")), F.lit(0.0))
    return (
        inside.withColumn("_peak", peak)
        .groupBy("symbol")
        .agg(F.greatest(F.max("block_fall"), F.max(across)).alias("max_drawdown_pct"))
    )


def latest_ticks(series: TickSeries, n: int, days: int | None = 7) -> DataFrame:
    """The newest n ticks of every symbol, none older than ``days`` before the newest tick of all.

    Places, lengths and newest times are stored, so both bounds are constants that prune the scan.
    """
    rows = series.rows.where(series.newest(n))
    return rows if days is None else rows.where(series.since(f"{days} DAYS"))


def drawdown_of_latest(latest: DataFrame, newest_first: bool = False) -> DataFrame:
    """symbol, max_drawdown_pct over an already limited set of newest ticks."""
    order = F.col("pos").desc() if newest_first else F.col("pos").asc()
    walked = (
        Window.partitionBy("symbol").orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        latest.withColumn("_fall", fall_from(F.max("price").over(walked), F.col("price")))
        .groupBy("symbol")
        .agg(F.max("_fall").alias("max_drawdown_pct"))
    )


def risk_metrics(series: TickSeries, n: int = 500, days: int = 7) -> DataFrame:
    """Volatility, spread and chronological drawdown over the newest n ticks (n bounds the window)."""
    latest = latest_ticks(series, n, days)
    walked = (
        Window.partitionBy("symbol").orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    moved = F.when(F.col("volatility") != 0, F.col("volatility"))
    return (
        latest.withColumn("_fall", fall_from(F.max("price").over(walked), F.col("price")))
        .groupBy("symbol")
        .agg(
            F.coalesce(F.avg(moved), F.lit(0.0)).alias("avg_volatility"),
            F.coalesce(F.max(moved), F.lit(0.0)).alias("max_volatility"),
            mean_of("spread").alias("avg_spread"),
            F.max("_fall").alias("max_drawdown_pct"),
            F.count(F.lit(1)).alias("tick_count"),
        )
    )


def risk_radar(metrics: DataFrame) -> DataFrame:
    """Chart scaling: volatility x 10^4, spread x 10^2, drawdown in %."""
    return metrics.select(
        "symbol",
        (F.col("avg_volatility") * 10000.0).alias("volatility_axis"),
        (F.col("avg_spread") * 100.0).alias("spread_axis"),
        F.col("max_drawdown_pct").alias("drawdown_axis"),
    )
