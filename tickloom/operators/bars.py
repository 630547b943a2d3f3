"""OHLC bars of any size: direct, partial + merge, sliding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numeric import fixed, mean_of, percent_change
from tickloom.functions.temporal import bucket_start, interval_text
from tickloom.operators.detail import spread_pct


def _ohlc(high: str, low: str) -> list[Column]:
    # pos is unique per symbol and fixed-width: open/close stay in the hash aggregate
    return [
        F.min_by("price", "pos").alias("open_price"),
        F.max(high).alias("high_price"),
        F.min(low).alias("low_price"),
        F.max_by("price", "pos").alias("close_price"),
        mean_of("price").alias("avg_price"),
        F.sum("volume").alias("total_volume"),
        F.count("price").alias("tick_count"),
    ]


def tick_bars(ticks: DataFrame, size: str = "1 minute", start: str = "minute") -> DataFrame:
    """Streaming-lake bar: extremes come from the ticks' own running day high / low columns."""
    return (
        ticks.groupBy("symbol", bucket_start("event_ts", size).alias(start))
        .agg(*_ohlc("high", "low"))
        .withColumn("dt", F.to_date(start))
    )


def _count_of(direction: str) -> Column:
    return F.count_if(F.col("direction") == direction).cast("int")


def summary_bars(ticks: DataFrame, size: str = "1 minute") -> DataFrame:
    """Warehouse bar: extremes of the price, spread / volatility statistics, direction counts."""
    return (
        ticks.groupBy("symbol", bucket_start("event_ts", size).alias("bar_time"))
        .agg(
            *_ohlc("price", "price"),
            mean_of("spread").alias("avg_spread"),
            F.avg(spread_pct()).alias("avg_spread_pct"),
            F.avg("volatility").alias("avg_volatility"),
            F.max("volatility").alias("max_volatility"),
            _count_of("UP").alias("up_count"),
            _count_of("DOWN").alias("down_count"),
            _count_of("FLAT").alias("flat_count"),
        )
        .withColumns(
            {
                "tick_count": F.col("tick_count").cast("int"),
                "price_change": F.col("close_price") - F.col("open_price"),
                "price_change_pct": percent_change(F.col("close_price"), F.col("open_price")),
                "minute": F.date_format("bar_time", "HH:mm"),
                "dt": F.to_date("bar_time"),
            }
        )
    )


def hourly_bars(ticks: DataFrame) -> DataFrame:
    """Hour candles; extremes of the price, volume at two decimals."""
    return (
        ticks.groupBy("symbol", F.date_trunc("hour", "event_ts").alias("hour_start"))
        .agg(
            F.min_by("price", "pos").alias("open"),
            F.max_by("price", "pos").alias("close"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("tick_count"),
        )
        .select(
            "symbol", F.date_format("hour_start", "yyyy-MM-dd HH:00").alias("time"),
            "open", "close", "high", "low", fixed("volume", 2).alias("volume"), "tick_count",
        )
    )


def partial_bars(ticks: DataFrame, size: str = "1 minute", *also_by: str) -> DataFrame:
    """Mergeable bars of one micro-batch: they keep when and with which tick they open and close.

    Ticks of a series are ordered by their place, a fixed-width number, so they stay in the hash
    aggregate; other ticks are ordered by (event_ts, seq) as one number, which does, too.
    """
    grouped = ticks.groupBy("symbol", bucket_start("event_ts", size).alias("minute"), *also_by)
    placed = "pos" in ticks.columns
    order = F.col("pos") if placed else time_order("event_ts", "seq")
    made = grouped.agg(
        F.min_by("price", order).alias("open_price"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.max_by("price", order).alias("close_price"),
        mean_of("price").alias("avg_price"),
        F.sum("volume").alias("total_volume"),
        F.count("price").alias("tick_count"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.min_by("pos" if placed else "seq", order).alias("first_seq"),
        F.max_by("pos" if placed else "seq", order).alias("last_seq"),
    )
    return made.withColumn("dt", F.to_date("minute"))


def time_order(event_ts: str, seq: str) -> Column:
    """(time, sequence) as one fixed-width number, which keeps min_by and max_by in the hash aggregate."""
    micros = F.unix_micros(event_ts).cast("decimal(38,0)")
    return (micros * F.lit(str(10**19)).cast("decimal(20,0)") + F.col(seq)).cast("decimal(38,0)")


def merge_partials(partials: DataFrame, start: str = "minute") -> DataFrame:
    """Combine partial bars that share (symbol, start) into final bars."""
    opened = time_order("first_ts", "first_seq")
    closed = time_order("last_ts", "last_seq")
    weight = F.col("tick_count")
    return (
        partials.groupBy("symbol", start)
        .agg(
            F.min_by("open_price", opened).alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", closed).alias("close_price"),
            F.try_divide(fixed(F.sum(F.col("avg_price") * weight), 8), F.sum(weight)).alias("avg_price"),
            F.sum("total_volume").alias("total_volume"),
            F.sum("tick_count").alias("tick_count"),
        )
        .withColumn("dt", F.to_date(start))
    )


def combine_partials(partials: DataFrame) -> DataFrame:
    """Partial bars that share (symbol, minute) as one partial bar, which merges on like its parts."""
    opened = time_order("first_ts", "first_seq")
    closed = time_order("last_ts", "last_seq")
    weight = F.col("tick_count")
    return (
        partials.groupBy("symbol", "minute")
        .agg(
            F.min_by("open_price", opened).alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", closed).alias("close_price"),
            F.try_divide(F.sum(F.col("avg_price") * weight), F.sum(weight)).alias("avg_price"),
            F.sum("total_volume").alias("total_volume"),
            F.sum("tick_count").alias("tick_count"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.min_by("first_seq", opened).alias("first_seq"),
            F.max_by("last_seq", closed).alias("last_seq"),
        )
        .withColumn("dt", F.to_date("minute"))
    )


def sliding_bars(ticks: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Bars over overlapping windows (size must be a multiple of slide).

    Ticks are first reduced to one partial bar per slide; only those bars are copied into the
    windows that contain them, never the ticks.
    """
    step = F.expr(f"INTERVAL {interval_text(slide)}")
    span = F.expr(f"INTERVAL {interval_text(size)}")
    starts = F.sequence(F.col("minute") - span + step, F.col("minute"), step)
    windows = partial_bars(ticks, slide).withColumn("window_start", F.explode(starts))
    return (
        merge_partials(windows, "window_start")
        .withColumn("window_end", F.col("window_start") + span)
        .drop("dt")
    )
