"""Read side: one DataFrame per question, all symbols in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import fixed, percent_change
from tickloom.functions.temporal import time_text
from tickloom.operators.bars import merge_partials, summary_bars
from tickloom.operators.history import history_profile
from tickloom.operators.indicators import sma
from tickloom.operators.risk import risk_metrics
from tickloom.operators.series import TickSeries
from tickloom.plans.marts import newest_with_change
from tickloom.schema import symbol_dim


def _within(series: TickSeries, rows: DataFrame, days: int) -> DataFrame:
    return rows.where(series.since(f"{days} DAYS"))


def _or_zero(*names: str):
    return [F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names]


def latest(series: TickSeries, days: int = 7) -> DataFrame:
    """Newest quote of every known symbol; a symbol without recent ticks shows zeros and N/A."""
    dim = symbol_dim(series.table.sparkSession)
    newest = _within(series, newest_with_change(series), days)
    return dim.join(newest, "symbol", "left").select(
        "symbol", "name", *_or_zero("price"),
        fixed(F.coalesce("price_change", F.lit(0.0)), 4).alias("price_change"),
        fixed(F.coalesce("price_change_pct", F.lit(0.0)), 2).alias("price_change_pct"),
        *_or_zero("volume", "bid", "ask", "spread"),
        F.coalesce("direction", F.lit("N/A")).alias("direction"),
        *_or_zero("volatility"), "color", "unit",
    )


def trend(series: TickSeries, symbol: str, minutes: int = 4320, limit: int = 2000) -> DataFrame:
    """The newest ``limit`` ticks of one symbol within ``minutes``, ascending, with SMA 5 and 10."""
    length = max((e.n for e in series.last if e.symbol == symbol), default=0)
    return (
        # keeps the rows the averages look back on
        series.table.where((F.col("symbol") == symbol) & (F.col("pos") >= F.lit(length - limit - 20)))
        .withColumns({"sma_5": sma(5), "sma_10": sma(10)})
        .where(F.col("own") & (F.col("pos") >= F.lit(length - limit)))
        .where(series.since(f"{minutes} MINUTES", symbol))
        .orderBy("pos")
        .select(time_text("event_ts").alias("time"), "price", "volume", "sma_5", "sma_10")
    )


def volume(series: TickSeries, days: int = 7) -> DataFrame:
    """Traded volume per symbol over the last days."""
    totals = (
        _within(series, series.rows, days)
        .groupBy("symbol")
        .agg(
            F.sum("volume").alias("total_volume"),
            F.count(F.lit(1)).alias("tick_count"),
            F.avg("volume").alias("avg_volume"),
        )
    )
    dim = symbol_dim(series.table.sparkSession)
    return dim.join(totals, "symbol", "left").select(
        "symbol", "name", fixed(F.coalesce("total_volume", F.lit(0.0)), 2).alias("total_volume"),
        F.coalesce("tick_count", F.lit(0)).alias("tick_count"),
        fixed(F.coalesce("avg_volume", F.lit(0.0)), 4).alias("avg_volume"), "color",
    )


def risk(series: TickSeries, n: int = 500, days: int = 7) -> DataFrame:
    """Risk panel of every known symbol."""
    dim = symbol_dim(series.table.sparkSession)
    digits = {"avg_volatility": 6, "max_volatility": 6, "avg_spread": 4, "max_drawdown_pct": 4}
    return dim.join(risk_metrics(series, n, days), "symbol", "left").select(
        "symbol", "name",
        *[fixed(F.coalesce(c, F.lit(0.0)), d).alias(c) for c, d in digits.items()],
        F.coalesce("tick_count", F.lit(0)).alias("tick_count"), "color",
    )


def summary(series: TickSeries) -> DataFrame:
    """Price, change and drawdown side by side."""
    return latest(series).select("symbol", "name", "price", "price_change", "price_change_pct").join(
        risk(series).select("symbol", "max_drawdown_pct"), "symbol"
    )


def candles(partials: DataFrame, symbol: str, bars: int = 60, since: str | None = None) -> DataFrame:
    """The last bars of one symbol from the bar lake, oldest first, ordered by full bar time.

    ``since`` (yyyy-MM-dd) prunes day partitions of the lake.
    """
    rows = partials.where(F.col("symbol") == symbol)
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since).cast("date"))
    newest = merge_partials(rows).orderBy(F.col("minute").desc()).limit(bars)
    money = {"open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close",
             "avg_price": "avg", "total_volume": "volume"}
    return newest.orderBy("minute").select(
        "symbol", time_text("minute").alias("bar_time"), F.date_format("minute", "HH:mm").alias("time"),
        *[fixed(c, 2).alias(a) for c, a in money.items()], "tick_count",
    )


def aggregates(series: TickSeries, window: str = "1min", symbol: str | None = None) -> DataFrame:
    """Warehouse bars of a chosen size."""
    rows = series.rows if symbol is None else series.rows.where(F.col("symbol") == symbol)
    return summary_bars(rows, window)


def history_vs_latest(series: TickSeries) -> DataFrame:
    """History statistics next to the newest quote; diff_pct compares the price with the mean."""
    dim = symbol_dim(series.table.sparkSession)
    profile = history_profile(series.rows)
    now = newest_with_change(series).select(
        "symbol", F.col("price").alias("rt_price"), F.col("volume").alias("rt_volume")
    )
    avg = F.coalesce("avg_price", F.lit(0.0))
    return dim.join(profile, "symbol", "left").join(now, "symbol", "left").select(
        "symbol", "name", fixed(avg, 4).alias("csv_avg"),
        *[fixed(F.coalesce(c, F.lit(0.0)), d).alias(a)
          for c, d, a in (("min_price", 4, "csv_min"), ("max_price", 4, "csv_max"), ("total_volume", 2, "csv_volume"))],
        F.coalesce("count", F.lit(0)).alias("csv_count"),
        *_or_zero("rt_price", "rt_volume"),
        F.when(avg > 0, fixed(percent_change(F.coalesce("rt_price", F.lit(0.0)), fixed(avg, 4)), 4))
        .otherwise(F.lit(0.0)).alias("diff_pct"),
        "color",
    )


def asset_stats(series: TickSeries, lake: DataFrame, files: DataFrame) -> DataFrame:
    """Data volume per known symbol, zeros and empty text where there is none, plus lake rows and files.

    ``files``: symbol, lake_files, as from ``lake.files_by_symbol``, which reads names and sizes only.
    """
    dim = symbol_dim(series.table.sparkSession)
    profile = history_profile(series.rows)
    lines = lake.groupBy("symbol").agg(F.count(F.lit(1)).alias("lake_rows"))
    files = files.select("symbol", "lake_files")
    return dim.join(profile, "symbol", "left").join(lines, "symbol", "left").join(files, "symbol", "left").select(
        "symbol", "name", "color",
        F.coalesce("count", F.lit(0)).alias("csv_rows"),
        *[fixed(F.coalesce(c, F.lit(0.0)), d).alias(c)
          for c, d in (("avg_price", 4), ("min_price", 4), ("max_price", 4), ("total_volume", 2))],
        F.coalesce(time_text("first_time"), F.lit("")).alias("first"),
        F.coalesce(time_text("last_time"), F.lit("")).alias("last"),
        F.coalesce("lake_files", F.lit(0)).alias("lake_files"),
        F.coalesce("lake_rows", F.lit(0)).alias("lake_rows"),
    )


def enough_or_history(live: DataFrame, history: DataFrame, least: int = 25, keep: int = 60) -> DataFrame:
    """The newest ``keep`` rows of each symbol; one with fewer than ``least`` live rows is filled from history.

    ``source`` tells where a row is from; a history row that is also live counts once, as live.
    """
    key = ["symbol", "event_ts", "seq"]
    enough = live.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select("symbol")
    filled = history.join(enough, "symbol", "left_anti").join(live.select(*key), key, "left_anti")
    rows = live.withColumn("source", F.lit("live")).unionByName(filled.withColumn("source", F.lit("history")))
    newest = Window.partitionBy("symbol").orderBy(F.col("event_ts").desc(), F.col("seq").desc())
    return rows.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= keep).drop("_place")


def primary_or_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Rows of the live source; symbols it does not know come from the fallback. ``source`` tells."""
    known = primary.select("symbol").distinct()
    return primary.withColumn("source", F.lit("live")).unionByName(
        fallback.join(known, "symbol", "left_anti").withColumn("source", F.lit("history"))
    )
