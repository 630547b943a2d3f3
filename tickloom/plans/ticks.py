"""Tick series over the test tables: events stand in for the quotes of five symbols."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.detail import derive_tick_columns
from tickloom.operators.series import TickSeries, build_series
from tickloom.session import tune

# Which event type plays which symbol, and the start of the dense clock.
EVENT_SYMBOLS = {"click": "GOLD", "error": "OIL", "purchase": "SILVER", "signup": "COPPER", "view": "GAS"}
DENSE_START = "2026-07-11 13:30:00"


def quotes(spark: SparkSession, sf_dir: str, clock: str = "dense") -> DataFrame:
    """seq, symbol, event_ts, price, volume, spread - one row per event.

    dense: one tick per second; wide: the recorded event time.
    """
    symbol = F.lit(None).cast("string")
    for event_type, name in EVENT_SYMBOLS.items():
        symbol = F.when(F.col("event_type") == event_type, name).otherwise(symbol)
    if clock == "dense":
        event_ts = F.lit(DENSE_START).cast("timestamp") + F.make_dt_interval(secs=F.col("event_id"))
    else:
        event_ts = F.col("ts").cast("timestamp")
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .where(F.col("event_type").isin(*EVENT_SYMBOLS))
        .select(
            F.col("event_id").alias("seq"),
            symbol.alias("symbol"),
            event_ts.alias("event_ts"),
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").cast("double").alias("volume"),
            (F.col("value") * (1 + F.col("event_id") % 7) / 10000).alias("spread"),
        )
    )


_built: dict[tuple[str, str, str], TickSeries] = {}
_lock = threading.Lock()


def tick_series(spark: SparkSession, sf_dir: str, clock: str = "dense") -> TickSeries:
    """The stored tick series of a data folder, built once per application."""
    tune(spark)
    key = (spark.sparkContext.applicationId, sf_dir, clock)
    with _lock:
        if key not in _built:
            _built[key] = build_series(quotes(spark, sf_dir, clock), derive=derive_tick_columns)
    return _built[key]
