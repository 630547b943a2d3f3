"""The layered tables: raw ticks, detail, bars, application marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.bars import summary_bars
from tickloom.operators.detail import tick_detail
from tickloom.operators.series import TickSeries
from tickloom.plans.marts import dashboard_metrics, latest_snapshot
from tickloom.sources.lake import append_json, overwrite_orc, read_orc, read_raw, register_layers, replace_orc, tick_lines

# Table names of the layers.
RAW = "ods_tick"
TABLES = ("dwd_tick_detail", "dws_tick_1min", "dws_tick_5min", "ads_dashboard_metrics", "ads_latest_snapshot")


def refresh(series: TickSeries, root: str) -> None:
    """Write every layer above the raw one; each day partition is replaced, so a rerun is safe."""
    overwrite_orc(tick_detail(series), f"{root}/dwd_tick_detail", in_time_order=True)
    overwrite_orc(summary_bars(series.rows, "1 minute"), f"{root}/dws_tick_1min")
    overwrite_orc(summary_bars(series.rows, "5 minutes"), f"{root}/dws_tick_5min")
    overwrite_orc(dashboard_metrics(series), f"{root}/ads_dashboard_metrics")
    replace_orc(latest_snapshot(series), f"{root}/ads_latest_snapshot")


def build(series: TickSeries, root: str) -> None:
    """First load: raw lake and all layers."""
    append_json(tick_lines(series.rows), f"{root}/{RAW}", in_time_order=True)
    refresh(series, root)


def layers(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored tables by name."""
    return {RAW: read_raw(spark, f"{root}/{RAW}")} | {t: read_orc(spark, f"{root}/{t}") for t in TABLES}


def register(spark: SparkSession, root: str) -> None:
    """All layers as temp views for spark.sql."""
    register_layers(layers(spark, root))
