"""Alert thresholds and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_defaults(stored: DataFrame, defaults: DataFrame) -> DataFrame:
    """Stored limits, and the defaults of symbols that have none."""
    missing = defaults.join(stored.select("symbol"), "symbol", "left_anti")
    return missing.unionByName(stored.select(*defaults.columns))


def upsert_thresholds(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Changed symbols replace stored ones; the rest stay. Of two changes of a symbol the later row wins."""
    limits = [c for c in changes.columns if c != "symbol"]
    placed = changes.withColumn("_place", F.monotonically_increasing_id())
    once = placed.groupBy("symbol").agg(F.max_by(F.struct(*limits), "_place").alias("limits")).select("symbol", "limits.*")
    return with_defaults(once, current)


def reset_threshold(current: DataFrame, defaults: DataFrame, symbol: str) -> DataFrame:
    """One symbol back to its default."""
    kept = current.where(F.col("symbol") != symbol)
    return kept.unionByName(defaults.where(F.col("symbol") == symbol))


def evaluate(ticks: DataFrame, thresholds: DataFrame) -> DataFrame:
    """One row per breach: price above upper, below lower, or a move of at least vol_pct percent.

    ``ticks`` needs symbol, event_ts, seq, price, price_change_pct. Thresholds join by symbol and
    each tick is tested in place, so the ticks are not shuffled.
    """

    def breach(test, kind: str, limit: str):
        return F.when(
            test,
            F.struct(F.lit(kind).alias("kind"), F.col(limit).alias("threshold")),
        )

    breaches = F.array_compact(
        F.array(
            breach(F.col("price") > F.col("upper"), "upper", "upper"),
            breach(F.col("price") < F.col("lower"), "lower", "lower"),
            breach(F.abs("price_change_pct") >= F.col("vol_pct"), "volatility", "vol_pct"),
        )
    )
    return (
        ticks.join(thresholds, "symbol")
        .select(
            "symbol", F.col("event_ts").alias("event_time"), "seq", "price", "price_change_pct",
            F.explode(breaches).alias("b"),
        )
        .select("symbol", "event_time", "seq", "price", "price_change_pct", "b.kind", "b.threshold")
    )


def newest_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    return alerts.orderBy(F.col("event_time").desc(), F.col("seq").desc(), "kind").limit(limit)
