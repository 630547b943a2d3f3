"""Whole-history profile of each symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import mean_of
from tickloom.session import stored


def upper_median(ticks: DataFrame, value: str = "price") -> DataFrame:
    """symbol, median: the element at place n div 2 of the sorted values, exactly.

    Values are reduced to counts per distinct value, which a range shuffle puts in order: Spark samples
    (symbol, value), so values that lie close together are split like any others. The running count goes over
    partitions first, then inside the one partition of a symbol that holds the middle place.
    """
    spark = ticks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(
        ticks.where(F.col("symbol").isNotNull() & F.col(value).isNotNull())
        .groupBy("symbol", F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        .repartitionByRange(parts, "symbol", "_v").withColumn("_part", F.spark_partition_id()),
        "value-counts",
    )
    before = Window.partitionBy("symbol").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        counts.groupBy("symbol", "_part").agg(F.sum("_n").alias("_part_n"))
        .withColumns(
            {
                "_below": F.coalesce(F.sum("_part_n").over(before), F.lit(0)),
                "_place": F.floor(F.sum("_part_n").over(Window.partitionBy("symbol")) / F.lit(2)),
            }
        )
        .where((F.col("_place") >= F.col("_below")) & (F.col("_place") < F.col("_below") + F.col("_part_n")))
        .select("symbol", "_part", "_below", "_place")
    )
    up_to = Window.partitionBy("symbol", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.join(middle, ["symbol", "_part"])
        .withColumn("_upto", F.col("_below") + F.sum("_n").over(up_to))
        .where(F.col("_upto") > F.col("_place"))
        .groupBy("symbol")
        .agg(F.min("_v").alias("median"))
    )


def history_profile(ticks: DataFrame) -> DataFrame:
    """Count, price statistics with the upper median, volumes, first and last time."""
    totals = ticks.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("count"),
        mean_of("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("volume").alias("total_volume"),
        mean_of("volume").alias("avg_volume"),
        F.min("event_ts").alias("first_time"),
        F.max("event_ts").alias("last_time"),
    )
    return totals.join(upper_median(ticks).withColumnRenamed("median", "median_price"), "symbol")


def total_rollup(ticks: DataFrame) -> DataFrame:
    """Per-symbol counts and volume with a grand-total row (symbol 'ALL')."""
    return (
        ticks.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("volume").alias("_v"))
        .rollup("symbol")
        .agg(F.sum("_n").alias("row_count"), F.sum("_v").alias("total_volume"), F.grouping("symbol").alias("_all"))
        .withColumn("symbol", F.when(F.col("_all") == 1, "ALL").otherwise(F.col("symbol")))
        .drop("_all")
    )
