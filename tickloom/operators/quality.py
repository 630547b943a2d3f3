"""Data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schema import DIRECTIONS, NUMBER_FIELDS


def tick_rules(ticks: DataFrame) -> DataFrame:
    """Violations per symbol of the accepted values and sanity rules (null counts as a violation)."""
    rules = {
        "bad_direction": F.col("direction").isin(*DIRECTIONS),
        "crossed_quote": F.col("bid") <= F.col("ask"),
        "outside_range": F.col("price").between(F.col("low"), F.col("high")),
        "price_not_positive": F.col("price") > 0,
    }
    return ticks.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("tick_count"),
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()],
    )


def layer_health(layers: dict[str, DataFrame]) -> DataFrame:
    """layer, row_count, status (OK / EMPTY)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("layer", F.lit(name))
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts).select(
        "layer", "row_count", F.when(F.col("row_count") > 0, "OK").otherwise("EMPTY").alias("status")
    )


def flow_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per symbol with the row count of every stage; stages a symbol never reached show 0."""
    tagged = [df.select("symbol", F.lit(name).alias("stage")) for name, df in stages.items()]
    counted = reduce(DataFrame.unionByName, tagged).groupBy("symbol", "stage").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("symbol").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("stage") == name, F.col("n"))), F.lit(0)).alias(name)
            for name in stages
        ]
    )


def parse_report(rows: DataFrame, corrupt: str = "_corrupt") -> DataFrame:
    """symbol, total_rows, bad_rows, ok - the result of a load-and-validate run.

    A row is bad when its text did not parse or a number is missing.
    """
    bad = F.col(corrupt).isNotNull()
    for name in NUMBER_FIELDS:
        bad = bad | F.col(name).isNull()
    return (
        rows.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(bad).alias("bad_rows"))
        .withColumn("ok", F.col("bad_rows") == 0)
    )
