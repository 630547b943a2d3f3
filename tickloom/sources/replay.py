"""Replay of stored ticks in the fair round-robin order of a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import TickSeries
from tickloom.schema import SYMBOLS, symbol_dim


def chosen_symbols(text: str | None) -> list[str]:
    """Comma list of symbols, validated; None means all."""
    if text is None:
        return list(SYMBOLS)
    names = [part.strip().upper() for part in text.split(",") if part.strip()]
    unknown = [n for n in names if n not in SYMBOLS]
    if unknown or not names:
        raise ValueError(f"unknown symbols: {unknown or text}")
    return names


def round_robin(series: TickSeries, symbols: list[str] | None = None) -> DataFrame:
    """Each tick with its round (place in the symbol) and send_order: one tick per symbol a round.

    send_order is counted, not sorted: ticks of all symbols in earlier rounds plus the symbols
    ahead in this round, both from the stored lengths.
    """
    spark = series.table.sparkSession
    names = symbols or list(SYMBOLS)
    ranks = symbol_dim(spark).where(F.col("symbol").isin(*names)).select("symbol", "symbol_rank")
    # one array with (rank, length) of each symbol: as many entries as the symbol table has rows
    lengths = (
        series.lengths.join(ranks, "symbol")
        .agg(F.collect_list(F.struct(F.col("symbol_rank").alias("r"), F.col("n").alias("n"))).alias("l"))
        .scalar()
    )
    sent_before = F.aggregate(
        "_lengths",
        F.lit(0).cast("bigint"),
        lambda total, x: total
        + F.least(x["n"], F.col("pos"))
        + F.when((x["r"] < F.col("symbol_rank")) & (x["n"] > F.col("pos")), 1).otherwise(0),
    )
    return (
        series.rows.join(ranks, "symbol")
        .withColumn("_lengths", lengths)
        .withColumns({"round": F.col("pos"), "send_order": sent_before})
        .drop("_lengths")
    )


def loop(series: TickSeries, times: int, shift: bool = True) -> DataFrame:
    """The whole history ``times`` over, numbered by ``pass``.

    With shift, pass k is moved by k times the covered span plus 1 s; without, the same rows are
    sent again.
    """
    passes = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    rows = series.rows.withColumn("pass", passes)
    if not shift:
        return rows
    micros = F.unix_micros("event_ts")
    span = series.rows.agg((F.max(micros) - F.min(micros) + F.lit(1_000_000)).alias("span")).scalar()
    return rows.withColumn("event_ts", F.timestamp_micros(micros + F.col("pass") * span))
