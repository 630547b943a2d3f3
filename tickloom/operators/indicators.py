"""Technical indicators over the last few ticks of a symbol.

Every function returns expressions for ``series.table``: block windows with copied edge rows, so
one sort per block serves all of them and no symbol is gathered in one task. ``pos`` gates the
warm-up, because it counts the ticks a symbol already has.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import EPSILON, percent_change, share_of
from tickloom.operators.series import LEAD_IN, TickSeries, block_window, last_rows, reaching, running

# Values below this can be added up as integers over any block without overflow.
SUMMABLE = 1e11

# Feature names in model order.
FEATURES = (
    "lag1", "lag2", "chg1", "sma_5_10", "sma_10_20", "rsi", "mom5", "mom10", "bb_pos",
    "vol_ratio", "vol_chg", "spread_p", "hl_p", "bam", "volat",
)


def _when_full(n: int, value: Column) -> Column:
    return F.when(F.col("pos") >= n - 1, value)


def lagged(column: str, k: int) -> Column:
    """The value k ticks before (k <= LEAD_IN, so copies complete the look-back)."""
    if k > LEAD_IN:
        raise ValueError(f"more than {LEAD_IN} rows need long_frame, which has blocks that reach further back")
    return F.lag(column, k).over(block_window())


def sma(n: int, column: str = "price") -> Column:
    """Mean of the last n values, null until n exist."""
    return _when_full(n, F.avg(column).over(last_rows(n)))


def momentum(k: int, column: str = "price") -> Column:
    """% change over k ticks."""
    return percent_change(F.col(column), lagged(column, k))


def rsi(n: int, delta: str = "_delta") -> Column:
    """Relative strength from plain means of n gains and n losses; needs the delta column."""
    if n >= LEAD_IN:
        raise ValueError(f"{LEAD_IN} or more changes need long_frame, which has blocks that reach further back")
    gain = F.avg(F.greatest(F.col(delta), F.lit(0.0))).over(last_rows(n))
    loss = F.avg(F.greatest(-F.col(delta), F.lit(0.0))).over(last_rows(n))
    strength = gain / (loss + F.lit(EPSILON))
    return _when_full(n + 1, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength))


def bollinger_position(n: int = 20) -> Column:
    """Distance from the mean in units of two sample standard deviations."""
    mean = F.avg("price").over(last_rows(n))
    width = F.stddev_samp("price").over(last_rows(n)) * 2.0 + F.lit(EPSILON)
    return _when_full(n, (F.col("price") - mean) / width)


def volume_ratio(n: int = 5) -> Column:
    return _when_full(n, F.col("volume") / (F.avg("volume").over(last_rows(n)) + F.lit(EPSILON)))


def with_delta(table: DataFrame) -> DataFrame:
    return table.withColumn("_delta", F.col("price") - lagged("price", 1))


def indicator_frame(series: TickSeries, **columns: Column) -> DataFrame:
    """Own rows with the given indicator columns."""
    return with_delta(series.table).withColumns(columns).where("own").drop("_delta")


def _prefix_means(name: str, value: Column) -> tuple[dict[str, Column], Callable[[int], Column]]:
    """(columns of running totals inside the block, mean of the last n values made of two of their rows).

    Whole parts and hundred-millionths are added up as integers, so a difference of totals loses nothing.
    """
    usable = F.abs(value) < F.lit(SUMMABLE)
    whole = F.floor(value)
    parts = {
        "whole": F.when(usable, whole),
        "rest": F.when(usable, F.round((value - whole) * F.lit(1e8)).cast("bigint")),
        "known": F.when(value.isNotNull(), F.lit(1)),
        "odd": F.when(~usable, F.lit(1)),
    }
    totals = {f"_{name}_{k}": F.coalesce(F.sum(c).over(running()), F.lit(0).cast("long")) for k, c in parts.items()}

    def mean(n: int) -> Column:
        def of(part: str) -> Column:
            total = F.col(f"_{name}_{part}")
            return total - F.coalesce(F.lag(total, n).over(block_window()), F.lit(0).cast("long"))

        total = of("whole").cast("double") + of("rest").cast("double") / F.lit(1e8)
        return F.when(of("odd") == 0, F.try_divide(total, of("known").cast("double")))

    return totals, mean


def long_frame(
    series: TickSeries,
    averages: Mapping[str, int] | None = None,
    changes: Mapping[str, int] | None = None,
    strengths: Mapping[str, int] | None = None,
    column: str = "price",
) -> DataFrame:
    """Own rows with means of the last n values, % changes over n ticks and relative strengths of n changes, any n.

    A window frame of n rows costs n steps a row. Here each mean is the difference of two running totals of the
    block, so the cost does not depend on n, and no tick is shuffled. A series whose blocks do not reach far enough
    back is stored again first (``reaching``); pass a series that does to save that. Like the short forms, results are
    null until n ticks exist, and nulls do not count in a mean. A mean whose window holds a value that is not finite,
    or 1e11 and above, is null. Averages are exact to eight decimals of each value.
    """
    averages, changes, strengths = averages or {}, changes or {}, strengths or {}
    if any(n < 1 for n in (*averages.values(), *changes.values(), *strengths.values())):
        raise ValueError("a look-back covers at least one tick")
    reach = max([*averages.values(), *changes.values(), *(n + 1 for n in strengths.values())], default=1)
    deep = reaching(series, reach)
    value = F.col(column)
    # a change is unknown on the first copied row of a block, which no window of an own row holds
    table = deep.table.withColumn("_delta", value - F.lag(column, 1).over(block_window()))
    means = {
        "value": _prefix_means("value", value),
        "gain": _prefix_means("gain", F.when(F.col("_delta") > 0, F.col("_delta")).otherwise(F.col("_delta") * 0.0)),
        "loss": _prefix_means("loss", F.when(F.col("_delta") < 0, -F.col("_delta")).otherwise(F.col("_delta") * 0.0)),
    }
    used = [*(["value"] if averages else []), *(["gain", "loss"] if strengths else [])]
    totals = {k: c for name in used for k, c in means[name][0].items()}
    made = {k: _when_full(n, means["value"][1](n)) for k, n in averages.items()}
    made |= {k: percent_change(value, F.lag(column, n).over(block_window())) for k, n in changes.items()}
    for k, n in strengths.items():
        strength = means["gain"][1](n) / (means["loss"][1](n) + F.lit(EPSILON))
        made[k] = _when_full(n + 1, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength))
    return table.withColumns(totals).withColumns(made).where("own").drop("_delta", *totals)


def feature_table(series: TickSeries) -> DataFrame:
    """series.table with the 15 features, ``label`` (next tick is UP; null on the last tick) and
    ``ready`` (all features present). Copied edge rows stay, marked by ``own``."""
    price = F.col("price")
    raw = with_delta(series.table).withColumns(
        {
            "_sma5": sma(5),
            "_sma10": sma(10),
            "_sma20": sma(20),
            "lag1": lagged("price", 1),
            "lag2": lagged("price", 2),
            "chg1": momentum(1),
            "rsi": rsi(14),
            "mom5": momentum(5),
            "mom10": momentum(10),
            "bb_pos": bollinger_position(20),
            "vol_ratio": volume_ratio(5),
            "vol_chg": momentum(5, "volume"),
            "_next": F.lead("direction").over(block_window()),
        }
    )
    featured = raw.withColumns(
        {
            "sma_5_10": share_of(F.col("_sma5") - F.col("_sma10"), price),
            "sma_10_20": share_of(F.col("_sma10") - F.col("_sma20"), price),
            "spread_p": share_of(F.col("spread"), price),
            "hl_p": share_of(F.col("high") - F.col("low"), price),
            "bam": (F.col("bid") + F.col("ask")) / 2.0 - price,
            "volat": F.col("volatility") * 10000.0,
            "label": F.when(F.col("_next").isNotNull(), (F.col("_next") == "UP").cast("int")),
        }
    )
    ready = F.lit(True)
    for name in FEATURES:
        ready = ready & F.col(name).isNotNull()
    return featured.withColumn("ready", ready).drop("_delta", "_sma5", "_sma10", "_sma20", "_next")


def training_rows(series: TickSeries) -> DataFrame:
    """Complete feature rows whose next tick is known."""
    return feature_table(series).where("own AND ready AND label IS NOT NULL").drop("own", "ready")


def bar_sma(bars: DataFrame, lengths=(5, 10, 20), start: str = "minute") -> DataFrame:
    """Candle averages: SMA of bar closes, null until enough bars exist.

    Windows run per (symbol, day) - a day holds a bounded number of bars - after the last bars of
    the days before have been copied in, so a long history never lands in one task.
    """
    keep = max(lengths) - 1
    day = F.to_date(start)
    newest_first = Window.partitionBy("symbol", "_day").orderBy(F.col(start).desc())
    dated = bars.withColumn("_day", day)
    # last bars of every day, as one small array per (symbol, day)
    tails = (
        dated.withColumn("_rn", F.row_number().over(newest_first))
        .where(F.col("_rn") <= keep)
        .groupBy("symbol", "_day")
        .agg(F.sort_array(F.collect_list(F.struct(F.col(start).alias("t"), "close_price"))).alias("tail"))
    )
    earlier_days = Window.partitionBy("symbol").orderBy("_day").rowsBetween(-keep, -1)
    carried = (
        tails.withColumn("_before", F.flatten(F.collect_list("tail").over(earlier_days)))
        .select("symbol", "_day", F.explode(F.slice("_before", F.greatest(F.size("_before") - keep + 1, F.lit(1)), keep)).alias("b"))
        .select("symbol", "_day", F.col("b.t").alias(start), F.col("b.close_price").alias("close_price"), F.lit(False).alias("_own"))
    )
    rows = dated.select("symbol", "_day", start, "close_price", F.lit(True).alias("_own")).unionByName(carried)
    in_day = Window.partitionBy("symbol", "_day").orderBy(start)

    def mean(n: int) -> Column:
        frame = in_day.rowsBetween(-(n - 1), Window.currentRow)
        return F.when(F.count("close_price").over(frame) == n, F.avg("close_price").over(frame))

    return rows.withColumns({f"sma_{n}": mean(n) for n in lengths}).where("_own").drop("_own", "_day")
