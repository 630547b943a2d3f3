"""Ordered tick series that no single task ever has to hold.

A market has few symbols and very many ticks, so ``Window.partitionBy("symbol")`` would put a
third of all rows into one task. A series is therefore stored as equal blocks:

* rows are range-partitioned on (symbol, event_ts, seq) - Spark samples the composite key, so a
  hot symbol or a hot instant is split like any other rows;
* every row gets ``pos``, its 0-based place within the symbol (place inside its range partition
  plus the row counts of the partitions before it);
* ``block = pos div block_rows`` cuts each symbol into blocks of equal size;
* the table is bucketed by (symbol, block), so block windows and block joins read it without
  another shuffle;
* each block also holds copies (``own = false``) of the LEAD_IN rows before it and the LEAD_OUT
  rows after it, so windows that look a few rows back or ahead are complete inside the block;
  ``reaching`` stores a series again with larger blocks and more copies for longer look-backs;
* new days extend a stored series (``append_days``): blocks already written stay as they are.

Unbounded prefixes (running peak, intraday extremes) combine two levels: a window inside the
block and a window over one summary row per block.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tickloom.session import new_folder, remove, stored, stored_at

LEAD_IN = 256
LEAD_OUT = 1
# of a series whose symbols have one block each
MAX_LEAD_IN = 1 << 62
MIN_BLOCK_ROWS = 2048
MAX_BLOCK_ROWS = 1_000_000
ROWS_PER_BUCKET = 8_000_000
# blocks reach buckets by hash; several per bucket even out the buckets
BLOCKS_PER_BUCKET = 16


@dataclass(frozen=True)
class TickSeries:
    """table: blocks with their copied edge rows; ends: symbol, n (ticks per symbol), last_ts.

    ``lead_in`` rows before each block are copied into it; ``buckets`` is 0 for a series that is not stored.
    """

    table: DataFrame
    ends: DataFrame
    block_rows: int
    name: str
    lead_in: int = LEAD_IN
    buckets: int = 0

    @property
    def rows(self) -> DataFrame:
        """Every tick exactly once."""
        return self.table.where("own").drop("own")

    @property
    def lengths(self) -> DataFrame:
        """symbol, n."""
        return self.ends.select("symbol", "n")

    @cached_property
    def last(self) -> list:
        """The rows of ``ends``: one per symbol, and a market has few symbols."""
        return self.ends.collect()

    def newest(self, k: int, least: int = 0) -> Column:
        """Predicate of the last k ticks of every symbol with ``least`` or more, in constants that reach the scan."""
        each = [
            F.col("symbol").eqNullSafe(F.lit(e.symbol)) & (F.col("pos") >= F.lit(e.n - k))
            for e in self.last if e.n >= least
        ]
        return reduce(Column.__or__, each, F.lit(False))

    def since(self, interval: str, symbol: str | None = None) -> Column:
        """Predicate of the ticks within an interval before the newest tick (of a symbol, or of all)."""
        times = [e.last_ts for e in self.last if e.last_ts is not None and symbol in (None, e.symbol)]
        if not times:
            return F.lit(False)
        return F.col("event_ts") >= F.lit(max(times)) - F.expr(f"INTERVAL {interval}")


def block_window() -> WindowSpec:
    return Window.partitionBy("symbol", "block").orderBy("pos")


def last_rows(n: int) -> WindowSpec:
    """The current row and the n-1 before it (n <= LEAD_IN, so copies complete the frame)."""
    if n > LEAD_IN:
        raise ValueError(f"more than {LEAD_IN} rows need long_frame, which has blocks that reach further back")
    return block_window().rowsBetween(-(n - 1), Window.currentRow)


def running() -> WindowSpec:
    return block_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def earlier_blocks(*keys: str) -> WindowSpec:
    """Over block summaries: everything before this block."""
    return Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def _layout(rows: int, parallelism: int) -> tuple[int, int]:
    """(rows per block, buckets) for a row count: at least one bucket per core."""
    buckets = max(parallelism, math.ceil(rows / ROWS_PER_BUCKET))
    block_rows = math.ceil(rows / (buckets * BLOCKS_PER_BUCKET))
    return min(MAX_BLOCK_ROWS, max(MIN_BLOCK_ROWS, block_rows)), buckets


def _in_blocks(rows: DataFrame, block_rows: int, lead_in: int) -> DataFrame:
    """Every row in its block, and its copies (``own`` is false) in the blocks around that look at it."""
    def block_of(pos):
        return F.floor(pos / F.lit(block_rows))

    # every block that starts within the next lead_in rows, however small blocks are
    pos = F.col("pos")
    block = block_of(pos)
    targets = F.sequence(block_of(F.greatest(pos - F.lit(LEAD_OUT), F.lit(0))), block_of(pos + F.lit(lead_in)))
    return rows.withColumn("block", F.explode(targets)).withColumn("own", F.col("block") == block)


def _bucketed(blocks: DataFrame, buckets: int) -> DataFrameWriter:
    return blocks.write.format("parquet").bucketBy(buckets, "symbol", "block").sortBy("symbol", "block", "pos")


def _write_blocks(
    rows: DataFrame, ends: DataFrame, block_rows: int, buckets: int, lead_in: int = LEAD_IN
) -> TickSeries:
    """Copy edge rows to the neighbouring blocks and write the bucketed table."""
    spark = rows.sparkSession
    name = f"tickloom_series_{uuid.uuid4().hex}"
    writer = _bucketed(_in_blocks(rows, block_rows, lead_in), buckets)
    writer.option("path", new_folder(spark, "series")).saveAsTable(name)
    return TickSeries(spark.table(name), ends, block_rows, name, lead_in, buckets)


def build_series(
    ticks: DataFrame,
    derive: Callable[[TickSeries], DataFrame] | None = None,
    block_rows: int | None = None,
    lead_in: int = LEAD_IN,
) -> TickSeries:
    """Order ticks (needs symbol, event_ts and a unique seq) and store them as blocks.

    ``derive`` may add columns that depend on neighbouring ticks; it gets the stored series and
    returns one row per tick, which is stored again in the same layout.
    """
    spark = ticks.sparkSession
    size, buckets = _layout(ticks.count(), spark.sparkContext.defaultParallelism)
    if block_rows is not None and block_rows < 1:
        raise ValueError("a block holds at least one row")
    if lead_in < LEAD_IN:
        raise ValueError(f"the shorter windows rely on {LEAD_IN} copied rows")
    size = block_rows or size

    # 1. one range shuffle; the id is (partition << 33) + place inside the sorted partition
    order = ("symbol", "event_ts", "seq")
    ordered, ordered_path = stored_at(
        ticks.repartitionByRange(buckets, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()),
        "ordered",
    )
    ordered = ordered.withColumn("_part", F.shiftright("_id", 33))

    # 2. rows before each (symbol, partition): a window over partition counts only
    before = Window.partitionBy("symbol").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets, offsets_path = stored_at(
        ordered.groupBy("symbol", "_part")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.max("event_ts").alias("_last"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))),
        "offsets",
    )
    ends = stored(offsets.groupBy("symbol").agg(F.sum("_n").alias("n"), F.max("_last").alias("last_ts")), "ends")

    # 3. global place of every row, then equal blocks
    placed = (
        ordered.join(offsets.drop("_n", "_last"), ["symbol", "_part"])
        .withColumn("pos", F.col("_offset") + F.col("_id") - F.col("_first"))
        .drop("_id", "_part", "_first", "_offset")
    )
    series = _write_blocks(placed, ends, size, buckets, lead_in)
    remove(spark, ordered_path)
    remove(spark, offsets_path)
    if derive is None:
        return series
    made = _write_blocks(derive(series).drop("block", "own"), ends, size, buckets, lead_in)
    drop_blocks(series)
    return made


def reaching(series: TickSeries, n: int) -> TickSeries:
    """The series itself if its blocks hold the n rows before them, else it is stored again so that they do.

    Blocks grow to at least four times n, so copies stay under a quarter of the rows and a block stays a small
    multiple of what its longest window needs anyway.
    """
    if n <= series.lead_in:
        return series
    spark = series.table.sparkSession
    _, buckets = _layout(sum(e.n for e in series.last), spark.sparkContext.defaultParallelism)
    return _write_blocks(series.rows.drop("block"), series.ends, max(series.block_rows, 4 * n), buckets, n)


def append_days(
    series: TickSeries,
    ticks: DataFrame,
    derive: Callable[[TickSeries], DataFrame] | None = None,
) -> TickSeries:
    """A stored series with the ticks of later days added; files already written are neither read whole nor changed.

    ``ticks`` has the columns the series was built from. A symbol's new ticks begin on a later day than its last
    stored one (ValueError otherwise, also for a tick without a time); new symbols may come along. ``derive`` is the
    function the series was built with; it looks back at most ``lead_in`` ticks, or within one day. Only the new
    ticks and the last ``lead_in`` of each symbol are ordered and placed; the open last block is filled up by files
    of its own. Old rows already stand as copies in the block that would begin after them, so windows are complete
    across the seam. Without new ticks the same series is returned. Use the returned series from here on; the given
    one would show the new rows without knowing their number.
    """
    if not series.name:
        raise ValueError("only a stored series can be extended")
    last_day = {e.symbol: e.last_ts for e in series.last}
    first = ticks.groupBy("symbol").agg(
        F.min("event_ts").alias("first_ts"), F.max(F.col("event_ts").isNull()).alias("untimed")
    )
    begins = first.collect()  # one row per symbol, and a market has few symbols
    for b in begins:
        last = last_day.get(b.symbol)
        if b.untimed or (last is not None and b.first_ts.date() <= last.date()):
            raise ValueError(f"ticks of {b.symbol} do not begin on a later day; build the series anew")
    if not begins:
        return series
    spark = series.table.sparkSession
    tail = series.rows.where(series.newest(series.lead_in)).select(*ticks.columns)
    fresh = build_series(tail.unionByName(ticks), derive, lead_in=series.lead_in)
    shift = series.ends.select(
        "symbol", F.least("n", F.lit(series.lead_in)).alias("_tail"), F.col("n").alias("_n")
    )
    none = F.lit(0).cast("long")
    placed = (
        fresh.rows.drop("block")
        .join(shift, fresh.rows["symbol"].eqNullSafe(shift["symbol"]), "left")
        .drop(shift["symbol"])
        .withColumns({"_tail": F.coalesce("_tail", none), "_n": F.coalesce("_n", none)})
        .where(F.col("pos") >= F.col("_tail"))
        .withColumn("pos", F.col("pos") - F.col("_tail") + F.col("_n"))
        .drop("_tail", "_n")
    )
    blocks = _in_blocks(placed, series.block_rows, series.lead_in).select(*series.table.columns)
    _bucketed(blocks, series.buckets).mode("append").saveAsTable(series.name)
    grown = fresh.ends.withColumnRenamed("n", "_fresh")
    ends = stored(
        shift.join(grown, shift["symbol"].eqNullSafe(grown["symbol"]), "full").select(
            F.coalesce(grown["symbol"], shift["symbol"]).alias("symbol"),
            (F.coalesce("_n", none) + F.coalesce("_fresh", none) - F.coalesce("_tail", none)).alias("n"),
            "last_ts",
        ),
        "ends",
    )
    drop_blocks(fresh)
    return replace(series, table=spark.table(series.name), ends=ends)


def one_block(ticks: DataFrame) -> TickSeries:
    """A series of few ticks, one block per symbol, that is not stored: a window places its rows. ``ends`` is lazy."""
    order = Window.partitionBy("symbol").orderBy("event_ts", "seq")
    table = ticks.withColumns({
        "pos": F.row_number().over(order).cast("long") - 1, "block": F.lit(0).cast("long"), "own": F.lit(True),
    })
    ends = ticks.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max("event_ts").alias("last_ts"))
    return TickSeries(table, ends, MAX_BLOCK_ROWS, "", lead_in=MAX_LEAD_IN)


def drop_blocks(series: TickSeries) -> None:
    """Remove the stored blocks of a series that is no longer read."""
    spark = series.table.sparkSession
    path = spark.sql(f"DESCRIBE FORMATTED {series.name}").where("col_name = 'Location'").first().data_type
    spark.sql(f"DROP TABLE {series.name}")
    remove(spark, path)
