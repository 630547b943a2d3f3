"""Structured Streaming jobs over tick messages.

Every job takes a streaming frame of decoded ticks, so a file source and a broker source are
interchangeable, and returns a started query. Outputs written from ``foreachBatch`` are deltas of a
merge table, named by the query and its micro-batch (epoch): a batch that runs again after a failure
replaces its own output, another query never does, and compaction keeps the number of folders flat.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.functions.numeric import mean_of
from tickloom.functions.temporal import interval_text
from tickloom.operators.alerts import evaluate
from tickloom.operators.bars import partial_bars, time_order
from tickloom.operators.detail import enrich
from tickloom.operators.indicators import indicator_frame, lagged, momentum, sma
from tickloom.operators.risk import latest_ticks
from tickloom.operators.series import TickSeries, build_series, drop_blocks, one_block
from tickloom.schema import BAR_SCHEMA, SYMBOLS, TICK_FIELDS, TICK_SCHEMA
from tickloom.session import remove
from tickloom.sources.lake import KeyedTable, bar_table, flow_table, raw_table, rejected_table
from tickloom.sources.merge_table import MergeTable
from tickloom.sources.messages import decode, reject_reason

# Fixed value: the micro-batch interval of the live pipeline.
TRIGGER = "10 seconds"
KEPT_TICKS = 20
COMPACT_EVERY = 60
"""Micro-batches after which the tables of a job are compacted."""
MICRO_ROWS = 2_000_000
"""Ticks up to which a micro-batch is ordered by one window per symbol; a larger one (a backfill) is cut into blocks."""


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming ``value`` lines from a folder of JSON-lines files."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def decoded(messages: DataFrame) -> DataFrame:
    """Every message decoded, with its text; seq orders ticks of the same second."""
    if "offset" in messages.columns:
        return decode(messages.withColumn("seq", F.col("offset")), "value", "seq", "value")
    return decode(messages, "value", "value", also={"seq": "bigint"})


def known(ticks: DataFrame) -> DataFrame:
    """Ticks of known symbols. Exploding an empty-or-one array filters like a condition would, but is not
    pushed below the JSON parse, where it would parse each message again."""
    here = F.array_compact(F.array(F.when(F.col("symbol").isin(*SYMBOLS), F.lit(1))))
    return ticks.withColumn("_known", F.explode(here)).drop("_known")


def ticks_of(messages: DataFrame) -> DataFrame:
    """Decoded ticks of known symbols."""
    return known(decoded(messages)).drop("value")


def _start(writer, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def writer_of(batch: DataFrame) -> str:
    """The id of the query that runs the batch. It is kept in the checkpoint, so a restart has the same, and a new
    checkpoint, whose epochs start again, another."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _add(batch: DataFrame, epoch: int, parts: list[tuple[MergeTable, DataFrame]]) -> None:
    writer = writer_of(batch)
    for table, rows in parts:
        table.write(rows, epoch, writer)
        if epoch % COMPACT_EVERY == COMPACT_EVERY - 1:
            table.compact()


def ingest(
    messages: DataFrame, root: str, checkpoint: str, interval: str | None = TRIGGER
) -> StreamingQuery:
    """Raw lake, mergeable one-minute bars, rejected messages and flow counts from one read of each micro-batch.

    Fills ``lake.raw_table`` at root/raw, ``bar_table`` at root/bars, ``rejected_table`` at root/rejected and
    ``flow_table`` at root/flow.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ticks = known(batch)
            judged = batch.withColumn("reason", reject_reason())
            bad = judged.where("reason IS NOT NULL")
            flow = judged.groupBy("symbol").agg(
                F.count(F.lit(1)).alias("messages"),
                F.count_if(F.col("symbol").isin(*SYMBOLS)).alias("ticks"), F.count("reason").alias("rejected"),
            )
            _add(batch, epoch, [
                (raw_table(spark, f"{root}/raw"), ticks.select(*TICK_FIELDS, "seq", "dt")),
                (bar_table(spark, f"{root}/bars"), partial_bars(ticks.where("event_ts IS NOT NULL"))),
                (rejected_table(spark, f"{root}/rejected"), bad.select(F.col("value").cast("string").alias("value"), "reason")),
                (flow_table(spark, f"{root}/flow"), flow),
            ])
        finally:
            batch.unpersist()

    return _start(decoded(messages).writeStream.outputMode("append").foreachBatch(write), checkpoint, interval)


def watermarked_bars(ticks: DataFrame, size: str, slide: str | None, delay: str) -> DataFrame:
    """Stateful bars: tumbling, or sliding when slide is given; ticks later than delay are dropped
    (counted by the query's progress)."""
    window = F.window("event_ts", interval_text(size), interval_text(slide) if slide else None)
    order = time_order("event_ts", "seq")
    return (
        ticks.withWatermark("event_ts", interval_text(delay))
        .groupBy(window.alias("w"), "symbol")
        .agg(
            F.min_by("price", order).alias("open_price"),
            F.max("high").alias("high_price"),
            F.min("low").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            mean_of("price").alias("avg_price"),
            F.sum("volume").alias("total_volume"),
            F.count("price").alias("tick_count"),
        )
        .select("symbol", F.col("w.start").alias("minute"), F.col("w.end").alias("minute_end"),
                "open_price", "high_price", "low_price", "close_price", "avg_price", "total_volume",
                "tick_count")
    )


def stream_bars(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "1 minute",
    slide: str | None = None,
    delay: str = "10 minutes",
    interval: str | None = TRIGGER,
) -> StreamingQuery:
    """Bars as they change (update mode): each epoch adds the bars it touched to ``streamed_bars``."""

    def write(batch: DataFrame, epoch: int) -> None:
        stamp = F.lit(time.time_ns() // 1000).cast("long")
        rows = batch.withColumns({"dt": F.to_date("minute"), "stamp": stamp})
        _add(batch, epoch, [(streamed_bars(batch.sparkSession, path), rows)])

    bars = watermarked_bars(ticks, size, slide, delay)
    return _start(bars.writeStream.outputMode("update").foreachBatch(write), checkpoint, interval)


STREAMED_BAR = T.StructType([
    *[f for f in BAR_SCHEMA.fields if not f.name.startswith(("first_", "last_"))],
    T.StructField("minute_end", T.TimestampType()), T.StructField("stamp", T.LongType()),
])


def streamed_bars(spark: SparkSession, path: str) -> MergeTable:
    """The table that ``stream_bars`` fills, in a bucket per day; the newest state of each bar wins."""
    return KeyedTable(spark, path, STREAMED_BAR, ["symbol", "minute"], ["stamp"], F.col("dt"))


def current_bars(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of each streamed bar, from one base per day and the newer epochs."""
    return streamed_bars(spark, path).read().drop("stamp")


class LateRows(StreamingQueryListener):
    """Counts the late ticks that the watermark drops, over the whole run of each query.

    Add it with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.dropped.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        run = str(event.progress.runId)
        self.dropped[run] = self.dropped.get(run, 0) + late

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.dropped.get(str(query.runId), 0)


KEYED_SCHEMA = T.StructType([
    *TICK_SCHEMA.fields, T.StructField("seq", T.LongType()), T.StructField("event_ts", T.TimestampType()),
    T.StructField("dt", T.DateType()), T.StructField("spread_pct", T.DoubleType()), T.StructField("mid_price", T.DoubleType()),
])


def keyed_table(spark: SparkSession, path: str) -> KeyedTable:
    """The table that ``keyed_upsert`` fills. Buckets follow the day in the key, so a compaction touches recent days."""
    stamp = F.col("timestamp")
    day = F.when(stamp.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(stamp, 1, 10)).otherwise("other")
    bucket = F.concat_ws("-", day, F.pmod(F.xxhash64("symbol", "timestamp"), F.lit(4)))
    return KeyedTable(spark, path, KEYED_SCHEMA, ["symbol", "timestamp"], ["event_ts", "seq"], bucket)


def keyed_upsert(ticks: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER) -> StreamingQuery:
    """One enriched row per symbol-timestamp; the later tick replaces the earlier one.

    A second, independent reader of the same messages: own checkpoint, starts from the oldest. Each micro-batch
    adds one delta under the id of its query. A tick whose time cannot be read is kept, too.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        rows = enrich(batch.select(*TICK_FIELDS, "seq", "event_ts", "dt"))
        _add(batch, epoch, [(keyed_table(batch.sparkSession, path), rows)])

    return _start(ticks.writeStream.outputMode("append").foreachBatch(write), checkpoint, interval)


def first_per_key(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The other dedup: the first tick of each symbol-timestamp wins, state bounded by the watermark."""
    return ticks.withWatermark("event_ts", interval_text(delay)).dropDuplicatesWithinWatermark(
        ["symbol", "timestamp"]
    )


def _last_state(spark: SparkSession, path: str, epoch: int) -> DataFrame | None:
    return spark.read.parquet(f"{path}/epoch={epoch - 1}") if epoch > 0 else None


def _newest(rows: DataFrame, keep: int) -> DataFrame:
    newest = Window.partitionBy("symbol").orderBy(F.col("event_ts").desc(), F.col("seq").desc())
    return rows.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= keep)


def over_history(ticks: DataFrame, publish: Callable[[TickSeries, DataFrame, int], None], keep: int,
                 state_path: str, checkpoint: str, interval: str | None = TRIGGER) -> StreamingQuery:
    """Runs ``publish(series, late, epoch)`` on every micro-batch together with the ticks before it.

    Row windows do not run on streams, so each micro-batch is joined by the last ``keep`` ticks of every symbol, the
    state that the batch before it left; its own ticks have ``fresh`` set. Up to MICRO_ROWS ticks are placed by one
    window per symbol, nothing is stored but the new state; only a larger batch is built into blocks. States before
    the last two epochs are removed. A tick older than the stored end of its symbol is late: it is handed over apart,
    as it must not rewrite rows already published.
    """
    columns = ["symbol", "event_ts", "seq", "price"]
    kept_schema = "symbol string, event_ts timestamp, seq bigint, price double"

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = _last_state(spark, state_path, epoch)
        if before is None:
            before = spark.createDataFrame([], kept_schema)
        order = F.struct("event_ts", "seq")
        ends = before.groupBy("symbol").agg(F.max(order).alias("_end"))
        placed = (
            batch.select(*columns).join(ends, "symbol", "left")
            .withColumn("late", F.coalesce(order <= F.col("_end"), F.lit(False)))
            .drop("_end").persist(StorageLevel.MEMORY_AND_DISK)
        )
        try:
            fresh = placed.where("NOT late").withColumn("fresh", F.lit(True)).drop("late")
            kept = before.select(*columns).withColumn("fresh", F.lit(False))
            rows = fresh.unionByName(kept)
            small = placed.count() <= MICRO_ROWS
            series = one_block(rows) if small else build_series(rows)
            publish(series, placed.where("late"), epoch)
            newest = _newest(rows, keep) if small else latest_ticks(series, keep, days=None)
            newest.select(*columns).write.mode("overwrite").parquet(f"{state_path}/epoch={epoch}")
            if not small:
                drop_blocks(series)
            if epoch >= 2:
                remove(spark, f"{state_path}/epoch={epoch - 2}")
        finally:
            placed.unpersist()

    return _start(ticks.writeStream.outputMode("append").foreachBatch(write), checkpoint, interval)


def stream_alerts(ticks: DataFrame, thresholds: DataFrame, path: str, state_path: str, checkpoint: str,
                  interval: str | None = TRIGGER) -> StreamingQuery:
    """Breaches as they arrive, by the rule of the batch alerts: a move is the change against the symbol's
    previous tick. A late tick is held against the price limits only."""

    def publish(series: TickSeries, late: DataFrame, epoch: int) -> None:
        moved = indicator_frame(series, price_change_pct=momentum(1)).where("fresh")
        rows = moved.select("symbol", "event_ts", "seq", "price", "price_change_pct").unionByName(
            late.drop("late").withColumn("price_change_pct", F.lit(None).cast("double"))
        )
        evaluate(rows, thresholds).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return over_history(ticks, publish, 1, state_path, checkpoint, interval)


def moving_averages(ticks: DataFrame, out_path: str, state_path: str, checkpoint: str,
                    interval: str | None = TRIGGER) -> StreamingQuery:
    """SMA 5/10/20 and the change to the previous tick for every streamed tick; late ticks are published
    with ``late`` set and without averages."""

    def publish(series: TickSeries, late: DataFrame, epoch: int) -> None:
        rows = (
            indicator_frame(
                series,
                sma_5=sma(5), sma_10=sma(10), sma_20=sma(20),
                price_change=F.col("price") - lagged("price", 1), price_change_pct=momentum(1),
            )
            .where("fresh")
            .select("symbol", "event_ts", "seq", "price", "sma_5", "sma_10", "sma_20", "price_change",
                    "price_change_pct", F.lit(False).alias("late"))
        )
        rows.unionByName(late, allowMissingColumns=True).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")

    return over_history(ticks, publish, KEPT_TICKS, state_path, checkpoint, interval)


def stage_messages(lines: DataFrame, path: str) -> None:
    """Append tick lines as JSON messages to a source folder."""
    lines.select(F.to_json(F.struct(*[c for c in lines.columns if c != "dt"])).alias("value")).write.mode(
        "append"
    ).text(path)

