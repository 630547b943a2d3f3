"""Tick messages: key SYMBOL_timestamp, JSON value; broker source and sink options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.temporal import parse_time
from tickloom.schema import NUMBER_FIELDS, SYMBOLS, TICK_FIELDS, TICK_TEXT_SCHEMA

# Topics, one per symbol, and the broker options of producer and consumer.
TOPICS = ("copper_tick", "gas_tick", "gold_tick", "oil_tick", "silver_tick")
SOURCE_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}
SINK_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "gzip", "kafka.linger.ms": "5"}


def message_key() -> Column:
    return F.concat_ws("_", "symbol", "timestamp")


def encode(ticks: DataFrame) -> DataFrame:
    """key, value: one JSON object per tick."""
    return ticks.select(
        message_key().alias("key"), F.to_json(F.struct(*TICK_FIELDS)).alias("value")
    )


def decode(messages: DataFrame, value: str = "value", *keep: str, also: dict[str, str] | None = None) -> DataFrame:
    """The 12 fields plus event_ts and dt; ``also`` names further fields of the message with their types.

    Fields are read as text and then cast, so numbers sent as text count as numbers; a value that
    is not JSON gives a row of nulls.
    """
    also = also or {}
    layout = T.StructType([*TICK_TEXT_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in also]])
    fields = F.from_json(F.col(value).cast("string"), layout)
    parsed = messages.select(*keep, fields.alias("m")).select(*keep, "m.*")
    return parsed.withColumns(
        {c: F.col(c).try_cast("double") for c in NUMBER_FIELDS}
        | {c: F.col(c).try_cast(kind) for c, kind in also.items()}
        | {"event_ts": parse_time("event_time")}
    ).withColumn("dt", F.to_date("event_ts"))


def reject_reason() -> Column:
    """Why a decoded message is not a usable tick; null for a good one."""
    return (
        F.when(F.col("symbol").isNull(), "not a tick")
        .when(~F.col("symbol").isin(*SYMBOLS), "unknown symbol")
        .when(F.col("event_ts").isNull(), "bad time")
        .when(F.col("price").isNull(), "bad price")
    )


def quarantine(messages: DataFrame, *keep: str) -> DataFrame:
    """Messages the per-symbol outputs would drop in silence, with the reason.

    Exploding an empty-or-one array keeps the rejected rows like a filter would, but cannot be
    pushed below the JSON parse, where it would parse each message once per condition.
    """
    reasons = F.array_compact(F.array(reject_reason()))
    return decode(messages, "value", *keep, "value").select(
        *keep, "value", F.explode(reasons).alias("reason")
    )


def broker_stream(spark: SparkSession, servers: str, per_trigger: int, **options: str) -> DataFrame:
    """Streaming source over the five topics (needs the Kafka connector on the class path).

    ``per_trigger`` bounds the messages of a micro-batch; what is beyond it waits for the next.
    """
    merged = {**SOURCE_OPTIONS, "maxOffsetsPerTrigger": str(per_trigger), **options, "kafka.bootstrap.servers": servers, "subscribe": ",".join(TOPICS)}
    return spark.readStream.format("kafka").options(**merged).load()


def to_broker(ticks: DataFrame, servers: str, **options: str) -> None:
    """Batch sink: each tick goes to the topic of its symbol."""
    messages = ticks.select(
        F.concat(F.lower("symbol"), F.lit("_tick")).alias("topic"),
        message_key().alias("key"),
        F.to_json(F.struct(*TICK_FIELDS)).alias("value"),
    )
    merged = {**SINK_OPTIONS, **options, "kafka.bootstrap.servers": servers}
    messages.write.format("kafka").options(**merged).save()
