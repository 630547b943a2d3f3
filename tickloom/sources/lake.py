"""Partitioned tables: JSON lake, ORC warehouse tables, keyed upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.bars import combine_partials, merge_partials
from tickloom.schema import BAR_SCHEMA, SYMBOLS, TICK_FIELDS, TICK_SCHEMA
from tickloom.session import children
from tickloom.sources.merge_table import MergeTable

PARTITIONS = ("symbol", "dt")


def keep_present(df: DataFrame, columns) -> DataFrame:
    """The listed columns the frame has, in the listed order."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def clustered(df: DataFrame) -> DataFrame:
    """Bring rows of a table partition together before a partitioned write.

    Without it every task writes a file into every partition. The rebalance hint lets AQE split
    a partition that is far larger than the others and join small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in PARTITIONS])


def append_json(df: DataFrame, path: str, in_time_order: bool = False) -> None:
    """Append under symbol / dt. Rows that already come in time order (a tick series) need no
    clustering: each task holds a stretch of one or two symbols."""
    rows = df if in_time_order else clustered(df)
    rows.write.mode("append").partitionBy(*PARTITIONS).json(path)


def raw_columns() -> T.StructType:
    return T.StructType([*TICK_SCHEMA.fields, T.StructField("seq", T.LongType()), T.StructField("dt", T.DateType())])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw tick lake with partition discovery; dt and symbol predicates prune folders."""
    return spark.read.schema(raw_columns()).option("basePath", path).json(path)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Partial-bar lake; unreadable lines are dropped."""
    return spark.read.schema(BAR_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def compact_bars(partials: DataFrame, table_path: str, before: str, since: str | None = None) -> None:
    """Merge the partial bars of the days before the given day (and from ``since`` on) into the ORC bar table.

    Days are replaced as a whole, so running it again gives the same table.
    """
    finished = partials.where(F.col("dt") < F.lit(before).cast("date"))
    if since is not None:
        finished = finished.where(F.col("dt") >= F.lit(since).cast("date"))
    overwrite_orc(merge_partials(finished), table_path)


def register_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    """External catalog table over the raw lake, partitions recovered, plus a view per symbol."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in raw_columns())}) "
        f"USING json PARTITIONED BY (symbol, dt) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")
    for symbol in SYMBOLS:
        spark.table(table).where(F.col("symbol") == symbol).createOrReplaceTempView(f"{symbol.lower()}_tick")
    return spark.table(table)


def register_layers(layers: dict[str, DataFrame]) -> None:
    """Every layer as a temp view, so ad-hoc spark.sql works on all of them."""
    for name, df in layers.items():
        df.createOrReplaceTempView(name)


def overwrite_orc(df: DataFrame, path: str, in_time_order: bool = False) -> None:
    """ORC + Snappy by (symbol, dt); only the partitions present in df are replaced."""
    rows = df if in_time_order else clustered(df)
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy(*PARTITIONS).orc(path)
    )


def replace_orc(df: DataFrame, path: str) -> None:
    """An unpartitioned ORC + Snappy table, replaced as a whole (snapshots of one row per symbol)."""
    df.write.mode("overwrite").option("compression", "snappy").orc(path)


def read_orc(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.orc(path)


def latest_by_key(rows: DataFrame, keys, order) -> DataFrame:
    """One row per key, the one with the largest order.

    An aggregate, not a window: rows of a hot key are reduced before the shuffle.
    """
    payload = F.struct(*[F.col(c) for c in rows.columns])
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(payload, F.struct(*[F.col(c) for c in order])).alias("_row"))
        .select("_row.*")
    )


class KeyedTable(MergeTable):
    """A table with one row per key: the row with the largest order wins, rows whose order is null lose to any other.

    ``bucket`` groups the keys; one that follows time lets a compaction touch the newest buckets only.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys, order, bucket: Column | None = None):
        bucket = F.pmod(F.xxhash64(*keys), F.lit(16)) if bucket is None else bucket
        super().__init__(spark, path, schema, bucket, lambda rows: latest_by_key(rows, keys, order))


def raw_table(spark: SparkSession, path: str) -> MergeTable:
    """The streamed raw ticks, JSON lines in a bucket per symbol and day."""
    return MergeTable(spark, path, raw_columns(), F.concat_ws("-", "symbol", "dt"), lambda rows: rows, "json")


def bar_table(spark: SparkSession, path: str) -> MergeTable:
    """The streamed partial bars, JSON lines in a bucket per symbol and day, one row per bar once compacted."""
    return MergeTable(spark, path, BAR_SCHEMA, F.concat_ws("-", "symbol", "dt"), combine_partials, "json")


def rejected_table(spark: SparkSession, path: str) -> MergeTable:
    """The streamed messages that are not usable, in a bucket per reason."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("value", "reason")])
    return MergeTable(spark, path, schema, F.col("reason"), lambda rows: rows, "json")


FLOW_COUNTS = ("messages", "ticks", "rejected")


def flow_table(spark: SparkSession, path: str) -> MergeTable:
    """Messages read, ticks stored and messages rejected of each symbol (null: not a tick), summed over all epochs."""
    schema = T.StructType([T.StructField("symbol", T.StringType()), *[T.StructField(c, T.LongType()) for c in FLOW_COUNTS]])
    return MergeTable(
        spark, path, schema, F.lit("all"), lambda rows: rows.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in FLOW_COUNTS])
    )


def file_inventory(spark: SparkSession, folders: list[str]) -> DataFrame:
    """path, length of the data files under some folders. Only names and sizes are read, by Spark's own listing."""
    if not folders:
        return spark.createDataFrame([], "path string, length long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    return files.select("path", "length")


def files_by_symbol(files: DataFrame) -> DataFrame:
    """symbol, lake_files, lake_bytes by the symbol in the folder names (``symbol=GOLD`` or ``_bucket=GOLD-...``)."""
    named = F.regexp_extract("path", "(?:symbol=|_bucket=)([A-Za-z]+)", 1).alias("symbol")
    return files.select(named, "length").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("lake_files"), F.sum("length").alias("lake_bytes")
    )


def newest_days(spark: SparkSession, path: str, symbol: str, bars: int) -> list[str]:
    """Day folders of a bar lake that hold the last ``bars`` bars of a symbol, walked backwards from the newest day.

    The walk looks at one day, then two, four and so on, and stops once it has seen enough bars.
    """
    root = f"{path}/symbol={symbol}"
    days = sorted((n for n in children(spark, root) if n.startswith("dt=")), reverse=True)
    taken, step, seen = 0, 1, 0
    while taken < len(days) and seen < bars:
        part = [f"{root}/{day}" for day in days[taken : taken + step]]
        lines = spark.read.schema("minute timestamp").option("mode", "DROPMALFORMED").json(part)
        seen += lines.select("minute").distinct().count()
        taken += len(part)
        step *= 2
    return [f"{root}/{day}" for day in days[:taken]]


def newest_bars(spark: SparkSession, path: str, symbol: str, bars: int) -> DataFrame:
    """Partial bars of the newest days of a symbol, enough for its last ``bars`` bars; no other folder is listed."""
    folders = newest_days(spark, path, symbol, bars)
    if not folders:
        return spark.createDataFrame([], BAR_SCHEMA)
    return spark.read.schema(BAR_SCHEMA).option("mode", "DROPMALFORMED").option("basePath", path).json(folders)


def tick_lines(series_rows: DataFrame) -> DataFrame:
    """Tick rows in message shape: timestamp and event_time text, plus seq."""
    text = F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")
    return series_rows.select(
        *[text.alias(c) if c in ("timestamp", "event_time") else F.col(c) for c in TICK_FIELDS],
        "seq", F.to_date("event_ts").alias("dt"),
    )
