"""Tick CSV files: header, optional byte-order mark, one file or folder per symbol."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.temporal import parse_time
from tickloom.operators.series import TickSeries, build_series
from tickloom.schema import CSV_FIELDS, CSV_SCHEMA, SYMBOLS, TICK_FIELDS, TICK_SCHEMA


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def _shape(rows: DataFrame, symbol, *extra) -> DataFrame:
    text = {c: F.trim(c).alias(c) for c in ("timestamp", "direction")}
    return rows.select(
        symbol.alias("symbol"),
        *[text.get(c, F.col(c)) for c in CSV_FIELDS],
        F.trim("timestamp").alias("event_time"),
        *extra,
    )


def _file_place():
    """Order of a row within its file, without a sort: start of its split plus place in the task.

    A full-size split is always the first of its task, and a row takes at least one byte, so the
    numbers of one file rise in file order and never repeat.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (F.col("_metadata.file_block_start") + place).alias("seq")


def read_ticks(spark: SparkSession, paths: dict[str, str], with_order: bool = False) -> DataFrame:
    """Ticks of the given symbol -> path map, all stacked. A missing path gives no rows; an
    unreadable number fails the load. ``with_order`` adds event_ts and seq (file order), which
    build_series needs; it expects one file per symbol."""
    unknown = set(paths) - set(SYMBOLS)
    if unknown:
        raise ValueError(f"unknown symbols: {sorted(unknown)}")
    present = {s: p for s, p in paths.items() if _exists(spark, p)}
    if not present:
        empty = spark.createDataFrame([], TICK_SCHEMA).select(*TICK_FIELDS)
        return empty.selectExpr("*", "0L AS seq", "CAST(NULL AS TIMESTAMP) AS event_ts") if with_order else empty
    reader = (
        spark.read.schema(CSV_SCHEMA)
        .option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
    )
    extra = [_file_place()] if with_order else []
    rows = reduce(
        DataFrame.unionByName, [_shape(reader.csv(p), F.lit(s), *extra) for s, p in present.items()]
    )
    return rows.withColumn("event_ts", parse_time("event_time")) if with_order else rows


def read_series(spark: SparkSession, paths: dict[str, str]) -> TickSeries:
    """The ordered tick series of a set of CSV files; equal timestamps keep their file order."""
    return build_series(read_ticks(spark, paths, with_order=True).drop("timestamp", "event_time"))


def read_checked(spark: SparkSession, root: str) -> DataFrame:
    """Folder layout root/symbol=X/*.csv; rows that do not parse keep their text in ``_corrupt``."""
    schema = T.StructType([*CSV_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    rows = (
        spark.read.schema(schema)
        .option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .csv(root)
    )
    return _shape(rows, F.col("symbol"), "_corrupt")


def write_ticks(ticks: DataFrame, root: str) -> dict[str, str]:
    """Write root/symbol=X/*.csv with a header; returns the symbol -> path map for read_ticks."""
    columns = [F.col(c) for c in CSV_FIELDS]
    ticks.select("symbol", *columns).write.partitionBy("symbol").option("header", True).csv(root)
    return {s: f"{root}/symbol={s}" for s in SYMBOLS}

