"""Record layouts and the two small reference tables (symbols, alert thresholds)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names, symbols, display data and default thresholds that
# results must agree on.
# ---------------------------------------------------------------------------
NUMBER_FIELDS = ("price", "volume", "bid", "ask", "spread", "volatility", "high", "low")
CSV_FIELDS = (
    "timestamp", "price", "volume", "bid", "ask", "spread", "direction", "volatility", "high", "low",
)
TICK_FIELDS = ("symbol", *CSV_FIELDS, "event_time")
DIRECTIONS = ("UP", "DOWN", "FLAT")

SYMBOLS = ("GOLD", "OIL", "SILVER", "COPPER", "GAS")
# symbol, name, unit, color, base price
SYMBOL_ROWS = (
    ("GOLD", "黄金期货", "$/oz", "#FFD700", 4111.5),
    ("OIL", "原油期货", "$/bbl", "#FF6B35", 72.5),
    ("SILVER", "白银期货", "$/oz", "#C0C0C0", 58.4),
    ("COPPER", "铜期货", "$/lb", "#FF8C42", 4.25),
    ("GAS", "天然气期货", "$/mmBTU", "#4FC3F7", 3.20),
)
# symbol, upper, lower, vol_pct
DEFAULT_THRESHOLDS = (
    ("GOLD", 4200.0, 4000.0, 0.5),
    ("OIL", 80.0, 60.0, 1.0),
    ("SILVER", 65.0, 50.0, 1.0),
    ("COPPER", 5.0, 3.5, 1.0),
    ("GAS", 4.0, 2.5, 2.0),
)
# ---------------------------------------------------------------------------

_DOUBLE_FIELDS = set(NUMBER_FIELDS)


def _struct(names) -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.DoubleType() if n in _DOUBLE_FIELDS else T.StringType()) for n in names]
    )


TICK_SCHEMA = _struct(TICK_FIELDS)
CSV_SCHEMA = _struct(CSV_FIELDS)
# every field as text: lets a decoder coerce "12.5" and 12.5 alike
TICK_TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in TICK_FIELDS])

BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("minute", T.TimestampType()),
        T.StructField("open_price", T.DoubleType()),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("tick_count", T.LongType()),
        T.StructField("first_ts", T.TimestampType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("first_seq", T.LongType()),
        T.StructField("last_seq", T.LongType()),
        T.StructField("dt", T.DateType()),
    ]
)


def _literal_rows(spark: SparkSession, rows, columns: str) -> DataFrame:
    """An inline VALUES relation: its exact size is in the plan, so joins need no hint."""
    quoted = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}D" for v in row) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t({columns})")


def symbol_dim(spark: SparkSession) -> DataFrame:
    """symbol, name, unit, color, base, symbol_rank (the listing order)."""
    rows = [(*row, float(i)) for i, row in enumerate(SYMBOL_ROWS)]
    dim = _literal_rows(spark, rows, "symbol, name, unit, color, base, symbol_rank")
    return dim.withColumn("symbol_rank", dim["symbol_rank"].cast("int"))


def default_thresholds(spark: SparkSession) -> DataFrame:
    """symbol, upper, lower, vol_pct."""
    return _literal_rows(spark, DEFAULT_THRESHOLDS, "symbol, upper, lower, vol_pct")


def uniform_thresholds(spark: SparkSession, upper: float, lower: float, vol_pct: float) -> DataFrame:
    """The same limits for every symbol."""
    rows = [(s, float(upper), float(lower), float(vol_pct)) for s in SYMBOLS]
    return _literal_rows(spark, rows, "symbol, upper, lower, vol_pct")
