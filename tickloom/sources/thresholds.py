"""Stored alert thresholds: changes and deletions that later runs see."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.alerts import with_defaults
from tickloom.sources.lake import latest_by_key
from tickloom.sources.merge_table import MergeTable

_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in ("upper", "lower", "vol_pct")],
    T.StructField("deleted", T.BooleanType()), T.StructField("change", T.LongType()), T.StructField("place", T.LongType()),
])


class ThresholdStore:
    """The newest change of each symbol; a deletion is a change like others and brings the default back.

    Changes are numbered as they are stored, and within one store call the later row of a symbol wins. Every call is
    committed before it returns. One caller changes the store at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        newest = lambda rows: latest_by_key(rows, ["symbol"], ["change", "place"])
        self.table = MergeTable(spark, path, _SCHEMA, F.lit("all"), newest)

    def _add(self, rows: DataFrame) -> None:
        number = (self.table.rows().agg(F.max("change")).first()[0] or 0) + 1
        self.table.write(rows.withColumns({"change": F.lit(number).cast("long"), "place": F.monotonically_increasing_id()}), number)
        self.table.compact()

    def put(self, changes: DataFrame) -> None:
        """Store new limits (symbol, upper, lower, vol_pct); a symbol that comes twice takes the later row."""
        self._add(changes.select("symbol", "upper", "lower", "vol_pct", F.lit(False).alias("deleted")))

    def delete(self, symbols: list[str]) -> None:
        """Forget the limits of some symbols."""
        rows = self.spark.createDataFrame([(s,) for s in symbols], "symbol string")
        none = [F.lit(None).cast("double").alias(c) for c in ("upper", "lower", "vol_pct")]
        self._add(rows.select("symbol", *none, F.lit(True).alias("deleted")))

    def current(self, defaults: DataFrame) -> DataFrame:
        """symbol, upper, lower, vol_pct: what is stored, and the defaults of all other symbols."""
        kept = self.table.read().where("NOT deleted").select("symbol", "upper", "lower", "vol_pct")
        return with_defaults(kept, defaults)
