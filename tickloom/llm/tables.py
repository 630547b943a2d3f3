"""Reading the corpus tables and small shared steps of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE_WORDS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 2048
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """Hand texts to Python in batches of BATCH_ROWS, unless the session sets another size: texts are long, and
    a batch is held by the JVM and by the worker."""
    spark = df.sparkSession
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    return df


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, cast to the given types; other columns cannot clash."""
    small_batches(df)
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def unit_hash(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the values only."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11)).cast("double") / F.lit(float(1 << 53))


def labelled_sample(labels: DataFrame, target: str, bound: int) -> DataFrame:
    """doc_id, label of at most ``bound`` labelled documents, chosen by a hash of the id.

    Rows without an id or a label are left out; a document labelled twice takes the larger label.
    """
    known = (
        only(labels, doc_id="long", **{target: "int"}).dropna()
        .groupBy("doc_id").agg(F.max(target).alias("label"))
    )
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sample (unique doc_id, a bounded number of rows) with one text per id.

    Of the texts of a repeated id the one with the smallest hash is taken, whatever the order of rows; a null text
    counts like any other. Copies are merged in the task that reads them, so a hot id sends one text a task.
    """
    found = only(docs, doc_id="long", text="string").join(F.broadcast(sample), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text"))).alias("least")
    return found.groupBy(*sample.columns).agg(least).select(*sample.columns, F.col("least.text").alias("text"))
