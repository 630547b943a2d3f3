"""Session helpers: recommended settings and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the jobs rely on (UTC clock, AQE)."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor.

    Taken from ``spark.checkpoint.dir``. Only a local-mode session may fall back to a
    machine-local folder; on a cluster an unset value is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tickloom-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/tickloom/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a summary table once and read it back.

    The read has an exact file size, so Spark's own broadcast threshold decides how later
    joins use it, and lost executors never cause the summary to be computed again.
    """
    return stored_at(df, label)[0]


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, for tables that are removed when their reader is done."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    system, where = _hadoop(spark, path)
    system.delete(where, True)


def children(spark: SparkSession, path: str, committed: bool = False) -> list[str]:
    """Names of the folders in a folder; ``committed``: only those that a finished job has written."""
    system, where = _hadoop(spark, path)
    if not system.exists(where):
        return []
    found = [s.getPath() for s in system.listStatus(where) if s.isDirectory()]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(p.getName() for p in found if not committed or system.exists(done(p, "_SUCCESS")))


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder."""
    system, where = _hadoop(spark, path)
    if not system.exists(where):
        return []
    return [s.getPath().getName() for s in system.listStatus(where) if s.isFile()]


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file."""
    system, where = _hadoop(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def add_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that appears as a whole; False if there is one of that name already."""
    system, where = _hadoop(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, where, no_overwrite)
    except Py4JJavaError as problem:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in str(problem.java_exception.toString()):
            return False
        raise
    return True
