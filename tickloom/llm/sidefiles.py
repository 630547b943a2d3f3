"""Per-row facts handed back to the scan of a table without moving the table.

A scan numbers its rows by (partition, place). A narrow table with those numbers is written in one folder
per partition; a later scan of the same table reads only its own folder, so long texts are never shuffled.
Both scans must be split alike: the least number of splits is pinned, as it otherwise follows the executors
that happen to be alive, and every fact carries its document's id, so a scan that differs is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tickloom.session import new_folder

_SPLITS = "spark.sql.files.minPartitionNum"


def pin_splits(spark: SparkSession) -> None:
    """Keep the splits of scans as they are now, also if executors come or go."""
    if spark.conf.get(_SPLITS, None) is None:
        spark.conf.set(_SPLITS, str(spark.sparkContext.defaultParallelism))


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    """Batches with the number of their partition and of their first row."""
    part, row = TaskContext.get().partitionId(), 0
    for batch in batches:
        yield batch, part, row
        row += batch.num_rows


def write_side(facts: DataFrame, label: str) -> str:
    """Write facts (part, row, ...) sorted by row, a folder per partition; gives the path."""
    folder = new_folder(facts.sparkSession, label)
    facts.repartition("part").sortWithinPartitions("part", "row").write.partitionBy("part").parquet(folder)
    return folder


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named by Spark."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def same_rows(facts: pa.Table, first: int, doc_ids: pa.Array) -> None:
    """Hold the doc_id of the facts against the rows they are handed to, the first of which has number ``first``."""
    here = doc_ids.take(pa.array(facts.column("row").to_numpy() - first)).cast(pa.int64())
    known = facts.column("doc_id").combine_chunks()
    if here.null_count != known.null_count or not here.equals(known):
        raise RuntimeError("the table was split differently from the scan that made the facts")


class SideReader:
    """The facts of the current partition, as one table sorted by row; ``of`` gives those of some rows."""

    def __init__(self, folder: str, part: int):
        system, path = file_system(f"{folder}/part={part}")
        tables = []
        for item in system.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
            if item.is_file and item.base_name.endswith(".parquet"):
                with system.open_input_file(item.path) as file:
                    tables.append(pq.ParquetFile(file).read())
        self.table = pa.concat_tables(tables).sort_by("row").combine_chunks() if tables else None
        self.rows = self.table.column("row").to_numpy() if tables else None

    def of(self, first: int, n: int) -> pa.Table | None:
        """The facts of rows first to first + n."""
        if self.table is None:
            return None
        low, high = self.rows.searchsorted(first), self.rows.searchsorted(first + n)
        return self.table.slice(low, high - low) if high > low else None
