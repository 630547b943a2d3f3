"""A table that micro-batches of several writers add to, and that compaction keeps small.

Every batch is a delta, named by its writer and epoch, so running a batch again replaces its own delta and two writers
never meet. Rows lie in buckets, a function of the row's key. A compaction merges the finished deltas into the base of
those buckets they touch and leaves the others alone. It becomes visible with one small manifest, which says for each
bucket where its base lies and for each writer up to which epoch deltas are in it; a manifest is only ever added after
the one it was made from, so of two compactions at once one gives up. What a manifest replaces is removed by the next
compaction, so a reader that has listed the table can go on reading meanwhile.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import add_file, children, file_names, read_file, remove

BUCKET = "_bucket"
KEPT_MANIFESTS = 3


@dataclass
class Manifest:
    """base: folder of each bucket; upto: last merged epoch of each writer; retired: folders that nothing names."""

    version: int = 0
    base: dict[str, str] = field(default_factory=dict)
    upto: dict[str, int] = field(default_factory=dict)
    retired: list[str] = field(default_factory=list)


class MergeTable:
    """``bucket`` must depend on the key of a row only; ``merge`` maps rows to the rows that stand for them, whatever
    way they are split over deltas."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, bucket: Column,
                 merge: Callable[[DataFrame], DataFrame], fmt: str = "parquet"):
        self.spark, self.path, self.schema, self.merge, self.fmt = spark, path.rstrip("/"), schema, merge, fmt
        text = F.coalesce(bucket.cast("string"), F.lit("none"))
        self.bucket = F.regexp_replace(text, "[^A-Za-z0-9_-]", "_")

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows = rows.select(*self.schema.fieldNames()).withColumn(BUCKET, self.bucket).hint("rebalance", F.col(BUCKET))
        rows.write.mode("overwrite").partitionBy(BUCKET).format(self.fmt).save(f"{self.path}/{folder}")

    def write(self, rows: DataFrame, epoch: int, writer: str = "main") -> None:
        """Add the rows of one batch; the same epoch of the same writer again replaces them."""
        self._write(self.merge(rows.select(*self.schema.fieldNames())), f"delta/{writer}.{epoch}")

    def _manifest(self) -> Manifest:
        names = sorted(n for n in file_names(self.spark, f"{self.path}/manifest") if n.isdigit())
        return Manifest(**json.loads(read_file(self.spark, f"{self.path}/manifest/{names[-1]}"))) if names else Manifest()

    def _fresh(self, manifest: Manifest) -> list[tuple[str, int]]:
        """(writer, epoch) of the committed deltas that are not in the base."""
        split = (name.rpartition(".") for name in children(self.spark, f"{self.path}/delta", committed=True))
        named = [(writer, int(epoch)) for writer, _, epoch in split]
        return [(w, e) for w, e in named if e > manifest.upto.get(w, -1)]

    def _buckets(self, folder: str) -> dict[str, str]:
        found = children(self.spark, f"{self.path}/{folder}")
        return {n.partition("=")[2]: f"{folder}/{n}" for n in found if n.startswith(f"{BUCKET}=")}

    def _load(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).format(self.fmt).load([f"{self.path}/{f}" for f in folders])

    def folders(self, wanted: Callable[[str], bool] | None = None) -> list[str]:
        """The folders that hold the table now, of the ``wanted`` buckets."""
        manifest = self._manifest()
        parts = list(manifest.base.items())
        for writer, epoch in self._fresh(manifest):
            parts += self._buckets(f"delta/{writer}.{epoch}").items()
        return [folder for bucket, folder in parts if wanted is None or wanted(bucket)]

    def rows(self, wanted: Callable[[str], bool] | None = None) -> DataFrame:
        """All rows as they lie there, before the merge."""
        return self._load(self.folders(wanted))

    def read(self, wanted: Callable[[str], bool] | None = None) -> DataFrame:
        return self.merge(self.rows(wanted))

    def compact(self, finished: bool = False) -> bool:
        """Merge deltas into the buckets they touch. The newest delta of a writer may be written again and stays,
        unless all writers have ``finished``. False if there was nothing to do or another compaction came first."""
        before = self._manifest()
        fresh = self._fresh(before)
        newest = {w: max(e for v, e in fresh if v == w) for w, _ in fresh}
        merged = [(w, e) for w, e in fresh if finished or e < newest[w]]
        if not merged:
            return False
        touched: dict[str, list[str]] = {}
        for writer, epoch in merged:
            for bucket, folder in self._buckets(f"delta/{writer}.{epoch}").items():
                touched.setdefault(bucket, []).append(folder)
        made = f"base/{uuid.uuid4().hex}"
        replaced = [before.base[b] for b in touched if b in before.base]
        if touched:
            self._write(self.merge(self._load([f for fs in touched.values() for f in fs] + replaced)), made)
        upto = {**before.upto, **{w: max(e for v, e in merged if v == w) for w, _ in merged}}
        retired = replaced + [f"delta/{w}.{e}" for w, e in merged]
        after = Manifest(before.version + 1, {**before.base, **self._buckets(made)}, upto, retired)
        if not add_file(self.spark, f"{self.path}/manifest/{after.version:012d}", json.dumps(vars(after))):
            remove(self.spark, f"{self.path}/{made}")
            return False
        named = {f.rpartition("/")[0] for f in [*after.base.values(), *after.retired]}
        for folder in before.retired:
            made_by = folder.rpartition("/")[0]
            gone = folder if made_by == "delta" or made_by in named else made_by  # with its last bucket a base goes
            remove(self.spark, f"{self.path}/{gone}")
        for name in sorted(file_names(self.spark, f"{self.path}/manifest"))[:-KEPT_MANIFESTS]:
            remove(self.spark, f"{self.path}/manifest/{name}")
        return True

    def sweep(self) -> None:
        """Remove what stopped compactions left: bases that the manifest does not name. Not while one is running."""
        manifest = self._manifest()
        named = {folder.split("/")[1] for folder in [*manifest.base.values(), *manifest.retired]}
        for name in children(self.spark, f"{self.path}/base"):
            if name not in named:
                remove(self.spark, f"{self.path}/base/{name}")
