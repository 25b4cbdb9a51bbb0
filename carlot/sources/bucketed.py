"""A store partitioned by a hash of its key, so that a small batch rewrites only the partitions it
touches (B3, B5 in part).

A versioned store (``sinks.write_version``) is joined and written whole by every batch. Here the
batch names the buckets of its keys; only these are read (partition pruning), merged and replaced
(dynamic partition overwrite), the others keep their files. A batch that is run again gives the
same buckets. Readers see each bucket before or after a batch, not the whole store of one moment:
where that matters, versions are the other choice. Rows with a NULL key have a bucket like others
and are appended by every run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carlot.operators.store import patch_rows, upsert_rows
from carlot.sources.sinks import counted

BUCKET = "bucket"


@dataclass(frozen=True)
class BucketedStore:
    path: str
    key: str
    buckets: int

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, mode: str) -> None:
        # a bucket's rows come together, and a large bucket is cut by its measured size
        (self._dealt(rows).hint("rebalance", BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.path))

    def create(self, rows: DataFrame) -> None:
        self._write(rows, "errorifexists")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(BUCKET)

    def touched(self, batch: DataFrame) -> list[int]:
        """Buckets of a batch's keys: at most ``buckets`` numbers."""
        return sorted(r[BUCKET] for r in self._dealt(batch.select(self.key)).select(BUCKET).distinct().collect())

    def part(self, spark: SparkSession, buckets: Sequence[int]) -> DataFrame:
        return spark.read.parquet(self.path).where(F.col(BUCKET).isin(list(buckets))).drop(BUCKET)

    def _replace(self, rows: DataFrame) -> dict[str, int]:
        observed = Observation()
        self._write(counted(rows, observed), "overwrite")
        return observed.get

    def upsert(self, batch: DataFrame, batch_order: Sequence[str]) -> dict[str, int]:
        """B3 — merge a batch; the counters of the run, of which ``kept`` counts the touched buckets alone."""
        spark = batch.sparkSession
        old = self.part(spark, self.touched(batch))
        new = upsert_rows(old, batch, self.key, batch_order=batch_order)
        return self._replace(new.select(*old.columns, "_status", "_sent"))

    def patch(self, updates: DataFrame, columns: Sequence[str]) -> dict[str, int]:
        """B5 — keyed partial update."""
        return self._replace(patch_rows(self.part(updates.sparkSession, self.touched(updates)), updates, self.key, columns))
