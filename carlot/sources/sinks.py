"""Sinks (B1, B2, B7) and versioned table writes.

Without a transactional table format a mutation is published by writing a new
version next to the old one and switching readers to it; files under an unfinished
version are never read. All paths live under the shared folder of the cluster
(``spark.checkpoint.dir``), never a machine-local temporary folder.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carlot.session import shared_scratch_dir

#: What becomes of a row in a write (``store.upsert_rows``, ``store.patch_rows``).
STATUSES = ("inserted", "updated", "unchanged", "kept")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B1 — JSON lines, UTF-8, non-ASCII kept as is."""
    df.write.mode(mode).json(path)


#: Quotes are doubled, white space stays, values with line breaks are quoted. NULL is an
#: empty field, an empty text a quoted one.
CSV_OPTIONS = {"sep": ";", "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False, "nullValue": None, "emptyValue": '""'}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B2 — ``;``-separated, header row, column order of the DataFrame."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema, line_breaks: bool = True) -> DataFrame:
    """Read back what ``write_csv`` wrote. Where values may hold line breaks a file is one split; without
    them (``line_breaks=False``) it is cut anywhere."""
    return spark.read.schema(schema).options(**CSV_OPTIONS | {"multiLine": line_breaks, "emptyValue": ""}).csv(path)


def holds_line_breaks(df: DataFrame) -> bool:
    """Whether a text column of the table has a line break in a value; stops at the first."""
    texts = [F.col(f"`{c}`").rlike(r"[\r\n]") for c, kind in df.dtypes if kind == "string"]
    found = F.lit(False)
    for t in texts:
        found = found | F.coalesce(t, F.lit(False))
    return bool(texts) and not df.where(found).isEmpty()


def write_version(df: DataFrame, base: str, partition_by: list[str] | None = None) -> str:
    """B7 / B3 target — write a new immutable version ``base/v=<millis>`` as parquet."""
    path = new_version(base)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete table stands at ``path``, on any file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def write_counted(df: DataFrame, path: str) -> dict[str, int]:
    """F6 — write rows with ``_status`` and ``_sent`` to ``path`` (without these two) and return the
    counters of the run. They are observed by the writing job's last stage itself, so there is no
    second pass, and tasks that are run again count once."""
    observed = Observation()
    counted(df, observed).write.parquet(path)
    return observed.get


def counted(df: DataFrame, observed: Observation) -> DataFrame:
    """Rows without ``_status`` and ``_sent``, which the observation counts."""
    counts = [F.count_if(F.col("_status") == s).alias(s) for s in STATUSES]
    return df.observe(observed, F.coalesce(F.sum("_sent"), F.lit(0)).alias("sent"), *counts).drop("_status", "_sent")


def write_rejects(rejects: DataFrame, path: str) -> int:
    """Quarantine: rejected rows with their reason; how many, observed by the job that writes them."""
    observed = Observation()
    rejects.observe(observed, F.count("*").alias("n")).write.parquet(path)
    return observed.get["n"]


def new_version(base: str) -> str:
    """Path of the version that comes next."""
    return os.path.join(base, f"v={time.time_ns() // 1_000_000}")


def latest_version(spark: SparkSession, base: str) -> DataFrame:
    """Read the newest complete version under ``base`` (one with a ``_SUCCESS`` marker)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        raise FileNotFoundError(f"no table under {base}")
    versions = sorted(
        (s.getPath().getName() for s in fs.listStatus(p)
         if s.isDirectory() and s.getPath().getName().startswith("v=")
         and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))),
        key=lambda n: int(n[2:]))
    if not versions:
        raise FileNotFoundError(f"no complete version under {base}")
    return spark.read.parquet(os.path.join(base, versions[-1]))


def csv_roundtrip(df: DataFrame) -> DataFrame:
    path = shared_scratch_dir(df.sparkSession, "csv")
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema, line_breaks=holds_line_breaks(df))


def json_roundtrip(df: DataFrame) -> DataFrame:
    path = shared_scratch_dir(df.sparkSession, "json")
    write_json(df, path)
    return df.sparkSession.read.schema(df.schema).json(path)
