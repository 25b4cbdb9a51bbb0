"""Session construction and shared-folder handling."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Catalogue-sized tables are broadcast only below this many rows (checked with a count
# on the catalogue itself, never on listing-sized data).
BROADCAST_MAX_ROWS = 200_000
#: Largest table that a proven bound lets be broadcast (the driver builds it).
BROADCAST_MAX_BYTES = 64 << 20


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "carlot", checkpoint_dir: str | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """Local / test session with the settings the jobs are designed around. ``checkpoint_dir``
    and ``driver_memory`` are for tests and benches, where no launcher sets them.

    On a cluster the session comes from the launcher and only the SQL confs below
    matter: AQE (runtime coalescing, skew-join splitting, broadcast conversion by
    measured size) and Arrow for the two pandas-side steps.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    if checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session; lineage cuts must survive the loss of an executor, so a cluster
    must name it. Only a local master gets one of its own where none is set: a folder in the
    session's warehouse, never a temporary one of the machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/carlot-scratch")
        current = sc.getCheckpointDir()
    return current


def shared_scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediates."""
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _made().append(path)
    return path


_SCRATCH = threading.local()


def _made() -> list[str]:
    """Scratch folders of this thread that are still there."""
    if not hasattr(_SCRATCH, "paths"):
        _SCRATCH.paths = []
    return _SCRATCH.paths


def drop_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete written intermediates whose readers have been written themselves."""
    made, jvm = _made(), spark.sparkContext._jvm
    for path in list(paths):
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        if path in made:
            made.remove(path)


class Scratch:
    """The scratch folders that a step makes: ``with Scratch(spark) as s: ...; s.keep(path)``. Those that
    aren't kept are deleted when the step has ended well."""

    def __init__(self, spark: SparkSession):
        self.spark, self.kept = spark, set()

    def __enter__(self) -> Scratch:
        self.before = set(_made())
        return self

    def keep(self, *paths: str) -> None:
        self.kept.update(paths)

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            drop_scratch(self.spark, [p for p in _made() if p not in self.before and p not in self.kept])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a catalogue-side table only after proving its size.

    The count runs on a catalogue-sized table whose inputs are materialised once
    (``cut_lineage`` on the catalogue), so it is cheap. Above the bound the table is
    returned unhinted and AQE chooses the join from measured sizes.
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def bounded_broadcast(df: DataFrame, bound: int, row_bytes: int = 128) -> DataFrame:
    """Broadcast ``df`` when a proven upper bound on its rows, ``row_bytes`` each at most, is
    within the limits.

    Used for tables derived from a catalogue whose size was measured once (a derived
    table cannot have more rows than its bound, e.g. one row per catalogue slug)."""
    return F.broadcast(df) if bound * row_bytes <= BROADCAST_MAX_BYTES else df


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Give a CPU-heavy step (a Python UDF, HTML parsing) at least one partition per core.

    Small inputs — a single row group, or a vocabulary table that AQE coalesced into one
    partition — would otherwise run the heavy step in one task. Inputs that already have
    enough partitions (the normal case at cluster scale) are returned unchanged, without
    a shuffle."""
    n = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n, *cols) if cols else df.repartition(n)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``carlot`` importable by the Python workers (pandas UDF, ``mapInPandas``).

    The package is zipped once per application and distributed with ``addPyFile``, the
    programmatic form of ``--py-files``. The zip is written next to the driver process;
    Spark's file server distributes it to every executor, including ones started later."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import carlot
    pkg = os.path.dirname(os.path.abspath(carlot.__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="carlot-pyfiles-"), "carlot.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
