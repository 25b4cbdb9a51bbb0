"""Helpers that the operators share: text columns, Arrow maps, written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.session import drop_scratch, ship_package, shared_scratch_dir

#: Texts handed to Python code at once, inside one Arrow batch.
TEXTS_AT_ONCE = 256

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "binary": pa.binary(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()),
         "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a NULL text becomes an empty one."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def record_batch(columns: Sequence, fields: Sequence[tuple[str, str]]) -> pa.RecordBatch:
    """A batch from lists, numpy arrays or Arrow arrays, with the types of ``fields``."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=ARROW[kind])
              for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def ddl(fields: Sequence[tuple[str, str]]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              fields: Sequence[tuple[str, str]]) -> DataFrame:
    """``mapInArrow`` with the package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, ddl(fields))


def map_texts(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[list]]],
              fields: Sequence[tuple[str, str]]) -> DataFrame:
    """``doc_id`` plus the columns ``fields`` that a Python function gives for each text.

    ``make`` runs once a task and returns that function (a list of texts to a list of
    columns). One output row per input row; no shuffle."""
    texts = id_and_text(docs)
    id_kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(name for name, _ in fields)]
    kinds = [kind for _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                fn = fn or make()
                columns = fn(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, type=ARROW[k]) for c, k in zip(columns, kinds, strict=True))],
                    names=names)

    return arrow_map(texts, run, [("doc_id", id_kind), *fields])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lineage cut that outlives executors. The
    result's ``scratch_path`` names the folder, for ``dropped`` and ``Scratch.keep``."""
    path = shared_scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete ``written`` tables that nothing reads any more."""
    drop_scratch(tables[0].sparkSession, [t.scratch_path for t in tables])


def id_ranges(docs: DataFrame, ranges: int) -> Column:
    """Number of the id range of ``doc_id``: a binary search in quantiles (a power of two of them)."""
    fractions = [i / ranges for i in range(1, ranges)]
    edges = docs.agg(F.percentile_approx("doc_id", fractions, 10 * ranges).alias("q")).first()["q"]
    if not edges:
        return F.lit(0)
    quantiles = F.lit(np.array(edges, "i8"))  # one literal, however many ranges
    halves = F.array(*[F.lit(ranges >> i) for i in range(1, ranges.bit_length())])
    return F.coalesce(F.aggregate(halves, F.lit(0), lambda low, half: F.when(
        F.get(quantiles, low + half - 1) < F.col("doc_id"), low + half).otherwise(low)), F.lit(0))
