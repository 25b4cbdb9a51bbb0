"""Catalogue scans (A2, A3) and catalogue tables built from DataFrames.

The make→models catalogue is a JSON object ``{make: [model, …]}`` whose key order
and list order carry meaning (first match wins); the generation catalogue is
``{MODEL: [{gen, from, to}, …]}``. Both are read as one JSON value, parsed into a
``map`` (key order is kept) and exploded with positions into long tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.operators.resolve import Catalog, alias_table

MAKES_SCHEMA = "make_pos int, make string"
MODELS_SCHEMA = "make string, model_pos int, model string"
GENS_SCHEMA = "key_pos int, model string, gens array<struct<gen:string,`from`:int,`to`:int>>"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist, on whatever file system its scheme (or the default one) names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _whole_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def load_make_catalog(spark: SparkSession, path: str, with_aliases: bool = True) -> Catalog:
    """A2 — make→models catalogue; a missing file gives an empty catalogue."""
    if not path_exists(spark, path):
        return Catalog(spark.createDataFrame([], MAKES_SCHEMA), spark.createDataFrame([], MODELS_SCHEMA),
                       alias_table(spark) if with_aliases else None)
    raw = _whole_json(spark, path).select(
        F.from_json("value", "map<string,array<string>>").alias("m"))
    return catalog_from_map_column(raw, "m", with_aliases)


def catalog_from_map_column(df: DataFrame, col: str, with_aliases: bool = True) -> Catalog:
    spark = df.sparkSession
    entries = df.select(F.posexplode(F.map_entries(col)).alias("make_pos", "e")).select(
        "make_pos", F.col("e.key").alias("make"), F.col("e.value").alias("models"))
    makes = entries.select("make_pos", "make")
    models = entries.select("make", F.posexplode("models").alias("model_pos", "model"))
    return Catalog(makes, models, alias_table(spark) if with_aliases else None)


def catalog_from_dict(spark: SparkSession, d: dict[str, list[str]], with_aliases: bool = True) -> Catalog:
    """Small in-memory catalogue (tests, fixtures)."""
    makes = spark.createDataFrame([(i, k) for i, k in enumerate(d)], MAKES_SCHEMA)
    models = spark.createDataFrame(
        [(k, j, m) for k, v in d.items() for j, m in enumerate(v)], MODELS_SCHEMA)
    return Catalog(makes, models, alias_table(spark) if with_aliases else None)


def catalog_from_long(df: DataFrame, make_col: str, model_col: str, order_col: str,
                      with_aliases: bool = False) -> Catalog:
    """Catalogue derived from a table: makes and models ordered by their first
    appearance in ``order_col`` (a deterministic position, not arrival order).

    The first-appearance value itself is the position: only the order of positions
    matters downstream, so no ranking window (and no single-task sort) is needed."""
    firsts = df.groupBy(make_col, model_col).agg(F.min(order_col).alias("_o"))
    makes = firsts.groupBy(make_col).agg(F.min("_o").cast("long").alias("make_pos")).select(
        "make_pos", F.col(make_col).alias("make"))
    models = firsts.select(F.col(make_col).alias("make"), F.col("_o").cast("long").alias("model_pos"),
                           F.col(model_col).alias("model"))
    spark = df.sparkSession
    return Catalog(makes, models, alias_table(spark) if with_aliases else None)


def load_generation_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A3 — generation catalogue as (key_pos, model, gens array<struct<gen,from,to>>)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], GENS_SCHEMA)
    raw = _whole_json(spark, path).select(F.from_json(
        "value", "map<string,array<struct<gen:string,`from`:int,`to`:int>>>").alias("m"))
    return raw.select(F.posexplode(F.map_entries("m")).alias("key_pos", "e")).select(
        "key_pos", F.col("e.key").alias("model"), F.col("e.value").alias("gens"))


def generations_from_dict(spark: SparkSession, d: dict[str, list[dict]]) -> DataFrame:
    rows = [(i, k, [(g["gen"], g["from"], g["to"]) for g in v]) for i, (k, v) in enumerate(d.items())]
    return spark.createDataFrame(rows, GENS_SCHEMA)


def load_overrides(spark: SparkSession, path: str) -> DataFrame:
    """E19 table ``{make_slug: {raw: label}}`` → (make_slug, raw_slug, label)."""
    raw = _whole_json(spark, path).select(F.from_json("value", "map<string,map<string,string>>").alias("m"))
    return (raw.select(F.explode("m").alias("make_slug", "inner"))
            .select("make_slug", F.explode("inner").alias("raw_slug", "label")))
