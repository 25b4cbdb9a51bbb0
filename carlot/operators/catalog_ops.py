"""Catalogue maintenance: resume anti-join, alias expansion, patches, totals
(E13, F7, I3–I8, K16, K17).

Catalogues are long tables, so every patch is a join / union with explicit positions.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.functions.text import variant_slug
from carlot.operators.resolve import Catalog
from carlot.session import cut_lineage, sized_broadcast


def pending_makes(all_makes: DataFrame, done: DataFrame) -> DataFrame:
    """E13 / D14 — makes not processed yet (resume against already-written output)."""
    return all_makes.join(done.select("make").distinct(), "make", "left_anti")


def complete_steps(spark: SparkSession, path: str) -> list[str]:
    """Folders of the steps that have been written whole."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    if not fs.exists(at):
        return []
    folders = [s.getPath() for s in fs.listStatus(at) if s.isDirectory()]
    return sorted(f.toString() for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def read_steps(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What the complete steps hold; folders of a broken one are not read."""
    folders = complete_steps(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).drop("step")


def build_in_steps(makes: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, schema: str, steps: int = 16) -> int:
    """K16 with B7 per make — build a catalogue that can be taken up again. ``build`` gives the rows of
    some makes (a column ``make`` among them, ``schema``); they are written step by step, a partition a
    make. Makes that a complete step holds are done; a run that broke off leaves the rest to the next.
    Returns the number of makes that were pending."""
    spark = makes.sparkSession
    pending = cut_lineage(pending_makes(makes.select("make").distinct(), read_steps(spark, path, schema)))
    step = F.pmod(F.xxhash64("make"), F.lit(steps))
    sizes = {r["s"]: r["n"] for r in pending.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()}  # a row a step
    for s in sorted(sizes):
        build(pending.where(step == s)).write.partitionBy("make").parquet(os.path.join(path, f"step={uuid.uuid4().hex}"))
    return sum(sizes.values())


def add_makes(cat: Catalog, additions: DataFrame) -> Catalog:
    """I3 — add makes (with their models) only when absent; new makes go last, in
    patch order. ``additions``: (add_pos ≥ 0, make, model_pos, model); a new make's
    position is ``max(existing) + 1 + its first add_pos`` (order-preserving, no window)."""
    new = additions.select("make").distinct().join(cat.makes.select("make"), "make", "left_anti")
    base = cat.makes.agg(F.coalesce(F.max("make_pos") + 1, F.lit(0))).first()[0]  # one scalar
    first = additions.join(new, "make").groupBy("make").agg(F.min("add_pos").alias("_o"))
    new_makes = first.select((F.lit(base) + F.col("_o")).cast("long").alias("make_pos"), "make")
    new_models = additions.join(new, "make").where(F.col("model").isNotNull()).select("make", "model_pos", "model")
    return Catalog(cat.makes.unionByName(new_makes), cat.models.unionByName(new_models), cat.aliases, cat.overrides)


def append_models(cat: Catalog, extra: DataFrame) -> Catalog:
    """I4 — for existing makes only, append models not already listed, keeping order.

    ``extra``: (make, model_pos, model). Duplicates inside ``extra`` keep their first
    position (Q19)."""
    have = cat.models.select("make", "model").distinct()
    known = cat.makes.select("make")
    cand = (extra.join(known, "make", "left_semi").join(have, ["make", "model"], "left_anti")
            .groupBy("make", "model").agg(F.min("model_pos").alias("_o")))
    nxt = cat.models.groupBy("make").agg((F.max("model_pos") + 1).alias("_b"))
    from pyspark.sql import Window
    added = (cand.join(nxt, "make", "left")
             .withColumn("model_pos", (F.coalesce("_b", F.lit(0)) +
                                       F.row_number().over(Window.partitionBy("make").orderBy("_o")) - 1).cast("long"))
             .select("make", "model_pos", "model"))
    return Catalog(cat.makes, cat.models.unionByName(added), cat.aliases, cat.overrides)


def extend_open_end(gens: DataFrame, pairs: DataFrame, to_value: int = 9999) -> DataFrame:
    """I6 — set ``to`` of (model, gen) pairs to an open end; other entries unchanged.

    ``pairs``: (model, gen). Works inside the array (``transform`` + ``withField``)."""
    p = pairs.groupBy("model").agg(F.collect_set("gen").alias("_ext"))
    j = gens.join(sized_broadcast(p), "model", "left")
    upd = F.transform("gens", lambda g: F.when(
        F.coalesce(F.array_contains(F.col("_ext"), g["gen"]), F.lit(False)),
        g.withField("to", F.lit(to_value))).otherwise(g))
    return j.withColumn("gens", upd).drop("_ext")


def replace_lists(gens: DataFrame, new: DataFrame) -> DataFrame:
    """I5 — replace a whole list by key (keeping its position), else add the key at the
    end in patch order. ``new``: (key_pos, model, gens) with ``key_pos`` the patch order."""
    kept = gens.join(new.select("model"), "model", "left_anti")
    base = gens.agg(F.coalesce(F.max("key_pos") + 1, F.lit(0))).first()[0]  # one scalar
    added = (new.join(gens.select("model", F.col("key_pos").alias("_old")), "model", "left")
             .select(F.coalesce("_old", F.lit(base) + F.col("key_pos")).cast("int").alias("key_pos"), "model", "gens"))
    return kept.unionByName(added)


def model_aliases(cat: Catalog) -> DataFrame:
    """I7 / K16 — catalogue with aliases: per make slug (builder slug, J2) the display
    name and aliases (slug, slug without spaces, slug with hyphens) → model.

    A make slug written twice keeps only the later make; within a make a repeated
    alias keeps the later model."""
    mk = (cat.makes.select("make_pos", "make", variant_slug("make").alias("make_slug"))
          .groupBy("make_slug").agg(F.max_by(F.struct("make", "make_pos"), "make_pos").alias("m"))
          .select("make_slug", "m.make", "m.make_pos"))
    m = cat.models.where(F.col("model").isNotNull()).join(mk, "make").select(
        "make_slug", "make", "model_pos", "model", variant_slug("model").alias("s"))
    ex = m.select("make_slug", "make", "model_pos", "model",
                  F.explode(F.array_distinct(F.array(F.col("s"), F.regexp_replace("s", " ", ""),
                                                     F.regexp_replace("s", " ", "-")))).alias("alias"))
    return (ex.groupBy("make_slug", "alias")
            .agg(F.max("make").alias("display"), F.max_by("model", "model_pos").alias("model")))


def catalogue_totals(aliases: DataFrame) -> DataFrame:
    """F7 — number of makes and of model aliases."""
    return aliases.agg(F.countDistinct("make_slug").cast("long").alias("makes"),
                       F.count("*").cast("long").alias("model_aliases"))
