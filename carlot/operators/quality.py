"""Quality reports: coverage per source, ordered distinct misses, catalogue membership
(F5, F8, I2, E17, K12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.operators.resolve import Catalog
from carlot.session import sized_broadcast


def catalogue_member(resolved: DataFrame, cat: Catalog, make_col: str = "make",
                     model_col: str = "model", out: str = "found") -> DataFrame:
    """E17 — is the resolved model a catalogue member of its resolved make."""
    members = sized_broadcast(cat.models.where(F.col("model").isNotNull())
                              .select(F.col("make").alias("_mk"), F.col("model").alias("_md")).distinct()
                              .withColumn(out, F.lit(True)))
    j = resolved.join(members, (resolved[make_col] == members._mk) & (resolved[model_col] == members._md), "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(False))).drop("_mk", "_md")


def catalogue_coverage(listings: DataFrame, cat: Catalog, fuzzy: bool = True) -> DataFrame:
    """K12 — listings (``raw_make``, ``raw_model``, any other columns) with the resolved ``make`` and
    ``model`` and whether that is in the catalogue (``found``)."""
    from carlot.operators.resolve import resolve_models
    res = resolve_models(listings, cat, fuzzy=fuzzy).select(
        F.col("raw_make").alias("_make"), F.col("raw_model").alias("_model"), "make", "model")
    same = listings["raw_make"].eqNullSafe(res["_make"]) & listings["raw_model"].eqNullSafe(res["_model"])
    return catalogue_member(listings.join(res, same, "left").drop("_make", "_model"), cat, "make", "model")


def coverage(flagged: DataFrame, source_col: str = "source", found_col: str = "found") -> DataFrame:
    """F5 — matched / total / percent per source (0 rows → no row, no division)."""
    return (flagged.groupBy(source_col)
            .agg(F.count("*").cast("long").alias("total"),
                 F.count_if(F.col(found_col)).cast("long").alias("matched"))
            .withColumn("pct", F.round(F.col("matched") * 100.0 / F.col("total"), 2)))


def distinct_misses(flagged: DataFrame, order_col: str, source_col: str = "source",
                    make_col: str = "raw_make", model_col: str = "raw_model",
                    found_col: str = "found") -> DataFrame:
    """I2 — distinct unmatched (make, model) per source, ordered by first appearance."""
    return (flagged.where(~F.col(found_col))
            .groupBy(source_col, make_col, model_col).agg(F.min(order_col).alias("first_pos"))
            .orderBy(source_col, "first_pos"))


def preview(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """H3 — the first rows of what a run is about to write (a top-N, no full sort)."""
    return df.orderBy(*order).limit(n)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """F8 — count per value (the "n found / n to fix" messages)."""
    return df.groupBy(col).agg(F.count("*").cast("long").alias("n"))
