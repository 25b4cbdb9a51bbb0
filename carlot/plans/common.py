"""Shared pieces of the bindings: table access, fixed run parameters, SQL fragments.

The benchmark tables are not car data, so every binding maps their columns onto the
listing operators (SURVEY §7.3). Each binding reads whole tables; catalogues and
reference lists are derived from the tables by Spark (so their size grows with them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.functions.text import WS

# Fixed run parameters (repeatable runs): the "now" of the lifecycle jobs and the
# split between the stored table and the incoming batch.
AS_OF = "2024-01-31 00:00:00"
SPLIT_TS = "2024-01-16 00:00:00"
BASE_URL = "https://listings.example"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as listing observations: link per (user, type), source = type."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.concat(F.lit("/l/"), F.col("user_id").cast("string"), F.lit("/"),
                                         F.col("event_type")).alias("lien_annonce"),
                    F.col("event_type").alias("source"), F.col("ts").alias("last_seen_at"),
                    F.col("value").alias("prix"))


def store_from_events(spark: SparkSession, sf_dir: str, before: str | None = None) -> DataFrame:
    """One stored row per link: first event id, last time seen, price at that time."""
    v = listing_view(spark, sf_dir)
    if before is not None:
        v = v.where(F.col("last_seen_at") < F.lit(before).cast("timestamp_ntz"))
    return v.groupBy("lien_annonce", "source").agg(
        F.min("event_id").alias("id"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.max_by("prix", F.struct("last_seen_at", "event_id")).alias("prix"),
    ).withColumn("is_expired", F.lit(False))


def sql_ws() -> str:
    """The whitespace class (Python ``str.isspace``) in RE2 syntax for DuckDB."""
    return WS()


SQL_LISTING_VIEW = """
  SELECT event_id, '/l/' || CAST(user_id AS VARCHAR) || '/' || event_type AS lien_annonce,
         event_type AS source, ts AS last_seen_at, value AS prix
  FROM events
"""


def sql_store_from_events(before: str | None = None) -> str:
    where = f"WHERE last_seen_at < TIMESTAMP '{before}'" if before else ""
    return f"""
  SELECT lien_annonce, source, min(event_id) AS id, max(last_seen_at) AS last_seen_at,
         arg_max(prix, (last_seen_at, event_id)) AS prix, false AS is_expired
  FROM ({SQL_LISTING_VIEW}) v {where}
  GROUP BY lien_annonce, source
"""
