"""Store, saved-listing, page and sheet scans (A4–A10).

Every scan is a DataFrame read with the projection and predicate stated up front, so
Catalyst pushes both into the Parquet reader (``PushedFilters`` / ``ReadSchema``) or the
JDBC query. The reference's 1 000-row offset paging is replaced by one partitioned scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carlot.session import shared_scratch_dir
from carlot.sources.json_arrays import array_items

STORE_COLUMNS = ("id", "titre", "prix", "kilometrage", "date_voiture", "marque", "modele", "modele_unifie",
                 "generation", "carburant", "lien_annonce", "lien_image", "source", "last_seen_at",
                 "is_active", "is_expired")


def read_store(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               where: Column | None = None, limit: int | None = None) -> DataFrame:
    """A4 / A5 / A6 / C8 — column subset + predicate (+ optional limit) on the store."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    if where is not None:
        df = df.where(where)
    return df.limit(limit) if limit is not None else df


def read_store_jdbc(spark: SparkSession, url: str, table: str, partition_column: str = "id",
                    lower: int = 0, upper: int = 1, num_partitions: int = 64, **options) -> DataFrame:
    """A5 — the whole store from a database in ``num_partitions`` parallel range reads."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", num_partitions).options(**options).load())


def count_where(df: DataFrame, predicate: Column) -> DataFrame:
    """A7 — a count without returning rows (one-row aggregate)."""
    return df.where(predicate).agg(F.count("*").cast("long").alias("n"))


def read_saved_listings(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A8 — a saved JSON array of listings, tagged with its source. The array is read by as many tasks as
    it has splits; its items, one a line, are read with the types that they show."""
    lines = shared_scratch_dir(spark, "saved-items")
    array_items(spark, path).select(F.regexp_replace("item", r"[\r\n]+", " ")).write.text(lines)
    return spark.read.json(lines).withColumn("source", F.lit(source))


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A9 — captured pages: a table ``(page_id, url, html, …)`` or one file per page."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("url"), F.col("value").alias("html"))
            .withColumn("page_id", F.xxhash64("url")))


def with_row_numbers(scan: DataFrame, columns: Sequence[str | Column], col: str = "row_id") -> DataFrame:
    """``columns`` of a file scan with row numbers from 0 without gaps, in the order of the files' names and
    of the rows in them.

    Spark deals splits by size, so numbers come from the splits' own order: (file, block) with a count
    each (as many rows as the scan has splits). The rows of a split stand together in a partition, so a
    row's place in it is the distance of its generated id from the split's least."""
    marked = scan.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                         F.monotonically_increasing_id().alias("_id"))
    counts = marked.groupBy("_file", "_block").agg(F.count("*").alias("n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_file", "_block", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    joined = marked.join(F.broadcast(starts), ["_file", "_block"])  # a row a split
    return joined.withColumn(col, F.col("_start") + F.col("_id") - F.col("_first")).drop("_file", "_block", "_id", "_first", "_start")


def read_sheet_links(spark: SparkSession, path: str, link_col: str = "lien") -> DataFrame:
    """A10 — the link column of an exported sheet (header row skipped), with its row
    number (file order) so rows can be removed by position."""
    return with_row_numbers(spark.read.option("header", True).csv(path), [F.col(link_col).alias("lien")])
