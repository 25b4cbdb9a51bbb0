"""Bindings of the scans and the smaller operators.

Files are written from the benchmark tables to the shared folder and read by the scan under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carlot.functions.numbers import registration_split
from carlot.functions.text import slug
from carlot.functions.timefmt import iso_utc, report_day, report_minute
from carlot.operators.catalog_ops import pending_makes
from carlot.operators.extract import crawl_prefix
from carlot.operators.ingest import read_dumps
from carlot.operators.quality import preview, value_counts
from carlot.operators.resolve import Catalog, rejected_rows, resolve_models
from carlot.operators.store import union_sources
from carlot.plans.common import SQL_LISTING_VIEW, listing_view, sql_store_from_events, store_from_events, table
from carlot.plans.resolve_queries import (SQL_CATALOG, SQL_MISSING_MAKES, _model_inputs, part_catalog,
                                          sql_model_resolution, sql_slug)
from carlot.session import shared_scratch_dir
from carlot.sources.sinks import latest_version, write_version
from carlot.sources.store import count_where, read_pages, read_saved_listings, read_sheet_links, read_store


def store_scan(spark, sf):
    """A4 / A6 — columns and a predicate of the written store, pushed into the scan."""
    path = shared_scratch_dir(spark, "store")
    store_from_events(spark, sf).write.parquet(path)
    return read_store(spark, path, ["id", "lien_annonce", "source", "prix"], F.col("source").isin("view", "click"))


STORE_SCAN_SQL = f"SELECT id, lien_annonce, source, prix FROM ({sql_store_from_events()}) s WHERE source IN ('view', 'click')"


def store_count(spark, sf):
    """A7 — a count by predicate."""
    path = shared_scratch_dir(spark, "store")
    store_from_events(spark, sf).write.parquet(path)
    return count_where(read_store(spark, path), F.col("prix") > 50)


STORE_COUNT_SQL = f"SELECT CAST(count(*) AS BIGINT) AS n FROM ({sql_store_from_events()}) s WHERE prix > 50"


def _array_texts(p, item):
    """JSON arrays of a thousand items each, by ranges of the key."""
    groups = p.groupBy(F.floor(F.col("p_partkey") / 1000)).agg(F.collect_list(item).alias("x"))
    return groups.select(F.to_json("x").alias("value"))


def saved_listings(spark, sf):
    """A8 — saved JSON arrays of listings, tagged with their source."""
    path = shared_scratch_dir(spark, "saved")
    p = table(spark, sf, "part")
    arrays = _array_texts(p, F.struct("p_partkey", "p_name", "p_brand"))
    arrays.write.text(path)
    return read_saved_listings(spark, path, "saved").select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_brand", "source")


SAVED_LISTINGS_SQL = "SELECT p_partkey, p_name, p_brand, 'saved' AS source FROM part"


def page_scan(spark, sf):
    """A9 — captured pages from a table."""
    path = shared_scratch_dir(spark, "pages")
    table(spark, sf, "pages").write.parquet(path)
    return read_pages(spark, path).select("page_id", "url", F.md5("html").alias("html_md5"))


PAGE_SCAN_SQL = "SELECT page_id, url, md5(html) AS html_md5 FROM pages"


def sheet_scan(spark, sf):
    """A10 — link column of an exported sheet with row numbers."""
    path = shared_scratch_dir(spark, "sheet")
    rows = table(spark, sf, "pages").select("page_id", F.col("url").alias("lien"))
    rows.repartitionByRange("page_id").sortWithinPartitions("page_id").write.option("header", True).csv(path)
    return read_sheet_links(spark, path)


SHEET_SCAN_SQL = "SELECT url AS lien, CAST(row_number() OVER (ORDER BY page_id) - 1 AS BIGINT) AS row_id FROM pages"


def dump_scan(spark, sf):
    """A1 — JSON-array dumps, every value as text."""
    path = shared_scratch_dir(spark, "dumps")
    p = table(spark, sf, "part")
    _array_texts(p, F.struct(F.col("p_partkey").alias("absolute href"), F.col("p_size").alias("text-body-2a"),
                             F.col("p_name").alias("text-body-1"))).write.text(path)
    return read_dumps(spark, path).select("absolute href", "text-body-1", "text-body-2a")


DUMP_SCAN_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS "absolute href", p_name AS "text-body-1", CAST(p_size AS VARCHAR) AS "text-body-2a" FROM part"""


def preview_rows(spark, sf):
    """H3 — the first three observations."""
    return preview(listing_view(spark, sf), ["event_id"]).select("event_id", "lien_annonce", "source")


PREVIEW_ROWS_SQL = f"SELECT event_id, lien_annonce, source FROM ({SQL_LISTING_VIEW}) v ORDER BY event_id LIMIT 3"


def version_write(spark, sf):
    """B7 — a second version of a table replaces the first for its readers."""
    base = shared_scratch_dir(spark, "versions")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    write_version(p.where("p_partkey % 2 = 0"), base)
    write_version(p, base, partition_by=["p_brand"])
    return latest_version(spark, base).select("p_partkey", "p_name", "p_brand")


VERSION_WRITE_SQL = "SELECT p_partkey, p_name, p_brand FROM part"


def reject_log(spark, sf):
    """B6 — rejected values with the number of listings that have them."""
    p = table(spark, sf, "part")
    make, model = _model_inputs(p, missing_makes=True)
    listings = p.select(make.alias("raw_make"), model.alias("raw_model"))
    return rejected_rows(resolve_models(listings, part_catalog(spark, sf)), listings)


REJECT_LOG_SQL = f"""
WITH RECURSIVE {SQL_CATALOG},
{sql_model_resolution(SQL_MISSING_MAKES)},
n AS (SELECT raw_make, raw_model, count(*) AS n FROM ({SQL_MISSING_MAKES}) q GROUP BY ALL)
SELECT res.reject_reason AS reason, res.make, res.slug_in AS slug, res.raw_model AS raw, CAST(sum(n.n) AS BIGINT) AS n
FROM res JOIN n ON res.raw_make IS NOT DISTINCT FROM n.raw_make AND res.raw_model = n.raw_model WHERE res.reject_reason IS NOT NULL GROUP BY ALL
"""


def pending_makes_q(spark, sf):
    """D14 / E13 — makes that an earlier output doesn't hold yet."""
    p = table(spark, sf, "part")
    return pending_makes(p.select(F.col("p_brand").alias("make")).distinct(),
                         p.where("p_size > 46 AND p_partkey % 11 = 0").select(F.col("p_brand").alias("make")))


PENDING_MAKES_SQL = """SELECT DISTINCT p_brand AS make FROM part
WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 46 AND p_partkey % 11 = 0)"""


def override_resolve(spark, sf):
    """E19 — manual labels come before every other stage."""
    p = table(spark, sf, "part")
    cat = part_catalog(spark, sf)
    overrides = p.where("p_size = 7").groupBy(slug("p_type").alias("make_slug"), slug("p_name").alias("raw_slug")).agg(
        F.concat(F.lit("Manual "), F.min("p_name")).alias("label"))
    cat = Catalog(cat.makes, cat.models, cat.aliases, overrides)
    pairs = p.select(F.col("p_type").alias("raw_make"), F.col("p_name").alias("raw_model"))
    return resolve_models(pairs, cat, use_overrides=True).select("raw_make", "raw_model", "model", "model_stage")


OVERRIDE_RESOLVE_SQL = f"""
WITH o AS (SELECT {sql_slug('p_type')} AS m, {sql_slug('p_name')} AS r, 'Manual ' || min(p_name) AS label FROM part WHERE p_size = 7 GROUP BY ALL)
SELECT DISTINCT p_type AS raw_make, p_name AS raw_model, coalesce(o.label, p_name) AS model,
       CASE WHEN o.label IS NOT NULL THEN 'override' ELSE 'exact' END AS model_stage
FROM part LEFT JOIN o ON o.m = {sql_slug('p_type')} AND o.r = {sql_slug('p_name')}
"""


def union_sources_q(spark, sf):
    """I1 — two sources with different columns as one table."""
    s, c = table(spark, sf, "supplier"), table(spark, sf, "customer")
    return union_sources(s.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
                         c.select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name")))


UNION_SOURCES_SQL = """SELECT s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer"""


def last_writer_slugs(spark, sf):
    """I8 — of catalogue names with one slug the last is found by similarity and containment."""
    p = table(spark, sf, "part").groupBy(F.lower("p_type").alias("t")).agg(F.min("p_partkey").alias("k"))
    twice = F.array(F.struct(F.col("t").alias("make"), (F.col("k") * 2).alias("make_pos")),
                    F.struct(F.upper("t").alias("make"), (F.col("k") * 2 + 1).alias("make_pos")))
    makes = p.select(F.explode(twice).alias("x")).select(F.col("x.make_pos").cast("long").alias("make_pos"), "x.make")
    models = makes.select("make", F.lit(0).cast("long").alias("model_pos"), F.lit("only").alias("model"))
    cat = Catalog(makes, models, spark.createDataFrame([], "alias_slug string, target string"))
    from carlot.operators.resolve import resolve_makes
    names = p.select(F.explode(F.array(F.col("t"), F.concat("t", F.lit(" cars france")))).alias("raw_make"))
    return resolve_makes(names, cat, fuzzy=False)


LAST_WRITER_SLUGS_SQL = """
WITH p AS (SELECT lower(p_type) AS t, min(p_partkey) AS k FROM part GROUP BY 1)
SELECT t AS raw_make, t AS make, 'exact' AS make_stage FROM p
UNION ALL
SELECT p.t || ' cars france', upper(arg_min(q.t, q.k)), 'contains' FROM p JOIN p q ON contains(p.t || ' cars france', q.t) GROUP BY p.t
"""


def registration_dates(spark, sf):
    """J16 — month-year texts, and texts that are none."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 4
    reg = (F.when(k == 0, F.date_format("o_orderdate", "MM-yyyy")).when(k == 1, F.date_format("o_orderdate", "MM-yyyy-dd"))
           .when(k == 2, F.date_format("o_orderdate", "yyyy")).otherwise(F.lit("")))
    date_mec, annee = registration_split(reg)
    return o.select("o_orderkey", date_mec.alias("date_mec"), annee.alias("annee"))


REGISTRATION_DATES_SQL = """
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%m-%Y') WHEN 1 THEN strftime(o_orderdate, '%m-%Y-%d')
             WHEN 2 THEN strftime(o_orderdate, '%Y') ELSE '' END AS reg FROM orders)
SELECT o_orderkey, CASE WHEN contains(reg, '-') THEN substr(reg, 1, 2) || '/' || substr(reg, 4) ELSE 'N/A' END AS date_mec,
       CASE WHEN contains(reg, '-') THEN substr(reg, 4) ELSE 'N/A' END AS annee FROM r
"""


def report_times(spark, sf):
    """J31 / J32 — time texts of reports."""
    e = table(spark, sf, "events")
    return e.select("event_id", iso_utc("ts").alias("iso"), report_day("ts").alias("day"), report_minute("ts").alias("minute"))


REPORT_TIMES_SQL = """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS iso, strftime(ts, '%Y-%m-%d') AS day,
       strftime(ts, '%Y-%m-%d à %H:%M') AS minute FROM events"""


def value_counts_q(spark, sf):
    """F8 — rows per value."""
    return value_counts(listing_view(spark, sf), "source")


VALUE_COUNTS_SQL = "SELECT event_type AS source, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1"


def page_cap(spark, sf):
    """H6 — crawls end at their stop page or at the cap, whichever comes first."""
    p = table(spark, sf, "pages").select((F.col("page_id") % 5).alias("crawl"), F.floor(F.col("page_id") / 5).cast("int").alias("page_num"))
    return crawl_prefix(p, "crawl", "page_num", (F.col("crawl") == 2) & (F.col("page_num") == 6), max_pages=20)


PAGE_CAP_SQL = """SELECT page_id % 5 AS crawl, CAST(page_id // 5 AS INTEGER) AS page_num FROM pages
WHERE page_id // 5 <= 20 AND (page_id % 5 <> 2 OR page_id // 5 < 6)"""

QUERIES = {
    "store_scan": (store_scan, STORE_SCAN_SQL),
    "store_count": (store_count, STORE_COUNT_SQL),
    "saved_listings": (saved_listings, SAVED_LISTINGS_SQL),
    "page_scan": (page_scan, PAGE_SCAN_SQL),
    "sheet_scan": (sheet_scan, SHEET_SCAN_SQL),
    "dump_scan": (dump_scan, DUMP_SCAN_SQL),
    "preview_rows": (preview_rows, PREVIEW_ROWS_SQL),
    "version_write": (version_write, VERSION_WRITE_SQL),
    "reject_log": (reject_log, REJECT_LOG_SQL),
    "pending_makes": (pending_makes_q, PENDING_MAKES_SQL),
    "override_resolve": (override_resolve, OVERRIDE_RESOLVE_SQL),
    "union_sources": (union_sources_q, UNION_SOURCES_SQL),
    "last_writer_slugs": (last_writer_slugs, LAST_WRITER_SLUGS_SQL),
    "registration_dates": (registration_dates, REGISTRATION_DATES_SQL),
    "report_times": (report_times, REPORT_TIMES_SQL),
    "value_counts": (value_counts_q, VALUE_COUNTS_SQL),
    "page_cap": (page_cap, PAGE_CAP_SQL),
}
