"""Bindings of the store and lifecycle operators (G1, B3, B4, B5/D9, D5/D6/H1, F4/H2/K10,
K5, K6, K11/D10) to the ``events`` listing view and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from carlot.functions.text import title_case
from carlot.operators.lifecycle import (classify_probe, expiry_run, flag_expired, gate_report, http_expiry_run,
                                        oldest_first, run_counters, sheet_prune, stale, ttl_expiry_run)
from carlot.operators.store import changed_only, first_per_key, insert_absent, patch, upsert
from carlot.plans.common import (AS_OF, SPLIT_TS, SQL_LISTING_VIEW, listing_view, sql_store_from_events,
                                 store_from_events, table)
from carlot.plans.scalar_queries import _sql_title
from carlot.session import shared_scratch_dir
from carlot.sources.bucketed import BucketedStore


def dedup_first(spark, sf):
    """G1 — first observation per link in arrival order (ts, event_id)."""
    v = listing_view(spark, sf)
    return first_per_key(v, "lien_annonce", ["last_seen_at", "event_id"]).select(
        "lien_annonce", "event_id", "source", "last_seen_at", "prix")


DEDUP_FIRST_SQL = f"""
SELECT lien_annonce, event_id, source, last_seen_at, prix FROM (
  SELECT *, row_number() OVER (PARTITION BY lien_annonce ORDER BY last_seen_at, event_id) AS rn
  FROM ({SQL_LISTING_VIEW}) v WHERE lien_annonce IS NOT NULL AND lien_annonce <> '') t
WHERE rn = 1
"""


def _odd_links(df):
    """Every 40th user's links are missing, every 41st user's are empty texts."""
    user = F.regexp_extract("lien_annonce", r"^/l/(\d+)/", 1).cast("int")
    return df.withColumn("lien_annonce", F.when(user % 40 == 7, F.lit(None)).when(user % 41 == 5, F.lit(""))
                         .otherwise(F.col("lien_annonce")))


SQL_ODD_LINKS = """
  SELECT * REPLACE (CASE WHEN CAST(regexp_extract(lien_annonce, '^/l/(\\d+)/', 1) AS INTEGER) % 40 = 7 THEN NULL
                         WHEN CAST(regexp_extract(lien_annonce, '^/l/(\\d+)/', 1) AS INTEGER) % 41 = 5 THEN ''
                         ELSE lien_annonce END AS lien_annonce) FROM"""


def _batch(spark, sf):
    v = _odd_links(listing_view(spark, sf))
    return v.where(F.col("last_seen_at") >= F.lit(SPLIT_TS).cast("timestamp_ntz")).select(
        "event_id", "lien_annonce", "source", "prix", "last_seen_at")


def upsert_touched(spark, sf):
    """B3 in part — the same upsert into a store partitioned by a hash of the link."""
    old, batch, order, _ = upsert_run(spark, sf)
    store = BucketedStore(shared_scratch_dir(spark, "bucketed"), "lien_annonce", 32)
    store.create(old)
    store.upsert(batch, order)
    return store.read(spark).select("id", "lien_annonce", "source", "prix", "last_seen_at", "is_expired")


#: Observations with a smaller price are rejected by a counted upsert.
LEAST_PRICE = 1.0


def upsert_run(spark, sf):
    """A store of links seen before the split, a batch of observations after it, the order of the
    batch's rows, and what makes a row of it a reject."""
    store = store_from_events(spark, sf, before=SPLIT_TS).select(
        "id", "lien_annonce", "source", "prix", "last_seen_at", "is_expired")
    return store, _batch(spark, sf), ["last_seen_at", "event_id"], {"prix_trop_bas": F.col("prix") < LEAST_PRICE}


def upsert_latest(spark, sf):
    """B3 — store = links seen before the split, batch = observations after it."""
    store, batch, order, _ = upsert_run(spark, sf)
    out = upsert(store, batch, "lien_annonce", batch_order=order)
    return out.select("id", "lien_annonce", "source", "prix", "last_seen_at", "is_expired")


UPSERT_LATEST_SQL = f"""
WITH s AS ({sql_store_from_events(SPLIT_TS)}),
v AS ({SQL_ODD_LINKS} ({SQL_LISTING_VIEW}) v WHERE last_seen_at >= TIMESTAMP '{SPLIT_TS}'),
b AS (
  SELECT lien_annonce, source, prix, last_seen_at FROM (
    SELECT *, row_number() OVER (PARTITION BY lien_annonce ORDER BY last_seen_at DESC, event_id DESC) AS rn
    FROM v WHERE lien_annonce IS NOT NULL) t WHERE rn = 1)
SELECT s.id, coalesce(b.lien_annonce, s.lien_annonce) AS lien_annonce,
       CASE WHEN b.lien_annonce IS NOT NULL THEN b.source ELSE s.source END AS source,
       CASE WHEN b.lien_annonce IS NOT NULL THEN b.prix ELSE s.prix END AS prix,
       CASE WHEN b.lien_annonce IS NOT NULL THEN b.last_seen_at ELSE s.last_seen_at END AS last_seen_at,
       s.is_expired
FROM s FULL OUTER JOIN b ON s.lien_annonce = b.lien_annonce
UNION ALL
SELECT NULL, lien_annonce, source, prix, last_seen_at, NULL FROM v WHERE lien_annonce IS NULL
"""


UPSERT_COUNTS_SQL = f"""
WITH s AS ({sql_store_from_events(SPLIT_TS)}),
v AS ({SQL_ODD_LINKS} ({SQL_LISTING_VIEW}) v WHERE last_seen_at >= TIMESTAMP '{SPLIT_TS}'),
g AS (SELECT * FROM v WHERE prix IS NULL OR prix >= {LEAST_PRICE}),
b AS (SELECT lien_annonce, arg_max(prix, (last_seen_at, event_id)) AS prix, max(last_seen_at) AS last_seen_at FROM g WHERE lien_annonce IS NOT NULL GROUP BY 1)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM g) AS sent,
       (SELECT CAST(count(*) AS BIGINT) FROM b WHERE lien_annonce NOT IN (SELECT lien_annonce FROM s))
         + (SELECT CAST(count(*) AS BIGINT) FROM g WHERE lien_annonce IS NULL) AS inserted,
       (SELECT CAST(count(*) AS BIGINT) FROM b JOIN s ON b.lien_annonce = s.lien_annonce) AS updated, CAST(0 AS BIGINT) AS unchanged,
       (SELECT CAST(count(*) AS BIGINT) FROM s WHERE lien_annonce NOT IN (SELECT lien_annonce FROM b)) AS kept,
       (SELECT CAST(count(*) AS BIGINT) FROM v WHERE prix < {LEAST_PRICE}) AS errors
"""


def insert_absent_q(spark, sf):
    """B4 — append the first batch row of every link not stored yet."""
    store = store_from_events(spark, sf, before=SPLIT_TS).select(
        "id", "lien_annonce", "source", "prix", "last_seen_at")
    batch = _batch(spark, sf).withColumnRenamed("event_id", "id")
    out, _ = insert_absent(store, batch, "lien_annonce", batch_order=["last_seen_at", "id"])
    return out.select("id", "lien_annonce", "source", "prix", "last_seen_at")


INSERT_ABSENT_SQL = f"""
WITH s AS ({sql_store_from_events(SPLIT_TS)}),
v AS ({SQL_ODD_LINKS} ({SQL_LISTING_VIEW}) v WHERE last_seen_at >= TIMESTAMP '{SPLIT_TS}'),
b AS (
  SELECT event_id AS id, lien_annonce, source, prix, last_seen_at FROM (
    SELECT *, row_number() OVER (PARTITION BY lien_annonce ORDER BY last_seen_at, event_id) AS rn
    FROM v WHERE lien_annonce IS NOT NULL) t WHERE rn = 1)
SELECT id, lien_annonce, source, prix, last_seen_at FROM s
UNION ALL
SELECT id, lien_annonce, source, prix, last_seen_at FROM b
WHERE lien_annonce NOT IN (SELECT lien_annonce FROM s)
UNION ALL
SELECT event_id, lien_annonce, source, prix, last_seen_at FROM v WHERE lien_annonce IS NULL
"""


def part_store(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("marque"),
                    F.col("p_name").alias("modele"),
                    F.when(F.col("p_size") < 25, F.col("p_name")).otherwise(title_case("p_name"))
                    .alias("modele_unifie"))


def part_changes(spark, sf):
    """D9 — rows of ``part_store`` whose recomputed model differs: (id, modele_unifie)."""
    recomputed = part_store(spark, sf).where((F.col("marque") != "") & (F.col("modele") != "")).select(
        "id", "modele_unifie", title_case("modele").alias("new"))
    return changed_only(recomputed, "new", "modele_unifie").select("id", F.col("new").alias("modele_unifie"))


def patch_changed(spark, sf):
    """K2 shape (D9 + B5): recompute a column, keep changed rows only, apply them by id.

    Returns the patched table with a flag telling which rows changed."""
    store, changes = part_store(spark, sf), part_changes(spark, sf)
    out = patch(store, changes, "id", ["modele_unifie"])
    return out.join(changes.select("id", F.lit(True).alias("changed")), "id", "left").select(
        "id", "marque", "modele", "modele_unifie", F.coalesce("changed", F.lit(False)).alias("changed"))


PATCH_CHANGED_SQL = f"""
WITH s AS (
  SELECT p_partkey AS id, p_type AS marque, p_name AS modele,
         CASE WHEN p_size < 25 THEN p_name ELSE {_sql_title("p_name")} END AS modele_unifie
  FROM part),
n AS (SELECT id, {_sql_title("modele")} AS new FROM s WHERE marque <> '' AND modele <> '')
SELECT s.id, s.marque, s.modele,
       CASE WHEN n.new <> coalesce(s.modele_unifie, '') THEN n.new ELSE s.modele_unifie END AS modele_unifie,
       coalesce(n.new <> coalesce(s.modele_unifie, ''), false) AS changed
FROM s LEFT JOIN n ON s.id = n.id
"""

PART_CHANGES_SQL = f"SELECT id FROM ({PATCH_CHANGED_SQL}) q WHERE changed"

STALE_SOURCES = ["view", "click"]


def stale_topn(spark, sf):
    """D5 + H1 — the 50 oldest unseen listings of two sources (a top-N report)."""
    st = store_from_events(spark, sf)
    return oldest_first(stale(st, AS_OF, 2, STALE_SOURCES), 50).select(
        "id", "lien_annonce", "source", "last_seen_at")


STALE_TOPN_SQL = f"""
SELECT id, lien_annonce, source, last_seen_at FROM ({sql_store_from_events()}) s
WHERE NOT is_expired AND last_seen_at < TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY AND source IN ('view', 'click')
ORDER BY last_seen_at, id LIMIT 50
"""


def ttl_expire(spark, sf):
    """D6 + K7 — TTL change set of one source."""
    st = store_from_events(spark, sf)
    return ttl_expiry_run(st, AS_OF, ttl_days=7, source="purchase").select("id", "lien_annonce", "reason")


TTL_EXPIRE_SQL = f"""
SELECT id, lien_annonce, 'lbc_ttl:7j' AS reason FROM ({sql_store_from_events()}) s
WHERE NOT is_expired AND source = 'purchase' AND last_seen_at < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
"""

GATE_THRESHOLDS = [("view", 350), ("click", 20), ("purchase", 60), ("error", 45)]


def gate_report_q(spark, sf):
    """K10 — recent-count safety gate per source and ranked stale candidates."""
    st = store_from_events(spark, sf)
    th = spark.createDataFrame(GATE_THRESHOLDS, "source string, min_recent int")
    return gate_report(st, AS_OF, th)


def _sql_values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


GATE_REPORT_SQL = f"""
WITH s AS ({sql_store_from_events()}),
th(source, min_recent) AS (VALUES {_sql_values(GATE_THRESHOLDS)}),
c AS (SELECT source, count(*) FILTER (WHERE last_seen_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR) AS rc
      FROM s WHERE source IN (SELECT source FROM th) GROUP BY source),
v AS (SELECT th.source, CAST(coalesce(c.rc, 0) AS BIGINT) AS recent_count, th.min_recent AS threshold,
             coalesce(c.rc, 0) >= th.min_recent AS allowed FROM th LEFT JOIN c ON th.source = c.source),
cand AS (SELECT source, id, lien_annonce, last_seen_at,
                row_number() OVER (PARTITION BY source ORDER BY last_seen_at, id) AS rn
         FROM s WHERE NOT (last_seen_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR)
           AND source IN (SELECT source FROM th))
SELECT cand.source, id, lien_annonce, last_seen_at, recent_count, threshold, allowed,
       CAST(CASE WHEN rn <= 10 THEN rn END AS INTEGER) AS sample_rank
FROM cand LEFT JOIN v ON cand.source = v.source
"""

# Probe results synthesised from pages: status / error / final URL by page id, the page
# itself as the fetched HTML; the "sold" text is a word present in some pages.
SOLD_MARK = "nicht"


def _probes(spark, sf):
    p = table(spark, sf, "pages")
    lang = F.regexp_extract("url", "/(en|fr|de|es)/", 1)
    k = F.col("page_id") % 7
    status = F.when(k == 0, 404).when(k == 1, 410).when(k == 2, 503).when(k == 3, 403).when(
        k.isin(4, 5), None).otherwise(200)
    error = F.when(k <= 3, F.lit("http")).when(k == 4, F.lit("url")).when(k == 5, F.lit("other"))
    m = F.col("page_id") % 3
    final = (F.when(m == 0, F.concat(F.col("url"), F.lit("/")))
             .when(m == 1, F.concat(F.split_part(F.col("url"), F.lit("?"), F.lit(1)), F.lit("?from=probe")))
             .otherwise(F.lit("https://elsewhere.example/vehicle-not-available")))
    source = F.when(lang == "fr", "autoscout24").when(lang == "en", "aramisauto").otherwise("other")
    return p.select("page_id", F.col("url").alias("lien"), source.alias("source"),
                    status.cast("int").alias("status"), final.alias("final_url"),
                    F.lower("html").alias("html"), error.alias("error"))


SQL_PROBES = """
  SELECT page_id, url AS lien,
         CASE regexp_extract(url, '/(en|fr|de|es)/', 1) WHEN 'fr' THEN 'autoscout24'
              WHEN 'en' THEN 'aramisauto' ELSE 'other' END AS source,
         CAST(CASE page_id % 7 WHEN 0 THEN 404 WHEN 1 THEN 410 WHEN 2 THEN 503 WHEN 3 THEN 403
                  WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE 200 END AS INTEGER) AS status,
         CASE page_id % 3 WHEN 0 THEN url || '/' WHEN 1 THEN split_part(url, '?', 1) || '?from=probe'
              ELSE 'https://elsewhere.example/vehicle-not-available' END AS final_url,
         lower(html) AS html,
         CASE WHEN page_id % 7 <= 3 THEN 'http' WHEN page_id % 7 = 4 THEN 'url'
              WHEN page_id % 7 = 5 THEN 'other' END AS error
  FROM pages
"""


def probe_classify(spark, sf):
    """K5 — probe outcome per link."""
    pr = _probes(spark, sf)
    r = classify_probe(F.col("lien"), F.col("source"), F.col("status"), F.col("final_url"),
                       F.col("html"), F.col("error"), sold_text=SOLD_MARK)
    return pr.select("page_id", "source", r["expired"].alias("expired"), r["reason"].alias("reason"))


PROBE_CLASSIFY_SQL = f"""
WITH p AS ({SQL_PROBES}),
r AS (SELECT page_id, source,
  CASE WHEN error = 'url' THEN 'url_error'
       WHEN error = 'other' THEN 'erreur_inconnue'
       WHEN (error = 'http' OR (error IS NULL AND status >= 400)) AND status IN (404, 410) THEN 'x:http_' || status
       WHEN (error = 'http' OR (error IS NULL AND status >= 400)) THEN 'http_' || status || '_ambigu'
       WHEN source = 'autoscout24' THEN
         CASE WHEN contains(coalesce(html, ''), '{SOLD_MARK}') THEN 'x:texte_expiration'
              WHEN regexp_replace(split_part(final_url, '?', 1), '/+$', '')
                   <> regexp_replace(split_part(lien, '?', 1), '/+$', '') THEN 'x:url_redirect'
              ELSE 'active' END
       WHEN source = 'aramisauto' THEN
         CASE WHEN contains(coalesce(final_url, ''), 'vehicle-not-available') THEN 'x:url_redirect' ELSE 'active' END
       ELSE 'source_inconnue' END AS r
  FROM p)
SELECT page_id, source, starts_with(r, 'x:') AS expired, regexp_replace(r, '^x:', '') AS reason FROM r
"""


def _repeated(probes, k):
    """Every ninth link without a probe, every fourth with an older one (gone) as well."""
    at = F.lit(AS_OF).cast("timestamp_ntz")
    last = probes.withColumn("probed_at", at).where(k % 9 != 4)
    older = (probes.where(k % 4 == 1).withColumn("status", F.lit(410)).withColumn("error", F.lit("http"))
             .withColumn("probed_at", at - F.make_dt_interval(days=F.lit(3))))
    return last.unionByName(older.where(k % 9 != 4))


def sheet_prune_q(spark, sf):
    """K11 + D10 — a sheet of links (some not absolute), dead rows removed."""
    p = table(spark, sf, "pages")
    lien = F.when(F.col("page_id") % 5 == 0, F.regexp_extract("url", r"^https?://[^/]+(/.*)?$", 1)) \
        .otherwise(F.col("url"))
    sheet = p.select("page_id", lien.alias("lien"))
    return sheet_prune(sheet, _repeated(_probes(spark, sf), F.col("page_id"))).select("page_id", "lien", "statut")


SHEET_PRUNE_SQL = f"""
WITH sheet AS (
  SELECT page_id, CASE WHEN page_id % 5 = 0 THEN regexp_extract(url, '^https?://[^/]+(/.*)?$', 1) ELSE url END AS lien
  FROM pages),
p AS ({SQL_PROBES}),
j AS (SELECT sheet.page_id, sheet.lien,
        CASE WHEN coalesce(starts_with(sheet.lien, 'http'), false) THEN
          CASE WHEN p.lien IS NULL THEN 'NON_SONDE'
               WHEN p.error IS NOT NULL AND p.error <> 'http' THEN 'ERREUR'
               WHEN p.status IN (404, 410) THEN 'MORT'
               WHEN p.status = 403 THEN 'ERREUR'
               WHEN contains(lower(coalesce(p.html, '')), 'plus disponible')
                 OR contains(lower(coalesce(p.html, '')), 'véhicule vendu') THEN 'MORT'
               ELSE 'ACTIF' END END AS statut
      FROM sheet LEFT JOIN (SELECT * FROM p WHERE page_id % 9 <> 4) p ON sheet.lien = p.lien)
SELECT page_id, lien, statut FROM j WHERE coalesce(statut, '') <> 'MORT'
"""


def _expiry_inputs(spark, sf):
    """Listings of the ``events`` view with probed sources, and probe results by their ids."""
    st = store_from_events(spark, sf).withColumn(
        "source", F.when(F.col("source") == "view", "autoscout24").when(F.col("source") == "click", "aramisauto")
        .otherwise(F.col("source")))
    k = F.col("id") % 6
    probes = _repeated(st.select(
        "id", F.col("lien_annonce").alias("lien"),
        F.when(k == 0, 404).when(k == 1, 500).when(k == 2, None).otherwise(200).cast("int").alias("status"),
        F.when(k == 3, F.concat("lien_annonce", F.lit("/moved"))).otherwise(F.col("lien_annonce")).alias("final_url"),
        F.when(k == 4, F.lit("annonce n'est malheureusement plus disponible")).otherwise(F.lit("ok")).alias("html"),
        F.when(k <= 1, F.lit("http")).when(k == 2, F.lit("url")).alias("error")), F.col("id"))
    store = st.withColumn("source", F.when(F.col("id") % 11 == 0, F.lit("purchase")).otherwise(F.col("source")))
    return store, probes


EXPIRY_SOURCES = ["autoscout24", "aramisauto", "purchase"]


def expiry_flags(spark, sf):
    """K9 + K8 — http (no limit), then TTL change sets, applied to the store (``is_expired`` and
    the new ``expire_reason``)."""
    store, probes = _expiry_inputs(spark, sf)
    cs = expiry_run(store, probes, AS_OF, stale_days=1, source=EXPIRY_SOURCES, ttl_days=7, ttl_source="autoscout24")
    return flag_expired(store, cs).select("id", "lien_annonce", "source", "is_expired", "expire_reason")


def http_expiry(spark, sf):
    """K6 — stale → oldest N → eligibility → latest probe → classification → change set."""
    store, probes = _expiry_inputs(spark, sf)
    return http_expiry_run(store, probes, AS_OF, batch=200, stale_days=1, source=EXPIRY_SOURCES).select(
        "id", "lien_annonce", "source", "status", "expired", "reason", "expire_reason")


def run_counters_q(spark, sf):
    """F6 — counters of an unlimited http run."""
    store, probes = _expiry_inputs(spark, sf)
    return run_counters(http_expiry_run(store, probes, AS_OF, batch=None, stale_days=1, source=EXPIRY_SOURCES))


def _http_expiry_sql(limit: str) -> str:
    return HTTP_EXPIRY_TEMPLATE.replace("LIMIT 200", limit)


HTTP_EXPIRY_TEMPLATE = f"""
WITH s0 AS ({sql_store_from_events()}),
s AS (SELECT id, lien_annonce, last_seen_at, is_expired,
        CASE WHEN id % 11 = 0 THEN 'purchase'
             WHEN source = 'view' THEN 'autoscout24' WHEN source = 'click' THEN 'aramisauto' ELSE source END AS source,
        CASE WHEN source = 'view' THEN 'autoscout24' WHEN source = 'click' THEN 'aramisauto' ELSE source END AS psource
      FROM s0),
pr AS (SELECT lien_annonce AS lien,
         CAST(CASE id % 6 WHEN 0 THEN 404 WHEN 1 THEN 500 WHEN 2 THEN NULL ELSE 200 END AS INTEGER) AS status,
         CASE WHEN id % 6 = 3 THEN lien_annonce || '/moved' ELSE lien_annonce END AS final_url,
         CASE WHEN id % 6 = 4 THEN 'annonce n''est malheureusement plus disponible' ELSE 'ok' END AS html,
         CASE WHEN id % 6 <= 1 THEN 'http' WHEN id % 6 = 2 THEN 'url' END AS error
       FROM s WHERE id % 9 <> 4),
picked AS (SELECT * FROM s WHERE NOT is_expired AND last_seen_at < TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY
           AND source IN ('autoscout24', 'aramisauto', 'purchase') ORDER BY last_seen_at, id LIMIT 200),
j AS (SELECT picked.*, pr.lien IS NULL AS missing, pr.status AS st, pr.final_url, pr.html, pr.error,
        lien_annonce IS NULL OR lien_annonce = '' OR source NOT IN ('autoscout24', 'aramisauto') AS skip
      FROM picked LEFT JOIN pr ON picked.lien_annonce = pr.lien),
r AS (SELECT *, CASE WHEN error = 'url' THEN 'url_error'
       WHEN error = 'other' THEN 'erreur_inconnue'
       WHEN (error = 'http' OR (error IS NULL AND st >= 400)) AND st IN (404, 410) THEN 'x:http_' || st
       WHEN (error = 'http' OR (error IS NULL AND st >= 400)) THEN 'http_' || st || '_ambigu'
       WHEN source = 'autoscout24' THEN
         CASE WHEN contains(coalesce(html, ''), 'n''est malheureusement plus disponible') THEN 'x:texte_expiration'
              WHEN regexp_replace(split_part(final_url, '?', 1), '/+$', '')
                   <> regexp_replace(split_part(lien_annonce, '?', 1), '/+$', '') THEN 'x:url_redirect'
              ELSE 'active' END
       WHEN source = 'aramisauto' THEN
         CASE WHEN contains(coalesce(final_url, ''), 'vehicle-not-available') THEN 'x:url_redirect' ELSE 'active' END
       ELSE 'source_inconnue' END AS rr FROM j)
SELECT id, lien_annonce, source, CASE WHEN skip THEN 'skipped' WHEN missing THEN 'not_probed' ELSE 'checked' END AS status,
       CASE WHEN NOT skip AND NOT missing THEN starts_with(rr, 'x:') END AS expired,
       CASE WHEN NOT skip AND NOT missing THEN regexp_replace(rr, '^x:', '') END AS reason,
       CASE WHEN NOT skip AND NOT missing AND starts_with(rr, 'x:') THEN 'http_check:' || substr(rr, 3) END AS expire_reason
FROM r
"""
HTTP_EXPIRY_SQL = _http_expiry_sql("LIMIT 200")
RUN_COUNTERS_SQL = f"""
WITH h AS ({_http_expiry_sql("")})
SELECT CAST(count(*) FILTER (WHERE status = 'checked') AS BIGINT) AS checked,
       CAST(count(*) FILTER (WHERE expired) AS BIGINT) AS expired,
       CAST(count(*) FILTER (WHERE status = 'checked' AND NOT expired AND reason <> 'active') AS BIGINT) AS unclear,
       CAST(count(*) FILTER (WHERE status = 'skipped') AS BIGINT) AS skipped,
       CAST(count(*) FILTER (WHERE status = 'not_probed') AS BIGINT) AS not_probed
FROM h
"""

EXPIRY_FLAGS_SQL = f"""
WITH h AS ({_http_expiry_sql("")}),
s0 AS ({sql_store_from_events()}),
s AS (SELECT id, lien_annonce, last_seen_at, is_expired,
        CASE WHEN id % 11 = 0 THEN 'purchase'
             WHEN source = 'view' THEN 'autoscout24' WHEN source = 'click' THEN 'aramisauto' ELSE source END AS source
      FROM s0),
t AS (SELECT id FROM s
      WHERE NOT is_expired AND source = 'autoscout24' AND last_seen_at < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY),
x AS (SELECT id, expire_reason FROM h WHERE expired)
SELECT s.id, s.lien_annonce, s.source, x.id IS NOT NULL OR t.id IS NOT NULL OR s.is_expired AS is_expired,
       CASE WHEN x.id IS NOT NULL THEN x.expire_reason WHEN t.id IS NOT NULL THEN 'lbc_ttl:7j' END AS expire_reason
FROM s LEFT JOIN x ON s.id = x.id LEFT JOIN t ON s.id = t.id
"""

QUERIES = {
    "expiry_flags": (expiry_flags, EXPIRY_FLAGS_SQL),
    "run_counters": (run_counters_q, RUN_COUNTERS_SQL),
    "dedup_first": (dedup_first, DEDUP_FIRST_SQL),
    "upsert_touched": (upsert_touched, UPSERT_LATEST_SQL),
    "upsert_latest": (upsert_latest, UPSERT_LATEST_SQL),
    "insert_absent": (insert_absent_q, INSERT_ABSENT_SQL),
    "patch_changed": (patch_changed, PATCH_CHANGED_SQL),
    "stale_topn": (stale_topn, STALE_TOPN_SQL),
    "ttl_expire": (ttl_expire, TTL_EXPIRE_SQL),
    "gate_report": (gate_report_q, GATE_REPORT_SQL),
    "probe_classify": (probe_classify, PROBE_CLASSIFY_SQL),
    "sheet_prune": (sheet_prune_q, SHEET_PRUNE_SQL),
    "http_expiry": (http_expiry, HTTP_EXPIRY_SQL),
}
