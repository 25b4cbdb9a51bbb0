"""Bindings of the source loads (K14, K15, E18): pages of generated cards.

Each ``part`` row is a card, twenty a page, pages dealt to three crawls; every 31st page is
blocked, every 37th has no card. Every 23rd card holds what an HTML parser can't read, and every
17th of layout 1 has a price that is none. The oracle states each card's values directly, not its
HTML.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carlot.operators.lifecycle import renormalize_backfill
from carlot.operators.load import crawl, crawled_listings, load_into_store, one_page_load, source_load, store_rows
from carlot.operators.store import patch_rows, split_rejects, upsert_rows
from carlot.plans.common import AS_OF, BASE_URL, table
from carlot.plans.resolve_queries import (RENORMALIZE_BACKFILL_SQL, SQL_CATALOG, part_catalog, part_generations, renormalize_store,
                                          sql_model_resolution, sql_slug)
from carlot.plans.scalar_queries import _sql_title
from carlot.plans.store_queries import PART_CHANGES_SQL, UPSERT_COUNTS_SQL, part_changes, part_store, upsert_run
from carlot.session import cut_lineage, shared_scratch_dir
from carlot.sources.sinks import latest_version, write_counted, write_rejects

FUELS = ["d", "b", "e3", "h", "x", ""]


#: What an HTML parser can't read, and what it says then.
UNREADABLE, UNREADABLE_REASON = "<![bad[ x ]]>", "carte_illisible: AssertionError: unknown status keyword 'bad' in marked section"


def _flaw():
    return F.when(F.col("p_partkey") % 23 == 5, F.lit(UNREADABLE)).otherwise(F.lit(""))


def _guid():
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad((F.col("p_partkey") % 1500).cast("string"), 12, "0"))


def _page(p, card):
    n = F.floor(F.col("p_partkey") / 20).cast("int")
    body = p.groupBy(n.alias("n")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", card.alias("c")))).alias("cards"))
    inner = F.array_join(F.transform("cards", lambda x: x["c"]), "\n")
    html = (F.when(F.col("n") % 31 == 30, F.concat(F.lit("<p>Access denied</p>"), inner))
            .when(F.col("n") % 37 == 36, F.lit("<p>nothing here</p>")).otherwise(inner))
    return body.select((F.col("n") % 3).cast("string").alias("crawl"), (F.floor(F.col("n") / 3) + 1).cast("int").alias("page_num"),
                       F.concat(F.lit("<html><body>"), html, F.lit("</body></html>")).alias("html"))


def layout1_pages(spark, sf):
    p = table(spark, sf, "part")
    fuel = F.element_at(F.array(*[F.lit(x) for x in FUELS]), (F.col("p_size") % 6 + 1).cast("int"))
    attr = lambda name, value: F.concat(F.lit(f' data-{name}="'), value.cast("string"), F.lit('"'))
    odd = F.col("p_partkey") % 5 == 0  # no price, mileage or registration
    card = F.concat(
        F.lit("<article"), attr("guid", _guid()), attr("make", F.lower("p_type")), attr("model", F.col("p_name")),
        F.when(odd, F.lit("")).otherwise(F.concat(
            attr("price", F.when(F.col("p_partkey") % 17 == 4, F.lit("1.2.3")).otherwise(F.floor("p_retailprice").cast("string"))), attr("mileage", F.col("p_partkey") * 7 % 200000),
            attr("first-registration", F.concat(F.lpad((F.col("p_size") % 12 + 1).cast("string"), 2, "0"), F.lit("-"),
                                                (F.lit(2010) + F.col("p_size") % 15).cast("string"))))),
        attr("fuel-type", fuel), F.lit("><h2>"), F.col("p_type"), F.lit(" "), F.col("p_name"), F.lit("</h2><p> Version\t"),
        F.col("p_brand"), F.lit("</p>"), _flaw(), F.lit('<img src="/i/'), F.col("p_partkey").cast("string"), F.lit('.jpg"></article>'),
        F.when(F.col("p_partkey") % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit('<a href="/offres/v-'), F.col("p_size").cast("string"), F.lit("-"), _guid(), F.lit('?page=1">more</a>'))))
    return _page(p, card)


def layout2_pages(spark, sf):
    p = table(spark, sf, "part")
    lines = F.array(F.lit("Disponible"), F.col("p_type"), F.concat(F.col("p_name"), F.lit("  L")), F.lit("Finition X"),
                    F.when(F.col("p_size") % 2 == 0, "Essence").otherwise("Diesel"), F.lit("Boîte manuelle"), F.lit("•"),
                    (F.lit(2010) + F.col("p_size") % 15).cast("string"), F.concat((F.col("p_partkey") * 7 % 200000).cast("string"), F.lit(" km")),
                    F.lit("199 €/mois"), F.concat(F.floor("p_retailprice").cast("string"), F.lit(" €")), F.lit("99 999 €"))
    text = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    # some cards have an empty link, or one that leads nowhere
    href = F.when(F.col("p_partkey") % 50 == 3, F.lit("")).when(F.col("p_partkey") % 50 == 4, F.lit("#")).otherwise(
        F.concat(F.lit("/v/"), (F.col("p_partkey") % 1500).cast("string"), F.lit("?from=list")))
    card = F.concat(
        F.lit('<a class="card product-card" href="'), href, F.lit('" makerid="'), F.lower("p_type"),
        F.lit('" modelid="'), F.col("p_name"), F.lit('"><span>ignored</span>'), _flaw(), F.lit('<div class="product-card-content-wrapper">'), text,
        F.lit("</div></a>"))
    return _page(p, card)


def _load(spark, sf, layout, fn=source_load, **kw):
    pages = (layout1_pages if layout == 1 else layout2_pages)(spark, sf)
    return fn(pages, layout, part_catalog(spark, sf), BASE_URL, f"layout{layout}", gens=part_generations(spark, sf),
              seen_at=F.lit(AS_OF).cast("timestamp_ntz"), **kw)


def source_load_layout1(spark, sf):
    """K14, layout 1, links by guid."""
    return _load(spark, sf, 1, links_by_guid=True)


def source_load_layout2(spark, sf):
    """K14, layout 2."""
    return _load(spark, sf, 2)


def one_page(spark, sf):
    """K15 — all cards of the first page of each crawl, links made from the card's own values."""
    return _load(spark, sf, 1, fn=one_page_load)


def load_rejects(spark, sf):
    """D15, B3 — cards that can't be read and listings that can't be typed, beside the good ones."""
    return crawl(layout1_pages(spark, sf), 1, BASE_URL, "layout1", links_by_guid=True).rejects


def write_counters(spark, sf):
    """F6 — the counters of writes: an upsert (with rejected rows), a patch, a backfill, and the same
    load twice, each into a table of its own."""
    runs, base = [], shared_scratch_dir(spark, "write-counters")

    def counted(run, rows, rejects=None):
        errors = write_rejects(rejects, f"{base}/{run}-rejects") if rejects is not None else 0
        runs.append((run, write_counted(rows, f"{base}/{run}") | {"errors": errors}))

    store, batch, order, checks = upsert_run(spark, sf)
    good, bad = split_rejects(batch, checks)
    counted("upsert", upsert_rows(store, good, "lien_annonce", batch_order=order), bad)
    counted("patch", patch_rows(part_store(spark, sf), part_changes(spark, sf), "id", ["modele_unifie"]))
    old = renormalize_store(spark, sf)
    counted("backfill", patch_rows(old, renormalize_backfill(old, part_catalog(spark, sf)).drop("old"), "id", ["modele_unifie"]))
    crawled = crawl(layout2_pages(spark, sf), 2, BASE_URL, "layout2")
    rows = cut_lineage(store_rows(crawled.listings, 2, part_catalog(spark, sf), seen_at=F.lit(AS_OF).cast("timestamp_ntz"), fuzzy=False, dedup=False))
    for run in ("load", "load_again"):
        runs.append((run, load_into_store(rows, f"{base}/listings", crawled.rejects)))
    columns = ["sent", "inserted", "updated", "unchanged", "kept", "errors"]
    return spark.createDataFrame([(run, *(found[c] for c in columns)) for run, found in runs],
                                 "run string, " + ", ".join(f"{c} long" for c in columns))


def guid_links_q(spark, sf):
    """E18 — the link of every card within the crawls."""
    listings = crawled_listings(layout1_pages(spark, sf), 1, BASE_URL, "layout1", links_by_guid=True)
    return listings.select("crawl", "page_num", "card_pos", "lien")


def load_twice(spark, sf):
    """K14 with its sink: a load of first pages, then the whole load, into one versioned store."""
    base = shared_scratch_dir(spark, "load-store")
    load_into_store(_load(spark, sf, 2, fn=one_page_load), base)
    load_into_store(_load(spark, sf, 2), base)
    return latest_version(spark, base)


def _sql_rows(layout: int, max_pages: int | None = None, by_guid: bool = True) -> str:
    limit = f"AND page_num <= {max_pages}" if max_pages else ""
    guid = "'00000000-0000-4000-8000-' || lpad(CAST(p_partkey % 1500 AS VARCHAR), 12, '0')"
    made = f"'{BASE_URL}/offres/' || replace(lower(p_type), ' ', '-') || '-' || replace(lower(p_name), ' ', '-') || '-' || {guid}"
    if layout == 1:
        # the page's first anchor with the guid; without one the link is made from the card
        link = f"""CASE WHEN a.size IS NOT NULL THEN '{BASE_URL}/offres/v-' || a.size || '-' || {guid} ELSE {made} END""" if by_guid else made
        fields = f"""{_sql_title("lower(p_type)")} AS marque, upper(p_name) AS modele, p_type || ' ' || p_name || ' Version ' || p_brand AS titre,
          CASE WHEN p_partkey % 5 <> 0 THEN CAST(floor(p_retailprice) AS DOUBLE) END AS prix,
          CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey * 7 % 200000 AS DOUBLE) END AS kilometrage,
          CASE WHEN p_partkey % 5 <> 0 THEN lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') || '/' || CAST(2010 + p_size % 15 AS VARCHAR) ELSE 'N/A' END AS date_voiture,
          CASE WHEN p_partkey % 5 <> 0 THEN CAST(2010 + p_size % 15 AS VARCHAR) ELSE 'N/A' END AS annee,
          CASE p_size % 6 WHEN 0 THEN 'Diesel' WHEN 1 THEN 'Essence' WHEN 2 THEN 'Hybride rechargeable (Électrique)' WHEN 3 THEN 'Hybride'
               WHEN 4 THEN 'X' ELSE 'N/A' END AS carburant,
          '/i/' || p_partkey || '.jpg' AS image, {link} AS lien"""
    else:
        fields = f"""{_sql_title("lower(p_type)")} AS marque, upper(p_name) AS modele, p_type || ' ' || p_name || ' L' AS titre,
          CAST(floor(p_retailprice) AS DOUBLE) AS prix, CAST(p_partkey * 7 % 200000 AS DOUBLE) AS kilometrage,
          CAST(2010 + p_size % 15 AS VARCHAR) AS date_voiture, CAST(2010 + p_size % 15 AS VARCHAR) AS annee,
          CASE WHEN p_size % 2 = 0 THEN 'Essence' ELSE 'Diesel' END AS carburant, '' AS image,
          CASE WHEN p_partkey % 50 IN (3, 4) THEN 'N/A' ELSE '{BASE_URL}/v/' || CAST(p_partkey % 1500 AS VARCHAR) END AS lien"""
    return f"""
pp0 AS (SELECT *, p_partkey // 20 AS n FROM part),
pp AS (SELECT *, n % 3 AS crawl, n // 3 + 1 AS page_num, p_partkey - n * 20 AS card_pos FROM pp0),
stops AS (SELECT crawl, min(page_num) AS stop FROM pp WHERE (n % 31 = 30 OR n % 37 = 36) {limit} GROUP BY crawl),
anchors AS (SELECT n, p_partkey % 1500 AS g, arg_min(CAST(p_size AS VARCHAR), p_partkey) AS size FROM pp WHERE p_partkey % 4 <> 0 GROUP BY ALL),
seen AS (SELECT pp.p_partkey AS o, CAST(pp.crawl AS VARCHAR) AS crawl, CAST(pp.page_num AS INTEGER) AS page_num, CAST(card_pos AS INTEGER) AS card_pos, {fields},
         p_partkey % 23 = 5 AS unreadable, {'p_partkey % 17 = 4 AND p_partkey % 5 <> 0' if layout == 1 else 'false'} AS untyped
       FROM pp LEFT JOIN stops s ON pp.crawl = s.crawl LEFT JOIN anchors a ON a.n = pp.n AND a.g = pp.p_partkey % 1500
       WHERE (s.stop IS NULL OR pp.page_num < s.stop) {limit.replace('page_num', 'pp.page_num')}),
li AS (SELECT * FROM seen WHERE NOT unreadable AND NOT untyped)"""


def _sql_load(layout: int, max_pages: int | None = None, by_guid: bool = True, dedup: bool = True) -> str:
    order = "crawl, page_num, card_pos" if layout == 1 else "crawl DESC, page_num DESC, card_pos DESC"  # the first, or the last
    return f"""
WITH RECURSIVE {SQL_CATALOG},{_sql_rows(layout, max_pages, by_guid)},
{sql_model_resolution("SELECT marque AS raw_make, modele AS raw_model FROM li")},
k1 AS (SELECT li.*, coalesce(res.model, li.modele) AS modele_unifie FROM li
       LEFT JOIN res ON li.marque IS NOT DISTINCT FROM res.raw_make AND li.modele = res.raw_model),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lien ORDER BY {order}) AS rn FROM k1) x WHERE {'rn = 1' if dedup else 'true'}),
pg AS (SELECT upper(p_name) AS model, 2010 + min(p_size) % 5 AS y FROM part GROUP BY 1),
piv AS (SELECT model, 1 AS gpos, model || ' 1' AS gen, y AS f, y + 3 AS t FROM pg
        UNION ALL SELECT model, 2, model || ' 2', y + 3, y + 6 FROM pg UNION ALL SELECT model, 3, model || ' 3', y + 8, 9999 FROM pg),
gsl AS (SELECT {sql_slug('model')} AS s, min(model) AS model FROM pg GROUP BY 1),
gp AS (SELECT f.o, coalesce(ek.model, sk.model) AS k2, TRY_CAST(substr(f.annee, 1, 4) AS INTEGER) AS yr FROM f
       LEFT JOIN pg ek ON ek.model = upper(trim(f.modele_unifie)) LEFT JOIN gsl sk ON sk.s = {sql_slug('upper(trim(f.modele_unifie))')}),
gr AS (SELECT gp.o, arg_min(piv.gen, piv.gpos) AS gen FROM gp JOIN piv ON piv.model = gp.k2 AND gp.yr BETWEEN piv.f AND piv.t GROUP BY gp.o)
SELECT titre, prix, kilometrage, date_voiture, marque, modele, modele_unifie, coalesce(gr.gen, 'N/A') AS generation, carburant,
       f.lien AS lien_annonce, image AS lien_image, 'layout{layout}' AS source, TIMESTAMP '{AS_OF}' AS last_seen_at{'' if dedup else ', crawl, page_num, card_pos'}
FROM f LEFT JOIN gr ON f.o = gr.o
"""


LOAD_REJECTS_SQL = f"""
WITH {_sql_rows(1)[1:]}
SELECT crawl, page_num, card_pos, CASE WHEN unreadable THEN NULL ELSE lien END AS lien,
       CASE WHEN unreadable THEN '{UNREADABLE_REASON.replace("'", "''")}' ELSE 'prix_illisible' END AS reason
FROM seen WHERE unreadable OR untyped
"""

WRITE_COUNTERS_SQL = f"""
WITH {_sql_rows(2)[1:]},
u AS ({UPSERT_COUNTS_SQL}),
c AS (SELECT CAST(count(*) AS BIGINT) AS n FROM ({RENORMALIZE_BACKFILL_SQL}) r),
p AS (SELECT CAST(count(*) AS BIGINT) AS n FROM part),
pc AS (SELECT CAST(count(*) AS BIGINT) AS n FROM ({PART_CHANGES_SQL}) q),
l AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT lien) AS BIGINT) AS links FROM li),
bad AS (SELECT CAST(count(*) AS BIGINT) AS n FROM seen WHERE unreadable)
SELECT 'upsert' AS run, sent, inserted, updated, unchanged, kept, errors FROM u
UNION ALL SELECT 'patch', pc.n, 0, pc.n, 0, p.n - pc.n, 0 FROM pc, p
UNION ALL SELECT 'backfill', c.n, 0, c.n, 0, p.n - c.n, 0 FROM c, p
UNION ALL SELECT 'load', l.n, l.links, 0, 0, 0, bad.n FROM l, bad
UNION ALL SELECT 'load_again', l.n, 0, 0, l.links, 0, bad.n FROM l, bad
"""


QUERIES = {
    "source_load_layout1": (source_load_layout1, _sql_load(1)),
    "source_load_layout2": (source_load_layout2, _sql_load(2)),
    "one_page_load": (one_page, _sql_load(1, 1, by_guid=False, dedup=False)),
    "load_rejects": (load_rejects, LOAD_REJECTS_SQL),
    "write_counters": (write_counters, WRITE_COUNTERS_SQL),
    "guid_links": (guid_links_q, f"WITH {_sql_rows(1)[1:]} SELECT crawl, page_num, card_pos, lien FROM li"),
    "load_twice": (load_twice, _sql_load(2)),
}
