"""Bindings of dump ingest.

Dump items are built from ``part`` rows as open JSON-like string records: a title,
four ``text-body-2*`` candidate fields (a year, a mileage, a fuel word, noise), two
price fields and links. Brand lists for the title parser are derived from the same
table (types as brands, first name words as model words).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carlot.functions.text import title_case
from carlot.operators.ingest import (best_roles, brand_model_from_title, detect_roles, dump_rows, field_role_scores,
                                     import_dump)
from carlot.plans.common import AS_OF, table
from carlot.plans.scalar_queries import _sql_title
from carlot.session import cut_lineage

CANDS = ["text-body-2a", "text-body-2b", "text-body-2c", "text-body-2d"]


def _title(p):
    k = F.col("p_size") % 4
    t = title_case(F.lower("p_type"))
    return (F.when(k == 0, F.concat(F.lit("Vends "), t, F.lit(" "), F.col("p_name")))
            .when(k == 1, F.concat(t, F.col("p_name")))
            .when(k == 2, F.col("p_name"))
            .otherwise(F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"))))


def dump_items(spark, sf):
    p = table(spark, sf, "part")
    price = F.concat(F.regexp_replace(F.format_number(F.floor("p_retailprice").cast("long"), 0), ",", " "),
                     F.lit(" €"))
    return p.select(
        "p_partkey",
        _title(p).alias("text-body-1"),
        F.when(F.col("p_size") <= 45, (F.lit(1990) + F.col("p_size") % 35).cast("string")).alias("text-body-2a"),
        F.concat(((F.col("p_partkey") * 7) % 200000).cast("string"), F.lit(" km")).alias("text-body-2b"),
        F.when(F.col("p_type") == "ECONOMY", "Diesel").when(F.col("p_type") == "SMALL", "Essence")
        .otherwise(F.col("p_type")).alias("text-body-2c"),
        F.col("p_brand").alias("text-body-2d"),
        F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(price).alias("text-callout"),
        price.alias("text-success"),
        F.concat(F.lit("https://dump.example/ad/"), (F.col("p_partkey") % 1500).cast("string")).alias("absolute href"),
        F.concat(F.lit("https://img.example/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("absolute src"))


SQL_ITEMS = """
  SELECT p_partkey,
    CASE p_size % 4 WHEN 0 THEN 'Vends ' || {t} || ' ' || p_name WHEN 1 THEN {t} || p_name
         WHEN 2 THEN p_name ELSE p_brand || ' ' || p_name END AS "text-body-1",
    CASE WHEN p_size <= 45 THEN CAST(1990 + p_size % 35 AS VARCHAR) END AS "text-body-2a",
    CAST((p_partkey * 7) % 200000 AS VARCHAR) || ' km' AS "text-body-2b",
    CASE p_type WHEN 'ECONOMY' THEN 'Diesel' WHEN 'SMALL' THEN 'Essence' ELSE p_type END AS "text-body-2c",
    p_brand AS "text-body-2d"
  FROM part
""".format(t=_sql_title("lower(p_type)"))


def field_roles(spark, sf):
    """F1 — per candidate field: non-empty values and year / km / fuel hits."""
    return field_role_scores(dump_items(spark, sf))


_SQL_SCORES = f"""
WITH items AS ({SQL_ITEMS}),
l AS (SELECT field, trim(raw) AS v FROM (UNPIVOT (SELECT {", ".join(f'"{c}"' for c in CANDS)} FROM items)
        ON {", ".join(f'"{c}"' for c in CANDS)} INTO NAME field VALUE raw) u WHERE raw IS NOT NULL AND raw <> ''),
sc AS (SELECT field, CAST(count(*) AS BIGINT) AS total,
         CAST(count(*) FILTER (WHERE regexp_matches(regexp_replace(v, '[^0-9]', '', 'g'), '^[0-9]{{4}}$')
               AND TRY_CAST(regexp_replace(v, '[^0-9]', '', 'g') AS INTEGER) BETWEEN 1990 AND 2030) AS BIGINT) AS annee,
         CAST(count(*) FILTER (WHERE contains(lower(v), 'km')) AS BIGINT) AS km,
         CAST(count(*) FILTER (WHERE contains(lower(v), 'diesel') OR contains(lower(v), 'essence')
               OR contains(lower(v), 'hybride') OR contains(lower(v), 'électrique') OR contains(lower(v), 'electrique')
               OR contains(lower(v), 'gpl') OR contains(lower(v), 'gaz') OR contains(lower(v), 'hydrogène')) AS BIGINT)
           AS carburant
       FROM l GROUP BY field)"""

FIELD_ROLES_SQL = _SQL_SCORES + "\nSELECT * FROM sc"


def field_role_pick(spark, sf):
    """F2 — per role the field with the best hit ratio (ties → smallest name)."""
    return best_roles(field_role_scores(dump_items(spark, sf)))


FIELD_ROLE_PICK_SQL = _SQL_SCORES + """,
r AS (SELECT field, total, 'annee' AS role, annee AS hits FROM sc UNION ALL
      SELECT field, total, 'km', km FROM sc UNION ALL SELECT field, total, 'carburant', carburant FROM sc),
b AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY hits / greatest(total, 1) DESC, field) AS rn FROM r)
SELECT role, field, hits FROM b WHERE rn = 1 AND hits > 0
"""


def title_brand_tables(spark, sf):
    p = table(spark, sf, "part")
    b = p.select(title_case(F.lower("p_type")).alias("brand")).distinct()
    # priority = longest brand first, then by name: a sortable key, no ranking window
    brands = b.select(F.struct((-F.length("brand")).alias("neg_len"), F.col("brand").alias("name")).alias("priority"),
                      "brand",
                      F.lower("brand").alias("brand_lower"), F.length("brand").alias("blen"),
                      F.when(F.length("brand") <= 5, F.upper("brand")).otherwise(F.col("brand")).alias("canonical"))
    words = p.groupBy(F.lower(F.split("p_name", " ").getItem(0)).alias("word")).agg(
        title_case(F.lower(F.min("p_type"))).alias("word_brand"))
    return brands, words


def brand_from_title(spark, sf):
    """J25 — noise prefix, brand prefix by priority, else first word → brand."""
    p = table(spark, sf, "part")
    brands, words = title_brand_tables(spark, sf)
    t = p.select("p_partkey", _title(p).alias("titre"))
    return brand_model_from_title(t, "titre", brands, words).select("p_partkey", "marque", "modele")


BRAND_FROM_TITLE_SQL = """
WITH br0 AS (SELECT DISTINCT {t} AS brand FROM part),
br AS (SELECT brand, row_number() OVER (ORDER BY length(brand) DESC, brand) - 1 AS priority, lower(brand) AS bl,
              length(brand) AS blen, CASE WHEN length(brand) <= 5 THEN upper(brand) ELSE brand END AS canonical
       FROM br0),
wd AS (SELECT lower(split_part(p_name, ' ', 1)) AS w, {tmin} AS wb FROM part GROUP BY 1),
t0 AS (SELECT p_partkey, trim(CASE p_size % 4 WHEN 0 THEN 'Vends ' || {t} || ' ' || p_name WHEN 1 THEN {t} || p_name
         WHEN 2 THEN p_name ELSE p_brand || ' ' || p_name END) AS t FROM part),
t1 AS (SELECT p_partkey, CASE WHEN regexp_matches(lower(t), '^(vend |vends |voiture |belle |beau |magnifique |superbe |urgent |urgence )')
         THEN trim(regexp_replace(t, '^(vend |vends |voiture |belle |beau |magnifique |superbe |urgent |urgence )', '', 'i'))
         ELSE t END AS t FROM t0),
m AS (SELECT t1.p_partkey, arg_min(br.canonical, br.priority) AS canonical, arg_min(br.blen, br.priority) AS blen
      FROM t1 JOIN br ON starts_with(lower(t1.t), br.bl) GROUP BY t1.p_partkey)
SELECT t1.p_partkey,
       CASE WHEN m.canonical IS NOT NULL THEN m.canonical ELSE wd.wb END AS marque,
       CASE WHEN m.canonical IS NOT NULL THEN
              CASE WHEN trim(substr(t1.t, m.blen + 1)) <> '' THEN split_part(trim(substr(t1.t, m.blen + 1)), ' ', 1) ELSE '' END
            WHEN trim(t1.t) <> '' THEN split_part(t1.t, ' ', 1) END AS modele
FROM t1 LEFT JOIN m ON t1.p_partkey = m.p_partkey
LEFT JOIN wd ON wd.w = split_part(lower(t1.t), ' ', 1)
""".format(t=_sql_title("lower(p_type)"), tmin=_sql_title("lower(min(p_type))"))


def dump_import(spark, sf):
    """K13 — detect field roles, type the items, insert the ones whose link is new.

    The store holds what an earlier import of every seventh item produced; within the
    batch the first item (by part key) per link wins."""
    items = dump_items(spark, sf).withColumn("_pos", F.regexp_extract("absolute src", r"/(\d+)\.jpg$", 1).cast("long"))
    brands, words = title_brand_tables(spark, sf)
    seen = F.lit(AS_OF).cast("timestamp_ntz")
    roles = detect_roles(items)
    earlier = dump_rows(items.where(F.col("_pos") % 7 == 0), roles, brands, words, seen_at=seen)
    _, inserted = import_dump(cut_lineage(earlier.drop("_pos")), items, brands, words, seen_at=seen, mapping=roles)
    return inserted


# The oracle states the detected mapping (2a = year, 2b = mileage, 2c = fuel); the
# detection itself is checked by ``field_role_pick``.
DUMP_IMPORT_SQL = f"""
WITH bt AS ({BRAND_FROM_TITLE_SQL}),
r AS (
  SELECT p.p_partkey AS o,
         trim(CASE p_size % 4 WHEN 0 THEN 'Vends ' || {{t}} || ' ' || p_name WHEN 1 THEN {{t}} || p_name
              WHEN 2 THEN p_name ELSE p_brand || ' ' || p_name END) AS titre,
         CAST(floor(p_retailprice) AS BIGINT) AS prix,
         CAST((p.p_partkey * 7) % 200000 AS BIGINT) AS kilometrage,
         CAST(1990 + p_size % 35 AS VARCHAR) AS date_voiture,
         bt.marque, bt.modele, bt.modele AS modele_unifie,
         'https://dump.example/ad/' || CAST(p.p_partkey % 1500 AS VARCHAR) AS lien_annonce,
         'https://img.example/' || CAST(p.p_partkey AS VARCHAR) || '.jpg' AS lien_image,
         'leboncoin' AS source,
         CASE p_type WHEN 'ECONOMY' THEN 'Diesel' WHEN 'SMALL' THEN 'Essence' ELSE p_type END AS carburant,
         true AS is_active, TIMESTAMP '{AS_OF}' AS last_seen_at
  FROM part p JOIN bt ON p.p_partkey = bt.p_partkey
  WHERE p_size <= 45),
v AS (SELECT * FROM r WHERE prix IS NOT NULL AND prix <> 0 AND kilometrage IS NOT NULL AND kilometrage <> 0
        AND marque IS NOT NULL AND marque <> ''),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lien_annonce ORDER BY o) AS rn FROM v) x WHERE rn = 1)
SELECT titre, prix, kilometrage, date_voiture, marque, modele, modele_unifie, lien_annonce, lien_image, source,
       carburant, is_active, last_seen_at
FROM f WHERE lien_annonce NOT IN (SELECT lien_annonce FROM v WHERE o % 7 = 0)
""".replace("{t}", _sql_title("lower(p_type)"))

QUERIES = {
    "field_roles": (field_roles, FIELD_ROLES_SQL),
    "field_role_pick": (field_role_pick, FIELD_ROLE_PICK_SQL),
    "brand_from_title": (brand_from_title, BRAND_FROM_TITLE_SQL),
    "dump_import": (dump_import, DUMP_IMPORT_SQL),
}
