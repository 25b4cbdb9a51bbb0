"""Bindings of the resolution cascade.

Catalogue = ``part``: makes are the distinct ``p_type`` values, models the distinct
``p_name`` per type, both ordered by first ``p_partkey``. Make aliases are derived by
rule (first three letters of the make). Inputs are perturbed copies of the same
columns so that every stage of the cascade is exercised. Generation catalogue =
intervals derived from ``orders`` per order priority (overlapping ends and a gap).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carlot.functions.codes import MAKE_FUZZY_CUTOFF, MODEL_FUZZY_CUTOFF
from carlot.operators.quality import catalogue_coverage, coverage, distinct_misses
from carlot.operators.resolve import generation_backfill as generation_backfill_op
from carlot.operators.resolve import generation_reindex as generation_reindex_op
from carlot.operators.resolve import lookup_generation, resolve_listings, resolve_makes, resolve_models
from carlot.plans.common import sql_ws, table
from carlot.session import cut_lineage
from carlot.sources.catalog import catalog_from_long

WS = sql_ws()


def sql_slug(expr: str) -> str:
    return f"trim(regexp_replace(replace(strip_accents(lower({expr})), '/', ' '), '(?:[-_]|{WS})+', ' ', 'g'))"


# ── catalogue and inputs ──

def part_catalog(spark, sf):
    p = table(spark, sf, "part")
    cat = catalog_from_long(p, "p_type", "p_name", "p_partkey")
    # catalogue tables are read by every stage and size check: derive them from the
    # source table once (reliable checkpoint in the shared folder)
    cat.makes = cut_lineage(cat.makes)
    cat.models = cut_lineage(cat.models)
    cat.aliases = cat.makes.select(F.lower(F.substring("make", 1, 3)).alias("alias_slug"), F.col("make").alias("target"))
    return cat


def _make_inputs(p):
    k = F.col("p_size") % 6  # some makes are thousands of characters long
    return (F.when(F.col("p_size") == 35, F.concat(F.repeat(F.lit("unknown make "), F.lit(400)), F.col("p_type"), F.lit(" x")))
            .when(k == 0, F.col("p_type"))
            .when(k == 1, F.concat(F.lower("p_type"), F.lit("-")))
            .when(k == 2, F.substring("p_type", 1, 4))
            .when(k == 3, F.concat(F.col("p_type"), F.lit(" Motors")))
            .when(k == 4, F.lower(F.substring("p_type", 1, 3)))
            .otherwise(F.concat(F.lit("Unknown "), F.col("p_size").cast("string"))))


SQL_MAKE_INPUT = """CASE WHEN p_size = 35 THEN repeat('unknown make ', 400) || p_type || ' x' ELSE CASE p_size % 6 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) || '-'
    WHEN 2 THEN substr(p_type, 1, 4) WHEN 3 THEN p_type || ' Motors' WHEN 4 THEN lower(substr(p_type, 1, 3))
    ELSE 'Unknown ' || CAST(p_size AS VARCHAR) END END"""


def _model_inputs(p, missing_makes: bool = False):
    """Makes and models as listings write them; with ``missing_makes`` some have no make at all."""
    k = F.col("p_size") % 5
    model = (F.when(k == 0, F.col("p_name"))
             .when(k == 1, F.regexp_replace("p_name", " ", ""))
             .when(k == 2, F.concat(F.col("p_name"), F.lit(" xl")))
             .when(k == 3, F.expr("substring(p_name, 1, length(p_name) - 2)"))
             .otherwise(F.upper(F.regexp_replace("p_name", " ", "-"))))
    make = F.when(F.col("p_size") >= 48, F.lit("Nomake")).otherwise(F.col("p_type"))
    if missing_makes:
        make = F.when(F.col("p_size") != 46, make)
    return make, model


SQL_MODEL_INPUTS = """
  SELECT p_partkey, p_brand AS source,
         CASE WHEN p_size >= 48 THEN 'Nomake' ELSE p_type END AS raw_make,
         CASE p_size % 5 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '')
              WHEN 2 THEN p_name || ' xl' WHEN 3 THEN substr(p_name, 1, length(p_name) - 2)
              ELSE upper(replace(p_name, ' ', '-')) END AS raw_model
  FROM part
"""

SQL_MISSING_MAKES = f"SELECT p_partkey, source, CASE WHEN p_size <> 46 THEN raw_make END AS raw_make, raw_model FROM ({SQL_MODEL_INPUTS}) i JOIN part USING (p_partkey)"

SQL_CATALOG = f"""
cat_m AS (SELECT p_type AS make, min(p_partkey) AS o FROM part GROUP BY p_type),
mk AS (SELECT make, row_number() OVER (ORDER BY o) - 1 AS make_pos, {sql_slug('make')} AS mslug FROM cat_m),
mk_exact AS (SELECT mslug, arg_min(make, make_pos) AS m FROM mk GROUP BY mslug),
mk_by AS (SELECT mslug, min(make_pos) AS first_pos, arg_max(make, make_pos) AS make FROM mk GROUP BY mslug),
mk_alias AS (SELECT lower(substr(make, 1, 3)) AS alias_slug, max(make) AS target FROM mk GROUP BY 1),
cat_md AS (SELECT p_type AS make, p_name AS model, min(p_partkey) AS o FROM part GROUP BY ALL),
mm AS (SELECT make, model, row_number() OVER (PARTITION BY make ORDER BY o) - 1 AS model_pos,
              {sql_slug('model')} AS mslug FROM cat_md),
md_by AS (SELECT make, mslug, min(model_pos) AS first_pos, arg_max(model, model_pos) AS model FROM mm GROUP BY ALL),
md_ns AS (SELECT make, regexp_replace(mslug, '{WS}+', '', 'g') AS k, arg_max(model, first_pos) AS model
          FROM md_by GROUP BY ALL)"""


def _sql_longest_block(a: str, b: str) -> str:
    """Longest common substring of two texts as ``length * 1000 - start`` (0: none): the
    longest, then the one that starts first in ``a`` (texts under 1000 characters)."""
    return (f"coalesce(list_max(flatten(list_transform(range(1, len({a}) + 1), lambda i: list_transform("
            f"range(1, len({a}) - i + 2), lambda n: CASE WHEN strpos({b}, substr({a}, i, n)) > 0 THEN n * 1000 - i ELSE 0 END)))), 0)")


def sql_ratio(name: str, pairs: str) -> str:
    """CTE text ``name(a, b, ratio)``: Ratcliff-Obershelp similarity of the pairs.

    A work queue: each row is a pair of segments with its longest common block (first in
    ``a``, then in ``b``); what stands left and right of the block is queued in turn."""
    n, i = "((best + 999) // 1000)", "(((best + 999) // 1000) * 1000 - best)"
    j = f"strpos(y, substr(x, {i}, {n}))"
    return f"""
{name}_p AS (SELECT DISTINCT a, b FROM ({pairs}) z),
{name}_q AS (
  SELECT a, b, a AS x, b AS y, {_sql_longest_block('a', 'b')} AS best FROM {name}_p
  UNION ALL
  SELECT a, b, x, y, {_sql_longest_block('x', 'y')} AS best FROM (
    SELECT a, b, unnest([substr(x, 1, {i} - 1), substr(x, {i} + {n})]) AS x,
           unnest([substr(y, 1, {j} - 1), substr(y, {j} + {n})]) AS y
    FROM {name}_q WHERE best > 0) c
  WHERE x <> '' AND y <> ''),
{name} AS (SELECT a, b, 2.0 * sum((best + 999) // 1000) / (len(a) + len(b)) AS ratio
           FROM {name}_q GROUP BY a, b)"""


def sql_make_resolution(inputs: str, fuzzy: bool = True) -> str:
    """CTE text ``mres(raw_make, make, make_stage)`` over a query yielding ``raw_make``."""
    similar = f"""{sql_ratio("mr", """SELECT k.mslug AS a, ms.slug_in AS b FROM (SELECT DISTINCT slug_in FROM ms) ms, mk_by k
      WHERE ms.slug_in <> '' AND k.mslug <> '' AND 2.0 * least(len(k.mslug), len(ms.slug_in)) >= 0.79 * (len(k.mslug) + len(ms.slug_in))""")},
mz AS (SELECT mr.b AS slug_in, arg_max(k.make, (mr.ratio, k.mslug)) AS m FROM mr JOIN mk_by k ON k.mslug = mr.a
       WHERE mr.ratio >= {MAKE_FUZZY_CUTOFF} GROUP BY mr.b)""" if fuzzy else """
mz AS (SELECT '' AS slug_in, '' AS m WHERE false)"""
    return f"""
mi AS (SELECT DISTINCT raw_make FROM ({inputs}) q WHERE raw_make IS NOT NULL AND raw_make <> ''),
ms AS (SELECT raw_make, {sql_slug('raw_make')} AS slug_in FROM mi),
{similar.strip()},
mc AS (SELECT ms.slug_in, arg_min(b.make, b.first_pos) AS m FROM (SELECT DISTINCT slug_in FROM ms) ms
       JOIN mk_by b ON ms.slug_in <> '' AND (contains(ms.slug_in, b.mslug) OR contains(b.mslug, ms.slug_in))
       GROUP BY ms.slug_in),
mres AS (SELECT ms.raw_make, coalesce(e.m, a.target, z.m, c.m, ms.raw_make) AS make,
           CASE WHEN e.m IS NOT NULL THEN 'exact' WHEN a.target IS NOT NULL THEN 'alias'
                WHEN z.m IS NOT NULL THEN 'fuzzy' WHEN c.m IS NOT NULL THEN 'contains' END AS make_stage
         FROM ms LEFT JOIN mk_exact e ON ms.slug_in = e.mslug
                 LEFT JOIN mk_alias a ON ms.slug_in = a.alias_slug
                 LEFT JOIN mz z ON ms.slug_in = z.slug_in
                 LEFT JOIN mc c ON ms.slug_in = c.slug_in)"""


def sql_model_resolution(inputs: str, fuzzy: bool = True) -> str:
    """CTE text ``res(raw_make, raw_model, make, make_stage, model, model_stage, reject_reason, slug_in)``."""
    similar = f"""{sql_ratio("dr", """SELECT k.mslug AS a, r.slug_in AS b FROM rest r JOIN md_by k ON r.make = k.make
      WHERE k.mslug <> '' AND NOT (len(trim(r.slug_in)) <= 4 OR (regexp_full_match(trim(r.slug_in), '[a-z0-9 ]{1,6}') AND regexp_matches(r.slug_in, '[0-9]')))
        AND 2.0 * least(len(k.mslug), len(r.slug_in)) >= 0.59 * (len(k.mslug) + len(r.slug_in))""")},
e7 AS (SELECT r.make, r.slug_in, arg_max(k.model, (dr.ratio, k.mslug)) AS m FROM rest r JOIN md_by k ON r.make = k.make
       JOIN dr ON dr.a = k.mslug AND dr.b = r.slug_in WHERE dr.ratio >= {MODEL_FUZZY_CUTOFF} GROUP BY ALL)""" if fuzzy else """
e7 AS (SELECT '' AS make, '' AS slug_in, '' AS m WHERE false)"""
    return f"""{sql_make_resolution(inputs, fuzzy)},
pr AS (SELECT DISTINCT raw_make, raw_model FROM ({inputs}) q WHERE raw_model IS NOT NULL AND raw_model <> ''),
pm AS (SELECT pr.raw_make, pr.raw_model, mres.make, mres.make_stage, {sql_slug('pr.raw_model')} AS slug_in,
              mres.make IN (SELECT make FROM mm) AS has_models, mres.make IN (SELECT make FROM mk) AS known_make
       FROM pr LEFT JOIN mres ON pr.raw_make = mres.raw_make),
w AS (SELECT DISTINCT make, slug_in FROM pm WHERE has_models),
w1 AS (SELECT w.make, w.slug_in, ex.model AS m_exact, ns.model AS m_nospace FROM w
       LEFT JOIN md_by ex ON w.make = ex.make AND w.slug_in = ex.mslug
       LEFT JOIN md_ns ns ON w.make = ns.make AND regexp_replace(w.slug_in, '{WS}+', '', 'g') = ns.k),
rest AS (SELECT make, slug_in FROM w1 WHERE m_exact IS NULL AND m_nospace IS NULL),
{similar.strip()},
e8 AS (SELECT r.make, r.slug_in, arg_max(b.model, length(b.mslug) * 1000000 - b.first_pos) AS m FROM rest r
       JOIN md_by b ON r.make = b.make AND length(b.mslug) >= 2 AND contains(r.slug_in, b.mslug) GROUP BY ALL),
e9 AS (SELECT r.make, r.slug_in, arg_max(b.model, length(b.mslug) * 1000000 - b.first_pos) AS m FROM rest r
       JOIN md_by b ON r.make = b.make AND length(r.slug_in) >= 2 AND contains(b.mslug, r.slug_in) GROUP BY ALL),
hits AS (SELECT w1.make, w1.slug_in, coalesce(m_exact, m_nospace, e7.m, e8.m, e9.m) AS model,
           CASE WHEN m_exact IS NOT NULL THEN 'exact' WHEN m_nospace IS NOT NULL THEN 'nospace'
                WHEN e7.m IS NOT NULL THEN 'fuzzy' WHEN e8.m IS NOT NULL THEN 'contains' WHEN e9.m IS NOT NULL THEN 'contained' END AS model_stage
         FROM w1 LEFT JOIN e7 ON w1.make = e7.make AND w1.slug_in = e7.slug_in
                 LEFT JOIN e8 ON w1.make = e8.make AND w1.slug_in = e8.slug_in
                 LEFT JOIN e9 ON w1.make = e9.make AND w1.slug_in = e9.slug_in),
res AS (SELECT pm.raw_make, pm.raw_model, pm.make, pm.make_stage, coalesce(hits.model, pm.raw_model) AS model,
          hits.model_stage,
          CASE WHEN NOT coalesce(pm.known_make, false) AND NOT coalesce(pm.has_models, false) THEN 'UNKNOWN_MAKE'
               WHEN NOT pm.has_models THEN 'NO_MODELS' WHEN hits.model IS NULL THEN 'UNMATCHED' END AS reject_reason,
          pm.slug_in
        FROM pm LEFT JOIN hits ON pm.make = hits.make AND pm.slug_in = hits.slug_in)"""


# ── queries ──

def make_resolve(spark, sf):
    """E1 → E2 → E4 on perturbed make names (similarity stage off; see the fuzzy query)."""
    p = table(spark, sf, "part")
    vals = p.select(_make_inputs(p).alias("raw_make"))
    return resolve_makes(vals, part_catalog(spark, sf), fuzzy=False)


MAKE_RESOLVE_SQL = f"""
WITH {SQL_CATALOG},
{sql_make_resolution(f"SELECT {SQL_MAKE_INPUT} AS raw_make FROM part", fuzzy=False)}
SELECT raw_make, make, make_stage FROM mres
"""


def model_resolve(spark, sf):
    """E5, E6, E8, E9 (+ make stages) on perturbed model names; similarity stage off."""
    p = table(spark, sf, "part")
    mk, md = _model_inputs(p)
    pairs = p.select(mk.alias("raw_make"), md.alias("raw_model"))
    return resolve_models(pairs, part_catalog(spark, sf), fuzzy=False)


MODEL_RESOLVE_SQL = f"""
WITH {SQL_CATALOG},
{sql_model_resolution(SQL_MODEL_INPUTS, fuzzy=False)}
SELECT * FROM res
"""


def _drop_letter(p):
    return F.expr("concat(substring(p_name, 1, (p_size % (length(p_name) - 1)) + 1), "
                  "substring(p_name, (p_size % (length(p_name) - 1)) + 3))")


def model_resolve_fuzzy(spark, sf):
    """Full cascade with the similarity stages (E3, E7 via J4) on names with one letter
    dropped and makes with one letter doubled."""
    p = table(spark, sf, "part")
    raw_make = F.concat(F.col("p_type"), F.substring("p_type", -1, 1))
    pairs = p.select(raw_make.alias("raw_make"), _drop_letter(p).alias("raw_model"))
    return resolve_models(pairs, part_catalog(spark, sf), fuzzy=True)


MODEL_RESOLVE_FUZZY_SQL = f"""
WITH RECURSIVE {SQL_CATALOG},
{sql_model_resolution("""SELECT p_type || right(p_type, 1) AS raw_make,
       substr(p_name, 1, (p_size % (length(p_name) - 1)) + 1) || substr(p_name, (p_size % (length(p_name) - 1)) + 3) AS raw_model
     FROM part""")}
SELECT * FROM res
"""


def listing_resolution(spark, sf, fuzzy: bool = True):
    """K1 — listings resolved (make, model, generation) and counted per result."""
    p = table(spark, sf, "part")
    mk, md = _model_inputs(p)
    year = (F.lit(2010) + F.col("p_size") % 15).cast("string")
    listings = p.select("p_partkey", mk.alias("marque"), md.alias("modele"), year.alias("annee"))
    gens = part_generations(spark, sf)
    out = resolve_listings(listings, part_catalog(spark, sf), gens=gens, fuzzy=fuzzy)
    return out.groupBy("make_resolved", "modele_unifie", "generation").agg(F.count("*").cast("long").alias("n"))


def part_generations(spark, sf):
    """Generations per model name: two overlapping intervals and an open one, by rule.

    Keys are ordered by name; the key itself serves as the (order-only) position, so no
    ranking window is needed."""
    p = table(spark, sf, "part")
    keys = p.groupBy(F.upper("p_name").alias("model")).agg(F.min("p_size").alias("s"))
    y = F.lit(2010) + F.col("s") % 5
    gens = F.array(
        F.struct(F.concat(F.col("model"), F.lit(" 1")).alias("gen"), y.cast("int").alias("from"), (y + 3).cast("int").alias("to")),
        F.struct(F.concat(F.col("model"), F.lit(" 2")).alias("gen"), (y + 3).cast("int").alias("from"), (y + 6).cast("int").alias("to")),
        F.struct(F.concat(F.col("model"), F.lit(" 3")).alias("gen"), (y + 8).cast("int").alias("from"), F.lit(9999).alias("to")))
    return keys.select(F.col("model").alias("key_pos"), "model", gens.alias("gens"))


# generations from orders

def order_generations(spark, sf):
    o = table(spark, sf, "orders")
    g = o.groupBy(F.substring("o_orderpriority", 3, 100).alias("model")).agg(F.min(F.year("o_orderdate")).alias("y"))
    iv = lambda i, f, t: F.struct(F.concat(F.col("model"), F.lit(f" {i}")).alias("gen"),
                                  f.cast("int").alias("from"), t.cast("int").alias("to"))
    y = F.col("y")
    # keys are in order of their names, so the name itself is the position
    return g.select(F.col("model").alias("key_pos"), "model",
                    F.array(iv(1, y, y + 2), iv(2, y + 2, y + 4), iv(3, y + 6, F.lit(9999))).alias("gens"))


def _order_inputs(spark, sf):
    o = table(spark, sf, "orders")
    k = F.substring("o_orderpriority", 3, 100)
    m = F.col("o_orderkey") % 3
    model = F.when(m == 0, k).when(m == 1, F.lower(k)).otherwise(F.regexp_replace(k, " ", "-"))
    yr = F.year("o_orderdate").cast("string")
    year = F.when(F.col("o_orderkey") % 4 == 0,
                  F.concat(F.lpad(F.month("o_orderdate").cast("string"), 2, "0"), F.lit("/"), yr)).otherwise(yr)
    status = F.col("o_orderstatus")
    return o.select(F.col("o_orderkey").alias("id"), model.alias("modele_unifie"), year.alias("date_voiture"),
                    F.when(status == "O", F.lit(None)).when(status == "F", F.lit("N/A"))
                    .otherwise(F.lit("kept")).cast("string").alias("generation"))


SQL_ORDER_GENS = """
og0 AS (SELECT substr(o_orderpriority, 3) AS model, min(year(o_orderdate)) AS y FROM orders GROUP BY 1),
og AS (SELECT row_number() OVER (ORDER BY model) - 1 AS key_pos, model, y FROM og0),
iv AS (SELECT key_pos, model, 1 AS gpos, model || ' 1' AS gen, y AS f, y + 2 AS t FROM og
       UNION ALL SELECT key_pos, model, 2, model || ' 2', y + 2, y + 4 FROM og
       UNION ALL SELECT key_pos, model, 3, model || ' 3', y + 6, 9999 FROM og),
oi AS (SELECT o_orderkey AS id,
         CASE o_orderkey % 3 WHEN 0 THEN k WHEN 1 THEN lower(k) ELSE replace(k, ' ', '-') END AS modele_unifie,
         CASE WHEN o_orderkey % 4 = 0 THEN lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '/' || CAST(y AS VARCHAR)
              ELSE CAST(y AS VARCHAR) END AS date_voiture,
         CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'F' THEN 'N/A' ELSE 'kept' END AS generation
       FROM (SELECT *, substr(o_orderpriority, 3) AS k, year(o_orderdate) AS y FROM orders) q)"""


def generation_lookup(spark, sf):
    """E11 + E12 — generation by key / slug key and first matching interval (J17 year)."""
    x = _order_inputs(spark, sf).drop("generation")
    return lookup_generation(x, "modele_unifie", "date_voiture", order_generations(spark, sf)).select(
        "id", "modele_unifie", "date_voiture", "generation")


def _sql_gen_pick(src: str) -> str:
    return f"""
gx AS (SELECT *, upper(trim(modele_unifie)) AS gkey, TRY_CAST(trim(substr(trim(date_voiture), 1, 4)) AS INTEGER) AS yr
       FROM {src}),
gsl AS (SELECT {sql_slug('model')} AS s, arg_min(model, key_pos) AS model FROM og GROUP BY 1),
gp AS (SELECT gx.id, coalesce(ek.model, sk.model) AS k2 FROM gx LEFT JOIN og ek ON ek.model = gx.gkey
       LEFT JOIN gsl sk ON sk.s = {sql_slug('gx.gkey')}),
gr AS (SELECT gx.id, arg_min(iv.gen, iv.gpos) AS gen FROM gx JOIN gp ON gx.id = gp.id
       JOIN iv ON iv.model = gp.k2 AND gx.yr BETWEEN iv.f AND iv.t
       WHERE gx.modele_unifie IS NOT NULL AND gx.modele_unifie <> '' GROUP BY gx.id)"""


GENERATION_LOOKUP_SQL = f"""
WITH {SQL_ORDER_GENS},
{_sql_gen_pick("oi")}
SELECT gx.id, gx.modele_unifie, gx.date_voiture, coalesce(gr.gen, 'N/A') AS generation
FROM gx LEFT JOIN gr ON gx.id = gr.id
"""


def generation_backfill(spark, sf):
    """K3 — rows never tried (generation NULL) get a generation, ``N/A`` when none."""
    return generation_backfill_op(_order_inputs(spark, sf), order_generations(spark, sf))


GENERATION_BACKFILL_SQL = f"""
WITH {SQL_ORDER_GENS},
{_sql_gen_pick("(SELECT * FROM oi WHERE generation IS NULL)")}
SELECT gx.id, coalesce(gr.gen, 'N/A') AS generation FROM gx LEFT JOIN gr ON gx.id = gr.id
"""


def generation_reindex(spark, sf):
    """K4 — rows marked ``N/A`` retried: exact key, year after the last ``/``, update on hit only."""
    return generation_reindex_op(_order_inputs(spark, sf), order_generations(spark, sf))


GENERATION_REINDEX_SQL = f"""
WITH {SQL_ORDER_GENS},
x AS (SELECT id, modele_unifie,
        CASE WHEN date_voiture IS NULL OR date_voiture IN ('', 'N/A') THEN NULL
             ELSE TRY_CAST(trim(string_split(date_voiture, '/')[-1]) AS INTEGER) END AS yr
      FROM oi WHERE generation = 'N/A')
SELECT x.id, arg_min(iv.gen, iv.gpos) AS generation
FROM x JOIN iv ON iv.model = x.modele_unifie AND x.yr BETWEEN iv.f AND iv.t GROUP BY x.id
"""


def _coverage_base(spark, sf):
    p = table(spark, sf, "part")
    mk, md = _model_inputs(p, missing_makes=True)
    rows = p.select("p_partkey", F.col("p_brand").alias("source"), mk.alias("raw_make"), md.alias("raw_model"))
    return catalogue_coverage(rows, part_catalog(spark, sf))


def coverage_report(spark, sf):
    """K12 / F5 / E17 — share of listings whose resolved model is in its make's list."""
    return coverage(_coverage_base(spark, sf))


def coverage_misses(spark, sf):
    """K12 / I2 — distinct unmatched (make, model) per source with first position."""
    return distinct_misses(_coverage_base(spark, sf), "p_partkey")


_SQL_COVERAGE_BASE = f"""
WITH RECURSIVE {SQL_CATALOG},
{sql_model_resolution(SQL_MISSING_MAKES)},
rows AS ({SQL_MISSING_MAKES}),
j AS (SELECT rows.*, res.make, res.model,
        EXISTS (SELECT 1 FROM mm WHERE mm.make = res.make AND mm.model = res.model) AS found
      FROM rows LEFT JOIN res ON rows.raw_make IS NOT DISTINCT FROM res.raw_make AND rows.raw_model = res.raw_model)
"""

COVERAGE_REPORT_SQL = _SQL_COVERAGE_BASE + """
SELECT source, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE found) AS BIGINT) AS matched,
       round(count(*) FILTER (WHERE found) * 100.0 / count(*), 2) AS pct
FROM j GROUP BY source
"""

COVERAGE_MISSES_SQL = _SQL_COVERAGE_BASE + """
SELECT source, raw_make, raw_model, min(p_partkey) AS first_pos FROM j WHERE NOT found GROUP BY ALL
"""

def renormalize_store(spark, sf):
    """Stored listings with resolved, raw and missing models."""
    p = table(spark, sf, "part")
    mk, md = _model_inputs(p)
    k = F.col("p_size") % 3
    return p.select(F.col("p_partkey").alias("id"), mk.alias("marque"), md.alias("modele"),
                     F.when(k == 0, F.col("p_name")).when(k == 1, F.lit(None)).otherwise(md)
                     .cast("string").alias("modele_unifie"))


def renormalize_backfill_q(spark, sf):
    """K2 — stored listings whose resolved model changed (change set only)."""
    from carlot.operators.lifecycle import renormalize_backfill
    return renormalize_backfill(renormalize_store(spark, sf), part_catalog(spark, sf))


RENORMALIZE_BACKFILL_SQL = f"""
WITH RECURSIVE {SQL_CATALOG},
{sql_model_resolution(SQL_MODEL_INPUTS)},
st AS (SELECT p_partkey AS id, i.raw_make AS marque, i.raw_model AS modele,
              CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN NULL ELSE i.raw_model END AS modele_unifie
       FROM part JOIN ({SQL_MODEL_INPUTS}) i USING (p_partkey))
SELECT st.id, st.modele_unifie AS old, res.model AS modele_unifie
FROM st JOIN res ON st.marque = res.raw_make AND st.modele = res.raw_model
WHERE coalesce(st.marque, '') <> '' AND coalesce(st.modele, '') <> ''
  AND res.model <> coalesce(st.modele_unifie, '')
"""

def listing_resolution_exact(spark, sf):
    """K1 with the similarity stages off: join-back, generation lookup and counts checked
    against SQL (the flagship above runs the full cascade)."""
    return listing_resolution(spark, sf, fuzzy=False)


def _listing_resolution_sql(fuzzy: bool) -> str:
    return f"""
WITH {'RECURSIVE ' if fuzzy else ''}{SQL_CATALOG},
{sql_model_resolution(SQL_MODEL_INPUTS, fuzzy)},
pg0 AS (SELECT upper(p_name) AS model, min(p_size) AS s FROM part GROUP BY 1),
pg AS (SELECT row_number() OVER (ORDER BY model) - 1 AS key_pos, model, 2010 + s % 5 AS y FROM pg0),
piv AS (SELECT key_pos, model, 1 AS gpos, model || ' 1' AS gen, y AS f, y + 3 AS t FROM pg
        UNION ALL SELECT key_pos, model, 2, model || ' 2', y + 3, y + 6 FROM pg
        UNION ALL SELECT key_pos, model, 3, model || ' 3', y + 8, 9999 FROM pg),
rws AS (SELECT i.p_partkey, i.raw_make AS marque, i.raw_model AS modele,
               CAST(2010 + p.p_size % 15 AS VARCHAR) AS annee
        FROM ({SQL_MODEL_INPUTS}) i JOIN part p ON i.p_partkey = p.p_partkey),
k1 AS (SELECT r.*, res.make AS make_resolved, coalesce(res.model, r.modele) AS modele_unifie FROM rws r
       LEFT JOIN res ON r.marque IS NOT DISTINCT FROM res.raw_make AND r.modele = res.raw_model),
gx AS (SELECT *, upper(trim(modele_unifie)) AS gkey,
              TRY_CAST(trim(substr(trim(annee), 1, 4)) AS INTEGER) AS yr FROM k1),
gsl AS (SELECT {sql_slug('model')} AS s, arg_min(model, key_pos) AS model FROM pg GROUP BY 1),
gp AS (SELECT gx.p_partkey, coalesce(ek.model, sk.model) AS k2 FROM gx
       LEFT JOIN pg ek ON ek.model = gx.gkey LEFT JOIN gsl sk ON sk.s = {sql_slug('gx.gkey')}),
gr AS (SELECT gx.p_partkey, arg_min(piv.gen, piv.gpos) AS gen FROM gx JOIN gp ON gx.p_partkey = gp.p_partkey
       JOIN piv ON piv.model = gp.k2 AND gx.yr BETWEEN piv.f AND piv.t
       WHERE gx.modele_unifie IS NOT NULL AND gx.modele_unifie <> '' GROUP BY gx.p_partkey)
SELECT make_resolved, modele_unifie, coalesce(gr.gen, 'N/A') AS generation, CAST(count(*) AS BIGINT) AS n
FROM gx LEFT JOIN gr ON gx.p_partkey = gr.p_partkey GROUP BY ALL
"""


LISTING_RESOLUTION_SQL = _listing_resolution_sql(True)
LISTING_RESOLUTION_EXACT_SQL = _listing_resolution_sql(False)

QUERIES = {
    "listing_resolution_exact": (listing_resolution_exact, LISTING_RESOLUTION_EXACT_SQL),
    "renormalize_backfill": (renormalize_backfill_q, RENORMALIZE_BACKFILL_SQL),
    "make_resolve": (make_resolve, MAKE_RESOLVE_SQL),
    "model_resolve": (model_resolve, MODEL_RESOLVE_SQL),
    "model_resolve_fuzzy": (model_resolve_fuzzy, MODEL_RESOLVE_FUZZY_SQL),
    "listing_resolution": (listing_resolution, LISTING_RESOLUTION_SQL),
    "generation_lookup": (generation_lookup, GENERATION_LOOKUP_SQL),
    "generation_backfill": (generation_backfill, GENERATION_BACKFILL_SQL),
    "generation_reindex": (generation_reindex, GENERATION_REINDEX_SQL),
    "coverage_report": (coverage_report, COVERAGE_REPORT_SQL),
    "coverage_misses": (coverage_misses, COVERAGE_MISSES_SQL),
}
