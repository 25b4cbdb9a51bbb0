"""Bindings of catalogue maintenance and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from carlot.operators.catalog_ops import (add_makes, append_models, build_in_steps, catalogue_totals, extend_open_end,
                                          model_aliases, read_steps, replace_lists)
from carlot.plans.common import table
from carlot.plans.resolve_queries import SQL_ORDER_GENS, order_generations, part_catalog
from carlot.session import shared_scratch_dir
from carlot.sources.catalog import load_generation_catalog, load_make_catalog
from carlot.sources.sinks import csv_roundtrip, json_roundtrip
from carlot.sources.store import with_row_numbers


def _vslug(expr: str) -> str:
    src, dst = "éèêëàâäüùûöôîïç", "eeeeaaauuuooiic"
    s = f"lower(trim({expr}))"
    for a, b in zip(src, dst):
        s = f"replace({s}, '{a}', '{b}')"
    s = f"replace({s}, '/', '_')"
    return f"trim(regexp_replace({s}, '[-\\s]+', ' ', 'g'))"


def catalog_aliases(spark, sf):
    """I7 / K16 — alias table (slug, no-space, hyphen forms) of the part catalogue."""
    return model_aliases(part_catalog(spark, sf))


_SQL_CAT = """
cat_m AS (SELECT p_type AS make, min(p_partkey) AS o FROM part GROUP BY p_type),
mk AS (SELECT make, o AS make_pos FROM cat_m),
cat_md AS (SELECT p_type AS make, p_name AS model, min(p_partkey) AS o FROM part GROUP BY ALL),
mm AS (SELECT make, model, o AS model_pos FROM cat_md)"""

CATALOG_ALIASES_SQL = f"""
WITH {_SQL_CAT},
ms AS (SELECT {_vslug('make')} AS make_slug, arg_max(make, make_pos) AS make FROM mk GROUP BY 1),
a AS (SELECT ms.make_slug, ms.make, mm.model_pos, mm.model, {_vslug('mm.model')} AS s FROM mm JOIN ms ON mm.make = ms.make),
x AS (SELECT make_slug, make, model_pos, model, unnest(list_distinct([s, replace(s, ' ', ''), replace(s, ' ', '-')])) AS alias FROM a)
SELECT make_slug, alias, max(make) AS display, arg_max(model, model_pos) AS model FROM x GROUP BY ALL
"""


def catalog_totals(spark, sf):
    """F7 — makes and model aliases of the alias table."""
    return catalogue_totals(model_aliases(part_catalog(spark, sf)))


CATALOG_TOTALS_SQL = CATALOG_ALIASES_SQL.replace(
    "SELECT make_slug, alias, max(make) AS display, arg_max(model, model_pos) AS model FROM x GROUP BY ALL",
    "SELECT CAST(count(DISTINCT make_slug) AS BIGINT) AS makes, CAST(count(*) AS BIGINT) AS model_aliases "
    "FROM (SELECT DISTINCT make_slug, alias FROM x) y")


def catalog_patch(spark, sf):
    """I3 + I4 / K17 — add makes only when absent (brands of large parts, plus types
    that already exist and are ignored), then append models to existing makes."""
    p = table(spark, sf, "part")
    cat = part_catalog(spark, sf)
    additions = p.where(F.col("p_size") >= 45).select(
        F.col("p_partkey").alias("add_pos"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(F.col("p_type")).alias("make"),
        F.col("p_partkey").alias("model_pos"), F.col("p_name").alias("model"))
    extra = p.where(F.col("p_size") <= 3).select(
        F.col("p_type").alias("make"), F.col("p_partkey").alias("model_pos"),
        F.when(F.col("p_size") == 1, F.col("p_name")).otherwise(F.upper("p_name")).alias("model"))
    out = append_models(add_makes(cat, additions), extra)
    mk = out.makes
    return out.models.join(mk, "make").select(F.col("make_pos").cast("long"), "make",
                                              F.col("model_pos").cast("long"), "model")


CATALOG_PATCH_SQL = f"""
WITH {_SQL_CAT},
add AS (SELECT p_partkey AS add_pos, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS make,
               p_partkey AS model_pos, p_name AS model FROM part WHERE p_size >= 45),
newm AS (SELECT make, min(add_pos) AS o FROM add WHERE make NOT IN (SELECT make FROM mk) GROUP BY make),
mk2 AS (SELECT make, make_pos FROM mk UNION ALL
        SELECT make, (SELECT max(make_pos) + 1 FROM mk) + o FROM newm),
mm2 AS (SELECT make, model_pos, model FROM mm UNION ALL
        SELECT make, model_pos, model FROM add WHERE make IN (SELECT make FROM newm) AND model IS NOT NULL),
ex AS (SELECT p_type AS make, p_partkey AS model_pos,
              CASE WHEN p_size = 1 THEN p_name ELSE upper(p_name) END AS model FROM part WHERE p_size <= 3),
cand AS (SELECT make, model, min(model_pos) AS o FROM ex
         WHERE make IN (SELECT make FROM mk2)
           AND NOT EXISTS (SELECT 1 FROM mm2 WHERE mm2.make = ex.make AND mm2.model = ex.model)
         GROUP BY make, model),
nxt AS (SELECT make, max(model_pos) + 1 AS b FROM mm2 GROUP BY make),
added AS (SELECT cand.make, CAST(coalesce(nxt.b, 0) + row_number() OVER (PARTITION BY cand.make ORDER BY cand.o) - 1 AS BIGINT) AS model_pos,
                 cand.model FROM cand LEFT JOIN nxt ON cand.make = nxt.make),
allm AS (SELECT * FROM mm2 UNION ALL SELECT * FROM added)
SELECT CAST(mk2.make_pos AS BIGINT) AS make_pos, allm.make, CAST(allm.model_pos AS BIGINT) AS model_pos, allm.model
FROM allm JOIN mk2 ON allm.make = mk2.make
"""


def ranked_keys(keys):
    """Numbered positions for keys in order of their names: written sorted, numbered as they are read."""
    path = shared_scratch_dir(keys.sparkSession, "ranked-keys")
    keys.drop("key_pos").repartitionByRange("model").sortWithinPartitions("model").write.parquet(path)
    scan = keys.sparkSession.read.parquet(path)
    return with_row_numbers(scan, scan.columns, "key_pos").withColumn("key_pos", F.col("key_pos").cast("int"))


def generation_patch(spark, sf):
    """I6 then I5 / K17 — open the end of every ``<key> 2`` interval of keys starting
    with H or L, then replace (or add) whole lists per order status."""
    o = table(spark, sf, "orders")
    gens = ranked_keys(order_generations(spark, sf))
    pairs = gens.where(F.substring("model", 1, 1).isin("H", "L")).select(
        "model", F.concat(F.col("model"), F.lit(" 2")).alias("gen"))
    g2 = extend_open_end(gens, pairs)
    st = o.groupBy(F.when(F.col("o_orderstatus") == "F", F.lit("HIGH"))
                   .otherwise(F.concat(F.lit("STATUS "), F.col("o_orderstatus"))).alias("model")) \
        .agg(F.min(F.year("o_orderdate")).alias("y"), F.max(F.year("o_orderdate")).alias("z"))
    new = ranked_keys(st.withColumn("key_pos", F.col("model"))).select(
                    "key_pos", "model", F.array(F.struct(F.concat(F.col("model"), F.lit(" A")).alias("gen"), F.col("y").cast("int").alias("from"),
                                     F.col("z").cast("int").alias("to"))).alias("gens"))
    out = replace_lists(g2, new)
    return out.select("key_pos", "model", F.posexplode("gens").alias("gen_pos", "g")).select(
        "key_pos", "model", "gen_pos", "g.gen", F.col("g.from").alias("from"), F.col("g.to").alias("to"))


GENERATION_PATCH_SQL = f"""
WITH {SQL_ORDER_GENS},
iv2 AS (SELECT key_pos, model, gpos, gen, f,
               CASE WHEN substr(model, 1, 1) IN ('H', 'L') AND gen = model || ' 2' THEN 9999 ELSE t END AS t FROM iv),
st AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'HIGH' ELSE 'STATUS ' || o_orderstatus END AS model,
              min(year(o_orderdate)) AS y, max(year(o_orderdate)) AS z FROM orders GROUP BY 1),
nw AS (SELECT row_number() OVER (ORDER BY model) - 1 AS key_pos, model, y, z FROM st),
base AS (SELECT max(key_pos) + 1 AS b FROM og)
SELECT CAST(key_pos AS INTEGER) AS key_pos, model, CAST(gpos - 1 AS INTEGER) AS gen_pos, gen,
       CAST(f AS INTEGER) AS "from", CAST(t AS INTEGER) AS "to"
FROM iv2 WHERE model NOT IN (SELECT model FROM nw)
UNION ALL
SELECT CAST(coalesce(og.key_pos, (SELECT b FROM base) + nw.key_pos) AS INTEGER), nw.model, 0, nw.model || ' A',
       CAST(nw.y AS INTEGER), CAST(nw.z AS INTEGER)
FROM nw LEFT JOIN og ON og.model = nw.model
"""


def _broken_off(spark, sf, path):
    """A first run of a catalogue's build that fails halfway, and a step that was never finished."""
    p = table(spark, sf, "part")
    built = []

    def build(makes):
        if len(built) == 2:
            raise ConnectionError("the source went away")
        built.append(makes)
        return _make_models(p, makes)

    try:
        build_in_steps(p.select(F.col("p_type").alias("make")), build, path, MAKE_MODELS, steps=8)
    except ConnectionError:
        pass
    junk = p.select(F.lit("half a model").alias("model"), F.col("p_partkey").alias("model_pos"), F.col("p_type").alias("make"))
    junk.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("make").parquet(f"{path}/step=unfinished")


MAKE_MODELS = "model string, model_pos long, make string"


def _make_models(p, makes):
    models = p.groupBy(F.col("p_type").alias("make"), F.col("p_name").alias("model")).agg(F.min("p_partkey").alias("model_pos"))
    return models.join(makes, "make").select("model", "model_pos", "make")


def catalog_resume(spark, sf):
    """K16, D14 — a catalogue's build that broke off is taken up again: makes of complete steps are done."""
    path, p = shared_scratch_dir(spark, "catalog-steps"), table(spark, sf, "part")
    _broken_off(spark, sf, path)
    build_in_steps(p.select(F.col("p_type").alias("make")), lambda makes: _make_models(p, makes), path, MAKE_MODELS, steps=8)
    return read_steps(spark, path, MAKE_MODELS)


CATALOG_RESUME_SQL = "SELECT p_name AS model, min(p_partkey) AS model_pos, p_type AS make FROM part GROUP BY p_type, p_name"


def _write_text(df, path):
    df.coalesce(1).write.text(path)  # a catalogue file is one document


def catalog_file(spark, sf):
    """A2 — a make → models document, written and read in its order."""
    path, p = shared_scratch_dir(spark, "catalog-file"), table(spark, sf, "part")
    lists = p.groupBy("p_type").agg(F.array_sort(F.collect_set("p_name")).alias("models"))
    entries = lists.agg(F.array_sort(F.collect_list(F.struct("p_type", "models"))).alias("e"))
    _write_text(entries.select(F.to_json(F.map_from_entries("e")).alias("value")), path)
    cat = load_make_catalog(spark, path)
    return cat.makes.join(cat.models, "make").select("make_pos", "make", "model_pos", "model")


CATALOG_FILE_SQL = """
WITH m AS (SELECT p_type AS make, row_number() OVER (ORDER BY p_type) - 1 AS make_pos FROM (SELECT DISTINCT p_type FROM part) x)
SELECT CAST(make_pos AS INTEGER) AS make_pos, make, CAST(row_number() OVER (PARTITION BY make ORDER BY model) - 1 AS INTEGER) AS model_pos, model
FROM (SELECT DISTINCT p_type AS make, p_name AS model FROM part) p JOIN m USING (make)
"""


def generation_file(spark, sf):
    """A3 — a model → generations document, written and read in its order."""
    path = shared_scratch_dir(spark, "generation-file")
    gens = order_generations(spark, sf).select("model", F.transform("gens", lambda g: F.struct(
        g["gen"].alias("gen"), g["from"].alias("from"), g["to"].alias("to"))).alias("gens"))
    entries = gens.agg(F.array_sort(F.collect_list(F.struct("model", "gens"))).alias("e"))
    _write_text(entries.select(F.to_json(F.map_from_entries("e")).alias("value")), path)
    read = load_generation_catalog(spark, path)
    return read.select("key_pos", "model", F.posexplode("gens").alias("gen_pos", "g")).select(
        "key_pos", "model", "gen_pos", "g.gen", F.col("g.from").alias("from"), F.col("g.to").alias("to"))


GENERATION_FILE_SQL = f"""
WITH {SQL_ORDER_GENS}
SELECT CAST(key_pos AS INTEGER) AS key_pos, model, CAST(gpos - 1 AS INTEGER) AS gen_pos, gen, CAST(f AS INTEGER) AS "from", CAST(t AS INTEGER) AS "to" FROM iv
"""


def csv_roundtrip_q(spark, sf):
    """B2 — ``;``-separated CSV with header written to the shared folder and read back."""
    return csv_roundtrip(table(spark, sf, "part"))


def json_roundtrip_q(spark, sf):
    """B1 — JSON lines written to the shared folder and read back."""
    return json_roundtrip(table(spark, sf, "part"))


ROUNDTRIP_SQL = "SELECT * FROM part"

QUERIES = {
    "catalog_aliases": (catalog_aliases, CATALOG_ALIASES_SQL),
    "catalog_totals": (catalog_totals, CATALOG_TOTALS_SQL),
    "catalog_patch": (catalog_patch, CATALOG_PATCH_SQL),
    "catalog_resume": (catalog_resume, CATALOG_RESUME_SQL),
    "catalog_file": (catalog_file, CATALOG_FILE_SQL),
    "generation_file": (generation_file, GENERATION_FILE_SQL),
    "generation_patch": (generation_patch, GENERATION_PATCH_SQL),
    "csv_roundtrip": (csv_roundtrip_q, ROUNDTRIP_SQL),
    "json_roundtrip": (json_roundtrip_q, ROUNDTRIP_SQL),
}
