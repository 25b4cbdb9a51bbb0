"""Entity resolution: make, model and generation of each listing.

Design
------
* Work is factored to DISTINCT inputs (vocabulary, not rows): distinct raw makes,
  distinct (make, raw model) pairs. Results are joined back to the listings once.
* Every stage is an equi-join against a catalogue-derived table that is broadcast
  only after its row count is checked (``sized_broadcast``):
    - exact / alias / no-space stages join on slugs;
    - the similarity stages join on *compatible length* (an exact bound: a pair whose
      lengths violate ``2·min/(la+lb) ≥ cutoff`` can never reach the cut-off), so only
      plausible pairs reach the pandas UDF that scores them;
    - make containment is looked up in an index over the catalogue's slugs (one automaton
      and grams, ``functions/containment.py``), so neither side's substrings are listed.
* Each stage only sees what earlier stages left unresolved; the first stage that
  hits wins, and a ``stage`` column records which one.
* Order-dependent picks are explicit: catalogue positions are columns, ties are broken
  with ``max_by`` / ``min_by`` over full keys, never by ``first()``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.functions.codes import MAKE_ALIASES, MAKE_FUZZY_CUTOFF, MODEL_FUZZY_CUTOFF
from carlot.functions.numbers import year_after_slash, year_prefix4
from carlot.functions.containment import SlugIndex
from carlot.functions.similarity import compatible_lengths, ratio, ratio_bound, sign_mask
from carlot.functions.text import is_short_or_numeric, nospace, pystrip, slug
from carlot.session import BROADCAST_MAX_BYTES, bounded_broadcast, cut_lineage, ship_package, sized_broadcast, spread


@dataclass
class Catalog:
    """Long-form make/model catalogue.

    ``makes``  (make_pos int, make string) — every make, in catalogue order
    ``models`` (make string, model_pos int, model string) — models per make, in order
    ``aliases`` (alias_slug string, target string) — optional make aliases
    ``overrides`` (make_slug string, raw_slug string, label string) — optional E19 table
    """
    makes: DataFrame
    models: DataFrame
    aliases: DataFrame | None = None
    overrides: DataFrame | None = None


def alias_table(spark, aliases: dict | None = None) -> DataFrame:
    rows = list((aliases if aliases is not None else MAKE_ALIASES).items())
    return spark.createDataFrame(rows, "alias_slug string, target string")


def catalog_facts(cat: Catalog) -> dict[str, tuple[int, list[int]]]:
    """Row counts and distinct slug lengths of makes, models and aliases, measured in one
    aggregate job and kept on the catalogue object.

    Every table the cascade broadcasts is derived from these three, so its size has a
    proven bound: ≤ n rows per slug table."""
    facts = getattr(cat, "_facts", None)
    if facts is not None:
        return facts
    spark = cat.makes.sparkSession
    aliases = cat.aliases if cat.aliases is not None else alias_table(spark)
    parts = (cat.makes.select(F.lit("make").alias("k"), slug("make").alias("s"))
             .unionByName(cat.models.where(F.col("model").isNotNull())
                          .select(F.lit("model").alias("k"), slug("model").alias("s")))
             .unionByName(aliases.select(F.lit("alias").alias("k"), F.col("alias_slug").alias("s"))))
    rows = parts.groupBy("k").agg(F.count("*").alias("n"), F.collect_set(F.length("s")).alias("lens")).collect()
    facts = {"make": (0, []), "model": (0, []), "alias": (0, [])}
    for r in rows:
        facts[r["k"]] = (int(r["n"]), sorted(int(x) for x in r["lens"] if x is not None))
    cat._facts = facts
    return facts


def can_reach(cutoff: float) -> Column:
    """Whether a pair (``mslug``, ``slug_in`` and their sign masks) can reach the cut-off."""
    return ratio_bound(F.col("mslug"), F.col("_cm"), F.col("slug_in"), F.col("_im")) >= cutoff - 1e-9


def contained_makes(values: DataFrame, by_slug: DataFrame, n: int) -> DataFrame:
    """E4 — (slug_in, m_contains): the first catalogue slug that stands in an input or holds it. The
    catalogue goes to the workers as an index, in groups of bounded size; inputs aren't exploded."""
    spark = values.sparkSession
    ship_package(spark)
    groups = max(1, -(-n * 256 // BROADCAST_MAX_BYTES))
    schema, parts = "slug_in string, first_pos long, make string", []
    for g in range(groups):
        rows = by_slug.where(F.pmod(F.xxhash64("mslug"), F.lit(groups)) == g).orderBy("first_pos").collect()
        shared = spark.sparkContext.broadcast([(r["mslug"], r["first_pos"], r["make"]) for r in rows])

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = SlugIndex(slug_ for slug_, _, _ in shared.value)
            for batch in batches:
                hits = [(text, *shared.value[i][1:]) for text in batch.column(0).to_pylist() if (i := index.hit(text)) is not None]
                if hits:
                    kinds = (pa.string(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*hits, strict=True), kinds, strict=True)],
                                                     names=["slug_in", "first_pos", "make"])

        parts.append(values.select("slug_in").mapInArrow(find, schema))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy("slug_in").agg(F.min_by("make", "first_pos").alias("m_contains"))


# ───────────────────────────── makes ─────────────────────────────

def make_tables(cat: Catalog, spark) -> dict[str, DataFrame]:
    mk = cat.makes.select("make_pos", "make", slug("make").alias("mslug"))
    exact = mk.groupBy("mslug").agg(F.min_by("make", "make_pos").alias("make"))
    # dict {slug: make}: key order = first occurrence, value = last writer
    by_slug = mk.groupBy("mslug").agg(F.min("make_pos").alias("first_pos"),
                                      F.max_by("make", "make_pos").alias("make"))
    aliases = cat.aliases if cat.aliases is not None else alias_table(spark)
    alias_ok = (aliases.join(cat.makes.select(F.col("make").alias("target")), "target", "left_semi")
                .groupBy("alias_slug").agg(F.max("target").alias("target")))
    return {"exact": exact, "by_slug": by_slug, "alias": alias_ok}


def resolve_makes(values: DataFrame, cat: Catalog, fuzzy: bool = True,
                  cutoff: float = MAKE_FUZZY_CUTOFF) -> DataFrame:
    """E1 → E2 → E3 → E4 over DISTINCT ``raw_make`` values.

    Returns ``raw_make, make, make_stage`` with ``make`` = the input when no stage hits
    (``make_stage`` NULL). An input whose slug is empty is left unresolved (the original
    matched the first catalogue make there).
    """
    spark = values.sparkSession
    if fuzzy:
        ship_package(spark)  # the similarity UDF runs in Python workers
    t = make_tables(cat, spark)
    facts = catalog_facts(cat)
    n_mk, mk_lens = facts["make"]
    exact = bounded_broadcast(t["exact"].select(F.col("mslug").alias("slug_in"), F.col("make").alias("m_exact")), n_mk)
    alias = bounded_broadcast(t["alias"].select(F.col("alias_slug").alias("slug_in"), F.col("target").alias("m_alias")),
                              facts["alias"][0])
    by_slug = t["by_slug"]

    d = (values.select("raw_make").where(F.col("raw_make").isNotNull() & (F.col("raw_make") != ""))
         .distinct().withColumn("slug_in", slug("raw_make")))
    # the distinct vocabulary is read by every later stage: materialise it once
    d = cut_lineage(d.join(exact, "slug_in", "left").join(alias, "slug_in", "left"))
    d = d.withColumn("m12", F.coalesce("m_exact", "m_alias"))
    rest = d.where(F.col("m12").isNull() & (F.col("slug_in") != "")).select("slug_in").distinct()

    if fuzzy:
        cand = bounded_broadcast(by_slug.select("mslug", "make", F.length("mslug").alias("clen"), sign_mask(F.col("mslug")).alias("_cm")), n_mk)
        pairs = (rest.withColumn("_im", sign_mask(F.col("slug_in"))).withColumn("clen", F.explode(compatible_lengths(F.length("slug_in"), cutoff, mk_lens)))
                 .join(cand, "clen").where(can_reach(cutoff))
                 .withColumn("score", ratio("mslug", "slug_in"))
                 .where(F.col("score") >= cutoff))
        fz = pairs.groupBy("slug_in").agg(
            F.max_by("make", F.struct("score", "mslug")).alias("m_fuzzy"))
    else:
        fz = None
    rest4 = rest  # E4 on the same remainder; a fuzzy hit wins in the final coalesce

    # Containment either way, first catalogue slug in dict order wins.
    ct = contained_makes(spread(rest4, "slug_in"), by_slug, n_mk)

    out = d.join(ct, "slug_in", "left")
    if fz is not None:
        out = out.join(fz, "slug_in", "left")
    else:
        out = out.withColumn("m_fuzzy", F.lit(None).cast("string"))
    stage = (F.when(F.col("m_exact").isNotNull(), F.lit("exact"))
             .when(F.col("m_alias").isNotNull(), F.lit("alias"))
             .when(F.col("m_fuzzy").isNotNull(), F.lit("fuzzy"))
             .when(F.col("m_contains").isNotNull(), F.lit("contains")))
    return out.select(
        "raw_make",
        F.coalesce("m_exact", "m_alias", "m_fuzzy", "m_contains", "raw_make").alias("make"),
        stage.alias("make_stage"))


# ───────────────────────────── models ─────────────────────────────

def model_tables(cat: Catalog) -> dict[str, DataFrame]:
    mm = cat.models.where(F.col("model").isNotNull()).select(
        "make", "model_pos", "model", slug("model").alias("mslug"))
    # per make, dict {slug: model}: key order = first occurrence, value = last writer
    by_slug = mm.groupBy("make", "mslug").agg(F.min("model_pos").alias("first_pos"),
                                              F.max_by("model", "model_pos").alias("model"))
    # {nospace(slug): model} built by iterating the dict above: last key wins
    ns = (by_slug.withColumn("ns", nospace("mslug"))
          .groupBy("make", "ns").agg(F.max_by("model", "first_pos").alias("model")))
    return {"by_slug": by_slug, "nospace": ns}


def resolve_models(pairs: DataFrame, cat: Catalog, fuzzy: bool = True,
                   cutoff: float = MODEL_FUZZY_CUTOFF, use_overrides: bool = False,
                   make_fuzzy: bool | None = None) -> DataFrame:
    """E10 over DISTINCT ``(raw_make, raw_model)`` pairs.

    Returns ``raw_make, raw_model, make, make_stage, model, model_stage, reject_reason``.
    ``model`` is the input model when no stage hits; ``reject_reason`` is
    ``UNKNOWN_MAKE`` (make unresolved), ``NO_MODELS`` (known make, empty list) or
    ``UNMATCHED`` (no stage hit), as the rejected-rows output (B6).
    """
    make_fuzzy = fuzzy if make_fuzzy is None else make_fuzzy
    if fuzzy:
        ship_package(pairs.sparkSession)  # the similarity UDF runs in Python workers
    # one pass over the (possibly expensive, possibly huge) input: its distinct pairs
    p = cut_lineage(pairs.select("raw_make", "raw_model")
                    .where(F.col("raw_model").isNotNull() & (F.col("raw_model") != "")).distinct())
    mk = resolve_makes(p.select("raw_make"), cat, fuzzy=make_fuzzy)
    p = p.join(mk, "raw_make", "left")

    t = model_tables(cat)
    by_slug, ns = t["by_slug"], t["nospace"]
    has_models = cat.models.where(F.col("model").isNotNull()).select("make").distinct()
    known = cat.makes.select("make").distinct()
    facts = catalog_facts(cat)
    n_mk = facts["make"][0]
    n_md, md_lens = facts["model"]
    p = cut_lineage(p.join(bounded_broadcast(has_models.withColumn("has_models", F.lit(True)), n_mk), "make", "left")
                    .join(bounded_broadcast(known.withColumn("known_make", F.lit(True)), n_mk), "make", "left")
                    .withColumn("slug_in", slug("raw_model")))

    work = p.where(F.col("has_models")).select("make", "slug_in").distinct()

    # Cheap equi stages on every distinct pair: override (optional), exact, no-space.
    w = work
    cols = []
    if use_overrides and cat.overrides is not None:
        ov = sized_broadcast(cat.overrides.select(
            "make_slug", F.col("raw_slug").alias("slug_in"), F.col("label").alias("m_override"))
            .groupBy("make_slug", "slug_in").agg(F.max("m_override").alias("m_override")))
        w = w.withColumn("make_slug", slug("make")).join(ov, ["make_slug", "slug_in"], "left").drop("make_slug")
        cols.append(("override", "m_override"))
    ex = bounded_broadcast(by_slug.select("make", F.col("mslug").alias("slug_in"), F.col("model").alias("m_exact")), n_md)
    nsb = bounded_broadcast(ns.select("make", F.col("ns").alias("_k"), F.col("model").alias("m_nospace")), n_md)
    w = (w.join(ex, ["make", "slug_in"], "left")
         .withColumn("_k", nospace("slug_in")).join(nsb, ["make", "_k"], "left").drop("_k"))
    cols += [("exact", "m_exact"), ("nospace", "m_nospace")]
    w = cut_lineage(w)
    rest = w.where(F.coalesce(*[F.col(c) for _, c in cols]).isNull()).select("make", "slug_in")

    # Guarded similarity on the remainder only; equi-join on compatible length.
    if fuzzy:
        cand = bounded_broadcast(by_slug.select("make", "mslug", F.col("model").alias("cmodel"),
                                                F.length("mslug").alias("clen"), sign_mask(F.col("mslug")).alias("_cm")), n_md)
        scored = (spread(rest.where(~is_short_or_numeric(F.col("slug_in"))), "make", "slug_in")
                  .withColumn("_im", sign_mask(F.col("slug_in")))
                  .withColumn("clen", F.explode(compatible_lengths(F.length("slug_in"), cutoff, md_lens)))
                  .join(cand, ["make", "clen"]).where(can_reach(cutoff))
                  .withColumn("score", ratio("mslug", "slug_in"))
                  .where(F.col("score") >= cutoff))
        fz = scored.groupBy("make", "slug_in").agg(
            F.max_by("cmodel", F.struct("score", "mslug")).alias("m_fuzzy"))
    else:
        fz = None

    if fz is not None:
        w = w.join(fz, ["make", "slug_in"], "left")
        cols.append(("fuzzy", "m_fuzzy"))

    # Catalogue slug (len >= 2) inside the input, E9: input (len >= 2) inside a catalogue
    # slug; the longest catalogue slug wins, then the first in dict order. Each pair looks
    # through the list of its own make, in the row: no explosion, no shuffle.
    items = bounded_broadcast(by_slug.groupBy("make").agg(F.collect_list(F.struct(
        "mslug", F.length("mslug").alias("n"), "first_pos", F.col("model").alias("cmodel"))).alias("_items")), n_md)
    resolved = F.coalesce(*[F.col(c) for _, c in cols]).isNotNull()

    def best(fits) -> Column:
        hits = F.transform(F.filter("_items", fits), lambda i: F.struct(i["n"], -i["first_pos"], i["cmodel"].alias("cmodel")))
        return F.when(~resolved, F.array_max(hits)["cmodel"])

    slug_in = F.col("slug_in")
    w = (w.join(items, "make", "left")
         .withColumn("m_contains", best(lambda i: (i["n"] >= 2) & F.contains(slug_in, i["mslug"])))
         .withColumn("m_contained", best(lambda i: (F.length(slug_in) >= 2) & F.contains(i["mslug"], slug_in)))
         .drop("_items"))
    cols += [("contains", "m_contains"), ("contained", "m_contained")]

    stage = None
    for name, c in cols:
        stage = (F.when(F.col(c).isNotNull(), F.lit(name)) if stage is None
                 else stage.when(F.col(c).isNotNull(), F.lit(name)))
    hits = w.select("make", "slug_in", F.coalesce(*[F.col(c) for _, c in cols]).alias("model"),
                    stage.alias("model_stage"))

    out = p.join(hits, ["make", "slug_in"], "left")
    reason = (F.when(F.col("known_make").isNull() & F.col("has_models").isNull(), F.lit("UNKNOWN_MAKE"))
              .when(F.col("has_models").isNull(), F.lit("NO_MODELS"))
              .when(F.col("model").isNull(), F.lit("UNMATCHED")))
    return out.select(
        "raw_make", "raw_model", "make", "make_stage",
        F.coalesce("model", "raw_model").alias("model"),
        "model_stage", reason.alias("reject_reason"), "slug_in")


def rejected_rows(resolved: DataFrame, listings: DataFrame) -> DataFrame:
    """B6 — unmatched values (``reason, make, slug, raw``) with the number of ``listings``
    (columns ``raw_make, raw_model``) that have them; ``resolved`` holds distinct pairs."""
    seen = listings.groupBy(F.col("raw_make").alias("_make"), F.col("raw_model").alias("_model")).agg(F.count("*").alias("n"))
    bad = resolved.where(F.col("reject_reason").isNotNull())
    # a listing without a make is rejected like any other
    return (bad.join(seen, bad["raw_make"].eqNullSafe(seen["_make"]) & bad["raw_model"].eqNullSafe(seen["_model"]))
            .groupBy(F.col("reject_reason").alias("reason"), "make",
                     F.col("slug_in").alias("slug"), F.col("raw_model").alias("raw"))
            .agg(F.sum("n").cast("long").alias("n")))


# ─────────────────────────── generations ───────────────────────────

def generation_tables(gens: DataFrame) -> dict[str, DataFrame]:
    """``gens``: (key_pos int, model string, gens array<struct<gen,from,to>>)."""
    exact = (gens.where(F.size("gens") > 0)
             .groupBy("model").agg(F.min_by("gens", "key_pos").alias("gens_exact")))
    by_slug = (gens.withColumn("kslug", slug("model"))
               .groupBy("kslug").agg(F.min_by("gens", "key_pos").alias("gens_slug")))
    return {"exact": exact, "slug": by_slug}


def first_interval(gens: Column, year: Column) -> Column:
    """E12 — first interval of the list with ``from <= year <= to`` (no row explosion)."""
    hit = F.filter(gens, lambda g: (g["from"] <= year) & (year <= g["to"]))
    return F.get(hit, 0)["gen"]


def lookup_generation(df: DataFrame, model_col: str, year_text_col: str, gens: DataFrame,
                      out_col: str = "generation", year_col: Column | None = None,
                      missing: str | None = "N/A") -> DataFrame:
    """E11 + E12 — generation of each row: key ``upper(strip(model))``, else first
    catalogue key with the same slug; year = first four characters (J17) unless
    ``year_col`` is given; ``missing`` when nothing matches."""
    gens = cut_lineage(gens)  # derived once; both tables have at most as many rows
    n = gens.count()
    t = generation_tables(gens)
    ex = bounded_broadcast(t["exact"].withColumnRenamed("model", "_gkey"), n)
    sl = bounded_broadcast(t["slug"], n)
    key = F.upper(pystrip(F.col(model_col)))
    y = year_col if year_col is not None else year_prefix4(F.col(year_text_col))
    tmp = (df.withColumn("_gkey", key).withColumn("_year", y)
           .join(ex, "_gkey", "left")
           .withColumn("kslug", slug("_gkey"))
           .join(sl, "kslug", "left"))
    g = first_interval(F.coalesce(F.col("gens_exact"), F.col("gens_slug")), F.col("_year"))
    val = F.when(F.col(model_col).isNull() | (F.col(model_col) == "") | F.col("_year").isNull(), F.lit(None)).otherwise(g)
    if missing is not None:
        val = F.coalesce(val, F.lit(missing))
    return tmp.withColumn(out_col, val).drop("_gkey", "_year", "gens_exact", "gens_slug", "kslug")


def lookup_generation_exact(df: DataFrame, model_col: str, year: Column, gens: DataFrame,
                            out_col: str = "generation") -> DataFrame:
    """K4 form — exact key only (case-sensitive), NULL when nothing matches."""
    gens = cut_lineage(gens)
    ex = bounded_broadcast(gens.groupBy("model").agg(F.min_by("gens", "key_pos").alias("_gens"))
                           .withColumnRenamed("model", "_gkey"), gens.count())
    tmp = df.withColumn("_gkey", F.col(model_col)).withColumn("_year", year).join(ex, "_gkey", "left")
    return (tmp.withColumn(out_col, first_interval(F.col("_gens"), F.col("_year")))
            .drop("_gkey", "_year", "_gens"))


def generation_backfill(store: DataFrame, gens: DataFrame) -> DataFrame:
    """K3 — change set ``(id, generation)`` of the store rows that were never tried
    (generation NULL): the generation found, ``N/A`` where there is none."""
    untried = store.where(F.col("generation").isNull()).select("id", "modele_unifie", "date_voiture")
    return lookup_generation(untried, "modele_unifie", "date_voiture", gens).select("id", "generation")


def generation_reindex(store: DataFrame, gens: DataFrame) -> DataFrame:
    """K4 — change set ``(id, generation)`` of the store rows tried in vain (``N/A``) that have
    one now: exact key, year behind the last ``/``."""
    again = store.where(F.col("generation") == "N/A").select("id", "modele_unifie", "date_voiture")
    out = lookup_generation_exact(again, "modele_unifie", year_after_slash(F.col("date_voiture")), gens)
    return out.where(F.col("generation").isNotNull()).select("id", "generation")


# ───────────────────────────── K1 ─────────────────────────────

def resolve_listings(listings: DataFrame, cat: Catalog, make_col: str = "marque",
                     model_col: str = "modele", gens: DataFrame | None = None,
                     year_col: str = "annee", fuzzy: bool = True) -> DataFrame:
    """K1 — add ``modele_unifie``, ``make_resolved``, ``stage`` (and ``generation``).

    Resolution runs on distinct (make, model) pairs; the result joins back on the raw
    pair. AQE splits a skewed join-back partition (a hot pair holding a large share of
    rows) and turns the join into a broadcast when the resolved vocabulary is small.
    """
    pairs = listings.select(F.col(make_col).alias("raw_make"), F.col(model_col).alias("raw_model"))
    res = resolve_models(pairs, cat, fuzzy=fuzzy).select(
        "raw_make", "raw_model", F.col("make").alias("make_resolved"),
        F.col("model").alias("modele_unifie"), F.col("model_stage").alias("stage"))
    # rows without a model resolve to nothing: they skip the join, where they would be one hot key
    has_model = F.coalesce(F.col(model_col) != "", F.lit(False))
    named, bare = listings.where(has_model), listings.where(~has_model)
    out = named.join(
        res, (named[make_col].eqNullSafe(res.raw_make)) & (named[model_col] == res.raw_model), "left"
    ).drop("raw_make", "raw_model")
    none = F.lit(None).cast("string")
    out = out.unionByName(bare.select("*", none.alias("make_resolved"), none.alias("modele_unifie"), none.alias("stage")))
    out = out.withColumn("modele_unifie", F.coalesce(F.col("modele_unifie"), F.col(model_col)))
    if gens is not None:
        out = lookup_generation(out, "modele_unifie", year_col, gens)
    return out
