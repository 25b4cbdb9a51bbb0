"""JSON-dump ingest: field-role detection, brand/model from titles, typed rows (A1, F1–F3,
D3, D4, J24–J26, E15, E16, C6, K13).

The dump schema is data-dependent (which ``text-body-2*`` column holds the year, the
mileage, the fuel), so the import is two Spark jobs: an aggregate whose answer has at
most three rows is collected to choose columns, then a narrow projection and an
insert-if-absent join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.functions.codes import (BRAND_CANONICAL, DUMP_FUEL_KEYWORDS, MODEL_WORD_TO_BRAND,
                                    TITLE_BRANDS, TITLE_NOISE_PREFIXES)
from carlot.functions.numbers import digits_to_long, first_nonzero, is_year_like
from carlot.functions.text import WS, pystrip, repair_encoding
from carlot.operators.store import insert_absent
from carlot.session import bounded_broadcast, cut_lineage, sized_broadcast
from carlot.sources.json_arrays import array_items, text_fields

ROLES = ("annee", "km", "carburant")


def read_dumps(spark, paths: Sequence[str] | str) -> DataFrame:
    """A1 — JSON-array dump files, every value as text, with the place of each item: ``_file``
    (place of its path among ``paths``, file name) and ``_pos`` (split, number in it), in the order
    in which the files are given and read. A file is read by as many tasks as it has splits."""
    out = None
    for i, path in enumerate([paths] if isinstance(paths, str) else paths):
        items = array_items(spark, path).withColumns({
            "_file": F.struct(F.lit(i).alias("place"), "name"), "_pos": F.struct("block", "nth")})
        items = text_fields(items, ["_file", "_pos"])
        out = items if out is None else out.unionByName(items, allowMissingColumns=True)
    return out


def strip_noise_prefix(title: Column, prefixes: Sequence[str] = TITLE_NOISE_PREFIXES) -> Column:
    """J24 — remove the first matching leading noise word (case-insensitive), then strip."""
    import re
    alt = "|".join(re.escape(p) for p in prefixes)
    hit = F.lower(title).rlike("^(?:" + alt + ")")
    return F.when(hit, pystrip(F.regexp_replace(title, "(?iu)^(?:" + alt + ")", ""))).otherwise(title)


def brand_tables(spark, brands: Sequence[str] = TITLE_BRANDS, canonical: dict | None = None,
                 model_to_brand: dict | None = None) -> tuple[DataFrame, DataFrame]:
    canon = canonical if canonical is not None else BRAND_CANONICAL
    b = spark.createDataFrame(
        [(i, br, br.lower(), len(br), canon.get(br.lower(), br)) for i, br in enumerate(brands)],
        "priority int, brand string, brand_lower string, blen int, canonical string")
    m = spark.createDataFrame(list((model_to_brand if model_to_brand is not None else MODEL_WORD_TO_BRAND).items()),
                              "word string, word_brand string")
    return b, m


def brand_model_from_title(df: DataFrame, title_col: str, brands: DataFrame, words: DataFrame,
                           out_brand: str = "marque", out_model: str = "modele") -> DataFrame:
    """J25 — J14 → J24 → E15 (brand prefix, list priority) → E16 (first word) → (NULL, first word).

    E15 is one lookup for each length that occurs in the (small, size-checked) brand list:
    the title's prefix of that length is looked up in a broadcast table, and the best priority
    of the hits wins. Titles are neither shuffled nor made distinct.
    """
    ws = WS()
    b = cut_lineage(brands.groupBy("brand_lower", "blen").agg(F.min(F.struct("priority", "blen", "canonical")).alias("b")))
    w = cut_lineage(words.groupBy(F.col("word").alias("_fw")).agg(F.min("word_brand").alias("word_brand")))
    by_length = {r["blen"]: r["n"] for r in b.groupBy("blen").agg(F.count("*").alias("n")).collect()}  # one row a length
    t = (df.withColumn("_t", strip_noise_prefix(pystrip(repair_encoding(F.col(title_col)))))
         .withColumn("_tl", F.lower("_t")))
    hits = []
    for length, n in sorted(by_length.items()):
        own = bounded_broadcast(b.where(F.col("blen") == length).select(
            F.col("brand_lower").alias(f"_p{length}"), F.col("b").alias(f"_b{length}")), n)
        t = t.withColumn("_p", F.when(F.length("_tl") >= length, F.substring("_tl", 1, length)))
        t = t.join(own, t["_p"] == own[f"_p{length}"], "left").drop("_p", f"_p{length}")
        hits.append(f"_b{length}")
    none = F.lit(None).cast(b.schema["b"].dataType)
    t = t.withColumn("_b", F.least(*hits) if len(hits) > 1 else F.col(hits[0]) if hits else none).drop(*hits)
    wb = sized_broadcast(w)
    t = t.withColumn("_fw", F.get(F.split(F.col("_tl"), ws + "+"), 0)).join(wb, "_fw", "left")
    first_of = lambda c: F.get(F.split(pystrip(c), ws + "+"), 0)
    rest = pystrip(F.expr("substring(_t, _b.blen + 1)"))
    brand = F.when(F.col("_b").isNotNull(), F.col("_b.canonical")).otherwise(F.col("word_brand"))
    model = (F.when(F.col("_b").isNotNull(), F.coalesce(F.when(rest != "", first_of(rest)), F.lit("")))
             .otherwise(F.when(pystrip(F.col("_t")) != "", first_of(F.col("_t")))))
    return t.withColumn(out_brand, brand).withColumn(out_model, model).drop(
        "_t", "_tl", "_b", "_fw", "word_brand")


def field_role_scores(items: DataFrame, prefix: str = "text-body-2",
                      fuel_words: Sequence[str] = DUMP_FUEL_KEYWORDS) -> DataFrame:
    """F1 — per candidate column: non-empty count and year / km / fuel hit counts.

    Candidate columns become (field, value) rows (an explode of structs — an unpivot),
    then one hash aggregate (partial before the shuffle) counts per field.
    """
    cands = sorted(c for c in items.columns if c.startswith(prefix))
    if not cands:
        raise ValueError(f"no candidate columns starting with {prefix!r}")
    long = items.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("raw")) for c in cands])).alias("x")
    ).select("x.field", "x.raw")
    v = pystrip(repair_encoding(F.col("raw")))
    low = F.lower(v)
    fuel = F.lit(False)
    for w in fuel_words:
        fuel = fuel | F.contains(low, F.lit(w))
    nonempty = F.col("raw").isNotNull() & (F.col("raw") != "")
    return (long.where(nonempty)
            .groupBy("field")
            .agg(F.count("*").cast("long").alias("total"),
                 F.count_if(is_year_like(v)).cast("long").alias("annee"),
                 F.count_if(F.contains(low, F.lit("km"))).cast("long").alias("km"),
                 F.count_if(fuel).cast("long").alias("carburant")))


def best_roles(scores: DataFrame) -> DataFrame:
    """F2 — per role, the column with the best hit ratio, kept only when it has hits.
    Ties go to the smallest column name (deterministic, Q13)."""
    long = scores.select("field", "total", F.explode(F.array(*[
        F.struct(F.lit(r).alias("role"), F.col(r).alias("hits")) for r in ROLES])).alias("x")).select(
        "field", "total", "x.role", "x.hits")
    ratio = F.col("hits") / F.greatest(F.col("total"), F.lit(1))
    return (long.groupBy("role")
            .agg(F.min_by(F.struct("field", "hits"), F.struct(-ratio, F.col("field"))).alias("b"))
            .where(F.col("b.hits") > 0)
            .select("role", F.col("b.field").alias("field"), F.col("b.hits").alias("hits")))


def decided_roles(items: DataFrame, prefix: str = "text-body-2") -> dict[str, str] | None:
    """The ≤ 3-row mapping of roles to columns; None while year or mileage is undetected."""
    if not any(c.startswith(prefix) for c in items.columns):
        return None
    mapping = {r["role"]: r["field"] for r in best_roles(field_role_scores(items, prefix)).collect()}
    return mapping if "annee" in mapping and "km" in mapping else None


def detect_roles(items: DataFrame, prefix: str = "text-body-2") -> dict[str, str]:
    """F3 — collect the ≤ 3-row mapping; abort when year or mileage is undetected."""
    mapping = decided_roles(items, prefix)
    if mapping is None:
        raise ValueError("year/mileage columns not detected")
    return mapping


#: Fields of a dump item that an import reads besides those of its roles.
DUMP_FIELDS = ("text-body-1", "text-callout", "text-success", "absolute href", "absolute src")


def field_columns(items: DataFrame, fields: Iterable[str] | None = None, prefix: str = "text-body-2") -> DataFrame:
    """Items ``(_file, _pos, item map<string,string>)`` with a column for each field that an import reads;
    ``fields`` are the columns of the roles, by default all that occur with ``prefix``."""
    if fields is None:
        names = items.select(F.explode(F.map_keys("item")).alias("k")).where(F.col("k").startswith(prefix)).distinct()
        fields = sorted(r["k"] for r in names.collect())  # names of fields
    wanted = [*dict.fromkeys([*fields, *DUMP_FIELDS])]
    return items.select("_file", "_pos", *[F.col("item")[c].alias(c) for c in wanted])


def dump_rows(items: DataFrame, mapping: dict[str, str], brands: DataFrame, words: DataFrame,
              source: str = "leboncoin", seen_at: Column | None = None,
              title_col: str = "text-body-1", price_cols: Sequence[str] = ("text-callout", "text-success"),
              link_col: str = "absolute href", image_col: str = "absolute src") -> DataFrame:
    """C6 + D3 + D4 — dump item → store row (rows lacking year / mileage / price / make are dropped)."""
    def c(name: str) -> Column:
        return F.col(f"`{name}`") if name in items.columns else F.lit(None).cast("string")

    f_year, f_km, f_fuel = mapping["annee"], mapping["km"], mapping.get("carburant")
    req = c(f_year).isNotNull() & (c(f_year) != "") & c(f_km).isNotNull() & (c(f_km) != "")
    base = items.where(req)
    base = brand_model_from_title(base, title_col, brands, words)
    prix = first_nonzero(digits_to_long(c(price_cols[0])), digits_to_long(c(price_cols[1])))
    km = digits_to_long(c(f_km))
    year = digits_to_long(c(f_year))
    fuel = repair_encoding(c(f_fuel)) if f_fuel else F.lit("")
    rows = base.select(
        *[F.col(k) for k in ("_file", "_pos") if k in items.columns],
        pystrip(repair_encoding(c(title_col))).alias("titre"),
        prix.alias("prix"), km.alias("kilometrage"), year.cast("string").alias("date_voiture"),
        F.col("marque"), F.col("modele"), F.col("modele").alias("modele_unifie"),
        c(link_col).alias("lien_annonce"), c(image_col).alias("lien_image"),
        F.lit(source).alias("source"), fuel.alias("carburant"), F.lit(True).alias("is_active"),
        (seen_at if seen_at is not None else F.current_timestamp()).alias("last_seen_at"))
    return rows.where(F.col("prix").isNotNull() & (F.col("prix") != 0) &
                      F.col("kilometrage").isNotNull() & (F.col("kilometrage") != 0) &
                      F.col("marque").isNotNull() & (F.col("marque") != ""))


def import_dump(store: DataFrame, items: DataFrame, brands: DataFrame, words: DataFrame,
                order: Sequence[str] | None = None, mapping: dict[str, str] | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """K13 — A1 → F1/F2/F3 → C6 → D3/D4 → B4. Returns ``(new_store, inserted)``.

    Inside the batch the first item per link wins, in ``order`` (default: file order,
    ``_file`` then ``_pos`` from ``read_dumps``). ``mapping``: field roles that are known already."""
    mapping = mapping or detect_roles(items)
    rows = dump_rows(items, mapping, brands, words, **kw)
    order = list(order) if order else [c for c in ("_file", "_pos") if c in rows.columns]
    new_store, inserted = insert_absent(store, rows, "lien_annonce", batch_order=order)
    drop = [c for c in ("_file", "_pos") if c in inserted.columns]
    return new_store.drop(*drop), inserted.drop(*drop)
