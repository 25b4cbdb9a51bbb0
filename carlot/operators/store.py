"""Listing store operators: typing, dedup, upsert, insert-if-absent, keyed patch.

There is no transactional table format here, so every mutation is expressed as
"old table + change set → new table" (B8: the change set is always available as a
DataFrame, writing is a separate step; see ``carlot.sources.sinks.write_version``).

Scale notes
-----------
* First/last-per-key is an aggregate of ``min_by``/``max_by`` (the row by its ordering
  keys, so rows may hold maps). Partial aggregation runs before the shuffle, so a hot
  key (even a third of all rows) leaves each map task as one row — no task ever holds
  a whole group, unlike ``row_number`` over a window.
* Rows whose key is NULL are split off before any keyed join / aggregate (they would
  all hash to one partition) and handled without a shuffle.
* Upsert is one full outer join on the key; after dedup both sides are unique per key,
  so the join itself cannot be skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.functions.numbers import mileage_to_double, price_to_double

STORE_COLUMNS = ["titre", "prix", "kilometrage", "date_voiture", "marque", "modele", "modele_unifie",
                 "generation", "carburant", "lien_annonce", "lien_image", "source", "last_seen_at"]


def _key_ok(key: str) -> Column:
    return F.col(key).isNotNull() & (F.col(key) != "")


def _pick_per_key(df: DataFrame, key: str, order: Sequence[str], last: bool) -> DataFrame:
    """One row per key, with ``_sent``: how many rows of the key there were."""
    if not order:
        raise ValueError("the order of rows with one key must be given")
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*[F.col(c) for c in df.columns]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(F.col(key).alias("_key")).agg(row.alias("_row"), F.count("*").alias("_sent")).select("_row.*", "_sent")


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """G1 — first row per key in ``order``; rows with an empty / NULL key are dropped."""
    return _pick_per_key(df.where(_key_ok(key)), key, order, last=False).drop("_sent")


def last_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``; rows with an empty / NULL key are dropped."""
    return _pick_per_key(df.where(_key_ok(key)), key, order, last=True).drop("_sent")


def last_per_link(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``, an empty text being a key like any other: what an upsert of all
    rows in order leaves. Rows with a NULL key all stay."""
    keyed = _pick_per_key(df.where(F.col(key).isNotNull()), key, order, last=True).drop("_sent")
    return keyed.unionByName(df.where(F.col(key).isNull()))


def to_store_rows(listings: DataFrame, seen_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """C7 — canonical listing (all text) → typed store row (and the columns ``keep``).

    ``date_voiture`` is ``date_mec`` when the listing layout has that field, else
    ``annee``; ``generation`` defaults to ``N/A``; version, power, seller, place,
    gearbox, trim, original price, saving, monthly price, range, availability are dropped.
    """
    cols = set(listings.columns)

    def txt(c: str, default: str = "") -> Column:
        return F.coalesce(F.col(c), F.lit(default)) if c in cols else F.lit(default)

    date_voiture = txt("date_mec") if "date_mec" in cols else txt("annee")
    return listings.select(
        txt("titre").alias("titre"),
        price_to_double(txt("prix")).alias("prix"),
        mileage_to_double(txt("kilometrage")).alias("kilometrage"),
        date_voiture.alias("date_voiture"),
        txt("marque").alias("marque"),
        txt("modele").alias("modele"),
        txt("modele_unifie").alias("modele_unifie"),
        txt("generation", "N/A").alias("generation"),
        txt("carburant").alias("carburant"),
        txt("lien").alias("lien_annonce"),
        txt("image").alias("lien_image"),
        txt("source").alias("source"),
        (seen_at if seen_at is not None else F.current_timestamp()).alias("last_seen_at"),
        *keep,
    )


def upsert(store: DataFrame, batch: DataFrame, key: str = "lien_annonce", *,
           batch_order: Sequence[str]) -> DataFrame:
    """B3 — merge ``batch`` into ``store`` on ``key``.

    Columns present in the batch overwrite (even with NULL); columns absent from the
    batch keep the stored value; unseen keys are inserted. The batch is first reduced
    to its last row per key in ``batch_order`` (required: nothing in a table says which
    row came last). An empty text is a key like any other; rows with a NULL key cannot
    conflict and are appended.
    """
    return upsert_rows(store, batch, key, batch_order=batch_order).drop("_status", "_sent")


def upsert_rows(store: DataFrame, batch: DataFrame, key: str = "lien_annonce", *, batch_order: Sequence[str]) -> DataFrame:
    """B3 with what becomes of each row: ``_status`` (``inserted``, ``updated``, ``unchanged``: the
    batch holds just the stored values, ``kept``: not in the batch) and ``_sent``, the batch's rows
    of this key. ``sinks.write_counted`` counts them while it writes."""
    is_key = F.col(key).isNotNull()
    b_keyed = _pick_per_key(batch.where(is_key), key, batch_order, last=True)
    b_loose = batch.where(~is_key)
    s_keyed = store.where(is_key)
    s_loose = store.where(~is_key)

    s = s_keyed.select(*[F.col(c).alias(f"s__{c}") for c in store.columns])
    b = b_keyed.select(*[F.col(c).alias(f"b__{c}") for c in batch.columns], "_sent", F.lit(True).alias("b__present"))
    j = s.join(b, F.col(f"s__{key}") == F.col(f"b__{key}"), "full_outer")

    out_cols = list(store.columns) + [c for c in batch.columns if c not in store.columns]
    sel = []
    for c in out_cols:
        if c == key:
            sel.append(F.coalesce(F.col(f"b__{c}"), F.col(f"s__{c}")).alias(c))
        elif c in batch.columns and c in store.columns:
            sel.append(F.when(F.col("b__present"), F.col(f"b__{c}")).otherwise(F.col(f"s__{c}")).alias(c))
        elif c in batch.columns:
            sel.append(F.col(f"b__{c}").alias(c))
        else:
            sel.append(F.col(f"s__{c}").alias(c))
    same = F.lit(True)
    for c in batch.columns:
        if c in store.columns:
            same &= F.col(f"b__{c}").eqNullSafe(F.col(f"s__{c}"))
        elif c not in batch_order:  # a column that orders the batch alone is no value
            same &= F.col(f"b__{c}").isNull()
    status = (F.when(F.col("b__present").isNull(), F.lit("kept")).when(F.col(f"s__{key}").isNull(), F.lit("inserted"))
              .when(same, F.lit("unchanged")).otherwise(F.lit("updated")))
    merged = j.select(*sel, status.alias("_status"), F.coalesce("_sent", F.lit(0)).alias("_sent"))
    marked = lambda df, status, sent: df.withColumns({"_status": F.lit(status), "_sent": F.lit(sent).cast("long")})
    return (merged.unionByName(marked(s_loose, "kept", 0), allowMissingColumns=True)
            .unionByName(marked(b_loose, "inserted", 1), allowMissingColumns=True))


def insert_absent(store: DataFrame, batch: DataFrame, key: str = "lien_annonce", *,
                  batch_order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """B4 / E14 — append batch rows whose key is not stored yet; old rows never change.

    Returns ``(new_table, inserted_rows)``. Within the batch the first row per key in
    ``batch_order`` wins. An empty text is a key; rows with a NULL key never conflict and
    are all inserted.
    """
    is_key = F.col(key).isNotNull()
    fresh = _pick_per_key(batch.where(is_key), key, batch_order, last=False).drop("_sent")
    stored_keys = store.select(key).where(is_key)
    inserted = fresh.join(stored_keys, key, "left_anti").select(*batch.columns).unionByName(batch.where(~is_key))
    return store.unionByName(inserted, allowMissingColumns=True), inserted


def patch(store: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """B5 — keyed partial update: for matched keys the given columns take the update's
    value, everything else is unchanged. ``updates`` must be unique per key."""
    return patch_rows(store, updates, key, columns).drop("_status", "_sent")


def patch_rows(store: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """B5 with ``_status`` (``updated``, ``unchanged``: the update holds the stored values, ``kept``)
    and ``_sent`` of each row, as ``upsert_rows`` has them."""
    u = updates.select(F.col(key), *[F.col(c).alias(f"u__{c}") for c in columns],
                       F.lit(True).alias("u__hit"))
    j = store.join(u, key, "left")
    sel = [F.when(F.col("u__hit"), F.col(f"u__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
           for c in store.columns]
    same = F.lit(True)
    for c in columns:
        same &= F.col(f"u__{c}").eqNullSafe(F.col(c))
    hit = F.coalesce("u__hit", F.lit(False))
    status = F.when(~hit, F.lit("kept")).when(same, F.lit("unchanged")).otherwise(F.lit("updated"))
    return j.select(*sel, status.alias("_status"), hit.cast("long").alias("_sent"))


def split_rejects(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the others with the ``reason`` of the first of ``checks`` (reason ->
    condition of a bad row) that they fail."""
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    marked = rows.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def changed_only(df: DataFrame, new_col: str, old_col: str) -> DataFrame:
    """D9 — rows whose recomputed value differs from the stored one (NULL old = ``""``)."""
    return df.where(F.col(new_col) != F.coalesce(F.col(old_col), F.lit("")))


def union_sources(*dfs: DataFrame) -> DataFrame:
    """I1 — UNION ALL by name across layouts (missing columns become NULL)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def status_counts(df: DataFrame, status_col: str = "status") -> DataFrame:
    """F6 — run counters as a grouped count."""
    return df.groupBy(status_col).agg(F.count("*").cast("long").alias("n"))
