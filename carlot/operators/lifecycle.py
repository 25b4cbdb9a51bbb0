"""Listing lifecycle: stale / TTL selection, probe classification, expiry change sets,
safety-gated stale report, sheet liveness (D5–D7, D12, H1, H2, F4, F6, K2–K11).

Live HTTP probing is not a Spark job; its *results* are a table
``(lien, source, status int, final_url, html, error, probed_at)`` with ``error`` in
``http | url | other | NULL``, and every decision below is a join + ``CASE`` on it. Of
several probes of a link the latest counts; a link without one is ``not_probed``, never
active. Page texts are reduced to a flag where they are read, before any shuffle.
``as_of`` is always a parameter (a timestamp literal) so runs are repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carlot.functions.codes import SAFE_THRESHOLDS, SHEET_DEAD_TEXTS, SOLD_TEXT_1, UNAVAILABLE_URL_MARK_2
from carlot.functions.urls import url_key
from carlot.operators.store import patch
from carlot.session import BROADCAST_MAX_ROWS

PROBED_SOURCES = ["autoscout24", "aramisauto"]


def _ts(as_of) -> Column:
    # wall-clock literal: compared with TIMESTAMP_NTZ columns without any session-zone shift
    return F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of


def stale(store: DataFrame, as_of, days: int, sources: Sequence[str] | str | None = None) -> DataFrame:
    """D5 — not expired, ``last_seen_at < as_of − days``, source ``=`` / ``IN``."""
    cond = (~F.coalesce(F.col("is_expired"), F.lit(False))) & \
           (F.col("last_seen_at") < _ts(as_of) - F.make_dt_interval(days=F.lit(days)))
    srcs = [sources] if isinstance(sources, str) else list(sources or PROBED_SOURCES)
    return store.where(cond & F.col("source").isin(srcs))


def oldest_first(df: DataFrame, n: int | None) -> DataFrame:
    """H1 — the ``n`` oldest rows (``ORDER BY last_seen_at, id LIMIT n``; a top-N sort);
    all rows without a limit."""
    return df if n is None else df.orderBy("last_seen_at", "id").limit(n)


def ttl_due(store: DataFrame, as_of, ttl_days: int, source: str) -> DataFrame:
    """D6 — not expired, ``source = X``, ``last_seen_at < as_of − ttl``."""
    cond = (~F.coalesce(F.col("is_expired"), F.lit(False))) & (F.col("source") == source) & \
           (F.col("last_seen_at") < _ts(as_of) - F.make_dt_interval(days=F.lit(ttl_days)))
    return store.where(cond)


def recent(store: DataFrame, as_of, hours: int = 24) -> Column:
    """D7 — ``last_seen_at >= as_of − hours`` as a predicate column."""
    return F.col("last_seen_at") >= _ts(as_of) - F.make_dt_interval(hours=F.lit(hours))


def eligibility(lien: Column, source: Column, sources: Sequence[str] = PROBED_SOURCES) -> Column:
    """D12 — ``skipped`` when the link is empty or the source is not probed."""
    bad = lien.isNull() | (lien == "") | ~F.coalesce(source.isin(list(sources)), F.lit(False))
    return F.when(bad, F.lit("skipped")).otherwise(F.lit("eligible"))


def classify_probe(lien: Column, source: Column, status: Column, final_url: Column,
                   html: Column, error: Column, sold_text: str = SOLD_TEXT_1,
                   unavailable_mark: str = UNAVAILABLE_URL_MARK_2) -> Column:
    """K5 — probe outcome → ``struct(expired boolean, reason string)``."""
    sold = F.contains(F.coalesce(html, F.lit("")), F.lit(sold_text))
    return classify_outcome(lien, source, status, final_url, sold, error, unavailable_mark)


def classify_outcome(lien: Column, source: Column, status: Column, final_url: Column, sold: Column,
                     error: Column, unavailable_mark: str = UNAVAILABLE_URL_MARK_2) -> Column:
    """K5 with the page text already reduced to ``sold``."""
    def out(expired: bool, reason) -> Column:
        r = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(expired).alias("expired"), r.alias("reason"))

    http_err = (error == "http") | (error.isNull() & (status >= 400))
    code = F.coalesce(status.cast("string"), F.lit("inconnu"))
    return (
        F.when(error == "url", out(False, "url_error"))
        .when(error == "other", out(False, "erreur_inconnue"))
        .when(http_err & F.coalesce(status.isin(404, 410), F.lit(False)), out(True, F.concat(F.lit("http_"), code)))
        .when(http_err, out(False, F.concat(F.lit("http_"), code, F.lit("_ambigu"))))
        .when(source == "autoscout24",
              F.when(sold, out(True, "texte_expiration"))
              .when(url_key(final_url) != url_key(lien), out(True, "url_redirect"))
              .otherwise(out(False, "active")))
        .when(source == "aramisauto",
              F.when(F.contains(F.coalesce(final_url, F.lit("")), F.lit(unavailable_mark)), out(True, "url_redirect"))
              .otherwise(out(False, "active")))
        .otherwise(out(False, "source_inconnue"))
    )


def latest_probe(probes: DataFrame, text_flag: Column, time_col: str = "probed_at") -> DataFrame:
    """One row per link, ``(_plien, p struct(status, final_url, flag, error))``: its latest probe
    (of probes at one time the greatest). ``text_flag`` is computed from the page text here, so
    the text itself is never shuffled."""
    final = F.col("final_url") if "final_url" in probes.columns else F.lit(None).cast("string")
    slim = probes.select(F.col("lien").alias("_plien"), F.col(time_col).alias("_at"), F.struct(
        F.col("status"), final.alias("final_url"), text_flag.alias("flag"), F.col("error")).alias("p"))
    return slim.where(F.col("_plien").isNotNull()).groupBy("_plien").agg(
        F.max_by("p", F.struct(F.col("_at").isNotNull(), "_at", "p")).alias("p"))


def http_expiry_run(store: DataFrame, probes: DataFrame, as_of, batch: int | None = 500,
                    stale_days: int = 2, source: str | Sequence[str] | None = None,
                    sold_text: str = SOLD_TEXT_1, unavailable_mark: str = UNAVAILABLE_URL_MARK_2) -> DataFrame:
    """K6 — D5 → H1 → D12 → K5 → change set; ``batch=None`` takes every stale listing.

    Returns one row per selected listing: ``id, lien_annonce, source, last_seen_at,
    status (checked | skipped | not_probed), expired, reason, expire_reason``. Only rows with
    ``expired`` go to the flag step (K8), with their ``expire_reason``."""
    picked = oldest_first(stale(store, as_of, stale_days, source), batch)
    links = picked.select(F.col("lien_annonce").alias("lien")).distinct()
    if batch is not None and batch <= BROADCAST_MAX_ROWS:
        links = F.broadcast(links)  # at most ``batch`` rows
    wanted = probes.join(links, "lien", "left_semi")
    p = latest_probe(wanted, F.contains(F.coalesce(F.col("html"), F.lit("")), F.lit(sold_text)))
    j = picked.join(p, picked["lien_annonce"] == p["_plien"], "left")
    probed = F.col("_plien").isNotNull()
    eligible = eligibility(F.col("lien_annonce"), F.col("source")) == "eligible"
    res = classify_outcome(F.col("lien_annonce"), F.col("source"), F.col("p.status"), F.col("p.final_url"),
                           F.col("p.flag"), F.col("p.error"), unavailable_mark)
    checked = eligible & probed
    return j.select(
        "id", "lien_annonce", "source", "last_seen_at",
        F.when(~eligible, F.lit("skipped")).when(~probed, F.lit("not_probed")).otherwise(F.lit("checked")).alias("status"),
        F.when(checked, res["expired"]).alias("expired"),
        F.when(checked, res["reason"]).alias("reason"),
        F.when(checked & res["expired"], F.concat(F.lit("http_check:"), res["reason"])).alias("expire_reason"))


def run_counters(change_set: DataFrame) -> DataFrame:
    """F6 — one row of counters of a run: checked, expired, unclear (checked, neither active nor
    expired), skipped, not_probed."""
    is_ = F.col("status")
    expired = F.coalesce(F.col("expired"), F.lit(False))
    return change_set.agg(
        F.count_if(is_ == "checked").cast("long").alias("checked"),
        F.count_if(expired).cast("long").alias("expired"),
        F.count_if((is_ == "checked") & ~expired & (F.col("reason") != "active")).cast("long").alias("unclear"),
        F.count_if(is_ == "skipped").cast("long").alias("skipped"),
        F.count_if(is_ == "not_probed").cast("long").alias("not_probed"))


def ttl_expiry_run(store: DataFrame, as_of, ttl_days: int = 7, source: str = "leboncoin") -> DataFrame:
    """K7 — D6 → change set with reason ``lbc_ttl:<d>j``."""
    return ttl_due(store, as_of, ttl_days, source).select(
        "id", "lien_annonce", "source", "last_seen_at",
        F.lit("expired").alias("status"), F.lit(True).alias("expired"),
        F.lit(f"lbc_ttl:{ttl_days}j").alias("reason"), F.lit(f"lbc_ttl:{ttl_days}j").alias("expire_reason"))


def expiry_run(store: DataFrame, probes: DataFrame | None, as_of, mode: str = "all", *,
               batch: int | None = None, stale_days: int = 2, source: str | Sequence[str] | None = None,
               ttl_days: int = 7, ttl_source: str = "leboncoin") -> DataFrame:
    """K9 — ``http`` / ``ttl`` / ``all`` (http first) as one change set; no limit unless ``batch``."""
    if mode not in ("http", "ttl", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode != "ttl" and probes is None:
        raise ValueError(f"mode {mode!r} needs probe results")
    parts = []
    if mode in ("http", "all"):
        parts.append(http_expiry_run(store, probes, as_of, batch, stale_days, source).withColumn("mode", F.lit("http")))
    if mode in ("ttl", "all"):
        parts.append(ttl_expiry_run(store, as_of, ttl_days, ttl_source).withColumn("mode", F.lit("ttl")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def flag_expired(store: DataFrame, change_set: DataFrame) -> DataFrame:
    """K8 — set ``is_expired`` (and, new, ``expire_reason``) for expired rows of a change set.
    A listing that several runs expire takes the reason of the first of them (http before ttl)."""
    run = F.col("mode") if "mode" in change_set.columns else F.lit("")  # "http" sorts before "ttl"
    upd = (change_set.where(F.col("expired"))
           .groupBy("id").agg(F.min_by("expire_reason", F.struct(run.alias("mode"), "expire_reason")).alias("expire_reason"))
           .withColumn("is_expired", F.lit(True)))
    s = store if "expire_reason" in store.columns else store.withColumn("expire_reason", F.lit(None).cast("string"))
    return patch(s, upd, "id", ["is_expired", "expire_reason"])


def gate_report(store: DataFrame, as_of, thresholds: DataFrame | None = None,
                hours: int = 24, sample: int = 10) -> DataFrame:
    """K10 / F4 / H2 — per source: recent-row count against the safety threshold, and
    the stale rows that a clean-up would remove, with the first ``sample`` ranked.

    Reports only; deletes nothing. Output: one row per stale candidate of a known
    source: ``source, id, lien_annonce, last_seen_at, recent_count, threshold,
    allowed, sample_rank`` (``sample_rank`` NULL beyond the sample).
    """
    spark = store.sparkSession
    th = thresholds if thresholds is not None else spark.createDataFrame(
        list(SAFE_THRESHOLDS.items()), "source string, min_recent int")
    is_recent = recent(store, as_of, hours)
    n = th.count()  # one row per source: a configuration table, broadcast only if it is one

    def small(df: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(df) if rows <= BROADCAST_MAX_ROWS else df

    counts = store.join(small(th.select("source"), n), "source", "left_semi").groupBy("source").agg(
        F.count_if(is_recent).cast("long").alias("recent_count"))
    verdict = (th.join(counts, "source", "left")
               .select("source", F.coalesce("recent_count", F.lit(0)).cast("long").alias("recent_count"),
                       F.col("min_recent").alias("threshold"),
                       (F.coalesce("recent_count", F.lit(0)) >= F.col("min_recent")).alias("allowed")))
    cand = store.where(~is_recent).join(small(verdict, n), "source")
    # row_number() <= k lets Spark insert a partial WindowGroupLimit before the shuffle,
    # so a hot source ships at most k rows per map task; the ranks come back to the
    # candidates as a table of at most k rows per source
    w = Window.partitionBy("source").orderBy("last_seen_at", "id")
    ranked = cand.select("source", "last_seen_at", "id", F.row_number().over(w).alias("rn")).where(F.col("rn") <= sample)
    out = cand.join(small(ranked.select("id", "rn"), n * sample), "id", "left")
    return out.select("source", "id", "lien_annonce", "last_seen_at", "recent_count", "threshold",
                      "allowed", F.col("rn").cast("int").alias("sample_rank"))


def has_dead_text(html: Column, dead_texts: Sequence[str] = SHEET_DEAD_TEXTS) -> Column:
    low = F.lower(F.coalesce(html, F.lit("")))
    dead = F.lit(False)
    for t in dead_texts:
        dead = dead | F.contains(low, F.lit(t))
    return dead


def sheet_status(status: Column, html: Column, error: Column,
                 dead_texts: Sequence[str] = SHEET_DEAD_TEXTS) -> Column:
    """K11 — ``MORT`` (404/410 or a sold text), ``ERREUR`` (403 or a failed probe), else ``ACTIF``."""
    return sheet_outcome(status, has_dead_text(html, dead_texts), error)


def sheet_outcome(status: Column, dead: Column, error: Column) -> Column:
    """K11 with the page text already reduced to ``dead``."""
    return (F.when(error.isNotNull() & (error != "http"), F.lit("ERREUR"))
            .when(status.isin(404, 410), F.lit("MORT"))
            .when(status == 403, F.lit("ERREUR"))
            .when(dead, F.lit("MORT"))
            .otherwise(F.lit("ACTIF")))


def sheet_prune(sheet: DataFrame, probes: DataFrame, link_col: str = "lien",
                dead_texts: Sequence[str] = SHEET_DEAD_TEXTS) -> DataFrame:
    """K11 + D10 — probe every ``http…`` link, drop ``MORT`` rows, keep everything else
    (rows without an ``http`` link are not checked, links without a probe are ``NON_SONDE``;
    both stay)."""
    p = latest_probe(probes, has_dead_text(F.col("html"), dead_texts))
    j = sheet.join(p, sheet[link_col] == p["_plien"], "left")
    checkable = F.coalesce(F.col(link_col).startswith("http"), F.lit(False))
    st = (F.when(checkable & F.col("_plien").isNull(), F.lit("NON_SONDE"))
          .when(checkable, sheet_outcome(F.col("p.status"), F.col("p.flag"), F.col("p.error"))))
    return j.select(*[sheet[c] for c in sheet.columns], st.alias("statut")).where(
        F.coalesce(F.col("statut"), F.lit("")) != "MORT")


def renormalize_backfill(store: DataFrame, cat, fuzzy: bool = True) -> DataFrame:
    """K2 — re-run model resolution over the whole store and return the change set
    ``(id, old, modele_unifie)`` of rows whose resolved model differs (D9); rows with an
    empty make or model are skipped. Apply it with ``store.patch(..., "id", ["modele_unifie"])``.

    Resolution runs once per distinct (make, model) pair, not per row."""
    from carlot.operators.resolve import resolve_models
    from carlot.operators.store import changed_only
    base = store.where((F.coalesce(F.col("marque"), F.lit("")) != "") &
                       (F.coalesce(F.col("modele"), F.lit("")) != ""))
    res = resolve_models(base.select(F.col("marque").alias("raw_make"), F.col("modele").alias("raw_model")),
                         cat, fuzzy=fuzzy).select("raw_make", "raw_model", F.col("model").alias("_new"))
    j = base.join(res, (base["marque"] == res["raw_make"]) & (base["modele"] == res["raw_model"]))
    return changed_only(j, "_new", "modele_unifie").select(
        "id", F.col("modele_unifie").alias("old"), F.col("_new").alias("modele_unifie"))
