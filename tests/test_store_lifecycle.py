"""Store and lifecycle operators: FIXTURES §5 vectors and properties (§5 of the survey)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carlot.operators.lifecycle import (classify_probe, expiry_run, flag_expired, gate_report, http_expiry_run,
                                        run_counters, sheet_prune, sheet_status, ttl_expiry_run)
from carlot.operators.store import first_per_key, insert_absent, last_per_key, to_store_rows, upsert

PROBE_SCHEMA = "lien string, source string, status int, final_url string, html string, error string"
TIMED = PROBE_SCHEMA + ", probed_at timestamp_ntz"


def test_probe_vectors(spark):
    rows = [
        ("https://a/1", "autoscout24", 200, "https://a/1", "x n'est malheureusement plus disponible x", None, True, "texte_expiration"),
        ("https://a/2", "autoscout24", 200, "https://a/2/?utm=1", "ok", None, False, "active"),
        ("https://a/3", "autoscout24", 200, "https://a/home", "ok", None, True, "url_redirect"),
        ("https://b/4", "aramisauto", 200, "https://b/vehicle-not-available", "", None, True, "url_redirect"),
        ("https://b/5", "aramisauto", 404, None, None, "http", True, "http_404"),
        ("https://b/6", "aramisauto", 410, None, None, "http", True, "http_410"),
        ("https://b/7", "autoscout24", 503, None, None, "http", False, "http_503_ambigu"),
        ("https://b/8", "autoscout24", None, None, None, "url", False, "url_error"),
        ("https://b/9", "autoscout24", None, None, None, "other", False, "erreur_inconnue"),
        ("https://c/1", "elsewhere", 200, "https://c/1", "ok", None, False, "source_inconnue"),
    ]
    df = spark.createDataFrame([r[:6] for r in rows], PROBE_SCHEMA)
    r = classify_probe(*[F.col(c) for c in ("lien", "source", "status", "final_url", "html", "error")])
    got = [(x.expired, x.reason) for x in df.select(r.alias("r")).select("r.*").collect()]
    assert got == [(r[6], r[7]) for r in rows]


def test_sheet_vectors(spark):
    df = spark.createDataFrame([(403, "", None), (404, "", None), (200, "Véhicule vendu", None), (200, "ok", None),
                                (None, None, "url")], "status int, html string, error string")
    got = [r[0] for r in df.select(sheet_status(F.col("status"), F.col("html"), F.col("error"))).collect()]
    assert got == ["ERREUR", "MORT", "MORT", "ACTIF", "ERREUR"]


def test_dedup_vector(spark):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(["a", "b", "a", "", "N/A", "N/A", None])],
                               "pos int, lien string")
    got = sorted((r.lien, r.pos) for r in first_per_key(df, "lien", ["pos"]).collect())
    assert got == [("N/A", 4), ("a", 0), ("b", 1)]


def _store(spark):
    return spark.createDataFrame([(1, "l1", 10.0, "x"), (2, "l2", 20.0, "y"), (3, None, 30.0, "z")],
                                 "id long, lien_annonce string, prix double, note string")


def test_upsert_semantics_and_idempotence(spark):
    store = _store(spark)
    batch = spark.createDataFrame([("l2", 21.0, 1), ("l2", 22.0, 2), ("l9", 90.0, 1)],
                                  "lien_annonce string, prix double, o int")
    once = upsert(store, batch, batch_order=["o"])
    twice = upsert(once, batch, batch_order=["o"])
    rows = sorted((r.id or 0, r.lien_annonce or "", r.prix, r.note) for r in once.collect())
    assert rows == [(0, "l9", 90.0, None), (1, "l1", 10.0, "x"), (2, "l2", 22.0, "y"), (3, "", 30.0, "z")]
    key = lambda df: sorted((r.id or 0, r.lien_annonce or "", r.prix, r.note, r.o) for r in df.collect())
    assert key(once) == key(twice)


def test_insert_absent_never_changes_old_rows(spark):
    store = _store(spark)
    batch = spark.createDataFrame([(7, "l1", 99.0, "new"), (8, "l8", 80.0, "a"), (9, "l8", 81.0, "b")],
                                  "id long, lien_annonce string, prix double, note string")
    out, ins = insert_absent(store, batch, batch_order=["id"])
    assert sorted((r.id, r.prix) for r in ins.collect()) == [(8, 80.0)]
    old = {r.id: (r.lien_annonce, r.prix) for r in out.collect() if r.id in (1, 2, 3)}
    assert old == {1: ("l1", 10.0), 2: ("l2", 20.0), 3: (None, 30.0)}


def _life_store(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, "https://a/1", "autoscout24", t(1), False), (2, "https://a/2", "autoscout24", t(2), False),
            (3, "https://b/3", "aramisauto", t(3), True), (4, "", "aramisauto", t(4), False),
            (5, "https://c/5", "leboncoin", t(10), False), (6, "https://a/6", "autoscout24", t(30), False)]
    return spark.createDataFrame(rows, "id long, lien_annonce string, source string, last_seen_at timestamp, is_expired boolean")


def test_http_and_ttl_runs(spark):
    store = _life_store(spark)
    t = lambda d: dt.datetime(2024, 1, d)
    probes = spark.createDataFrame([("https://a/1", "autoscout24", 410, None, None, "http", t(20)),
                                    ("https://a/1", "autoscout24", 503, None, None, "http", t(19)),
                                    ("https://a/2", "autoscout24", 404, None, None, "http", t(19)),
                                    ("https://a/2", "autoscout24", 200, "https://a/2", "ok", None, t(20))], TIMED)
    cs = http_expiry_run(store, probes, "2024-01-31 00:00:00", batch=10, stale_days=2,
                         source=["autoscout24", "aramisauto"])
    got = sorted((r.id, r.status, r.expired, r.reason) for r in cs.collect())
    assert got == [(1, "checked", True, "http_410"), (2, "checked", False, "active"), (4, "skipped", None, None)]
    ttl = ttl_expiry_run(store, "2024-01-31 00:00:00", ttl_days=7, source="leboncoin")
    assert [r.id for r in ttl.collect()] == [5]
    flagged = flag_expired(store, cs)
    assert {r.id: r.expire_reason for r in flagged.collect() if r.expire_reason} == {1: "http_check:http_410"}
    everything = expiry_run(store, probes, "2024-01-31 00:00:00", ttl_source="autoscout24")
    both = {r.id: r.expire_reason for r in flag_expired(store, everything).collect() if r.is_expired}
    assert both == {1: "http_check:http_410", 2: "lbc_ttl:7j", 3: None}
    unprobed = http_expiry_run(store, probes.where("lien <> 'https://a/2'"), "2024-01-31 00:00:00", batch=None)
    assert {r.id: (r.status, r.expired) for r in unprobed.collect()}[2] == ("not_probed", None)
    assert tuple(run_counters(unprobed).first()) == (1, 1, 0, 1, 1)
    with pytest.raises(ValueError):
        expiry_run(store, None, "2024-01-31 00:00:00", mode="http")
    assert {r.id: r.is_expired for r in flagged.collect()} == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False}


def test_gate_threshold(spark):
    t0 = dt.datetime(2024, 1, 30, 12)
    rows = [(i, f"l{i}", "s", t0) for i in range(350)] + [(1000 + i, f"o{i}", "s", dt.datetime(2024, 1, 1)) for i in range(12)]
    store = spark.createDataFrame(rows, "id long, lien_annonce string, source string, last_seen_at timestamp")
    th = spark.createDataFrame([("s", 350), ("s2", 351)], "source string, min_recent int")
    out = gate_report(store, "2024-01-31 00:00:00", th).collect()
    assert len(out) == 12 and all(r.allowed for r in out)
    assert sorted(r.sample_rank for r in out if r.sample_rank) == list(range(1, 11))
    th2 = spark.createDataFrame([("s", 351)], "source string, min_recent int")
    assert not any(r.allowed for r in gate_report(store, "2024-01-31 00:00:00", th2).collect())


def test_store_row_typing(spark):
    df = spark.createDataFrame([("T", "29 999 €", "12 000 km", "03/2019", "2019", "l", "img")],
                               "titre string, prix string, kilometrage string, date_mec string, annee string, lien string, image string")
    r = to_store_rows(df).collect()[0]
    assert (r.prix, r.kilometrage, r.date_voiture, r.generation, r.lien_annonce) == (29999.0, 12000.0, "03/2019", "N/A", "l")


def test_sheet_without_probe_or_with_several(spark):
    sheet = spark.createDataFrame([("http://x/1",), ("http://x/2",), ("http://x/3",), ("/local",), (None,)], "lien string")
    t = lambda d: dt.datetime(2024, 1, d)
    probes = spark.createDataFrame([("http://x/1", "s", 404, None, None, None, t(1)), ("http://x/1", "s", 200, None, "ok", None, t(2)),
                                    ("http://x/2", "s", 200, None, "Véhicule VENDU", None, t(1))], TIMED)
    got = {r.lien: r.statut for r in sheet_prune(sheet, probes).collect()}
    assert got == {"http://x/1": "ACTIF", "http://x/3": "NON_SONDE", "/local": None, None: None}


def test_page_texts_never_cross_a_shuffle(spark):
    probes = spark.createDataFrame([], TIMED)
    store = _life_store(spark)
    for df in (http_expiry_run(store, probes, "2024-01-31 00:00:00"), sheet_prune(probes.select("lien"), probes)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for exchange in plan.split("Exchange")[1:]:
            below = exchange.split("\n", 2)[1]
            assert "html" not in below or "Contains" in below, below


def test_empty_and_missing_keys(spark):
    store = spark.createDataFrame([(1, "a"), (2, None)], "id long, lien_annonce string")
    batch = spark.createDataFrame([(5, ""), (6, ""), (7, None), (8, None), (9, "a")], "id long, lien_annonce string")
    once = upsert(store, batch, batch_order=["id"])
    assert sorted((repr(r.lien_annonce), r.id) for r in once.collect()) == [
        ("''", 6), ("'a'", 9), ("None", 2), ("None", 7), ("None", 8)]
    keyed = batch.where("lien_annonce is not null")
    twice = upsert(upsert(store, keyed, batch_order=["id"]), keyed, batch_order=["id"])
    assert twice.where("lien_annonce = ''").count() == 1
    _, inserted = insert_absent(store, batch, batch_order=["id"])
    assert sorted((repr(r.lien_annonce), r.id) for r in inserted.collect()) == [("''", 5), ("None", 7), ("None", 8)]


def test_picks_carry_maps_and_need_an_order(spark):
    df = spark.createDataFrame([("k", 1, {"a": "x"}), ("k", 2, {"a": "y"})], "lien string, o int, m map<string,string>")
    assert first_per_key(df, "lien", ["o"]).first().m == {"a": "x"}
    assert last_per_key(df, "lien", ["o"]).first().m == {"a": "y"}
    with pytest.raises(ValueError):
        first_per_key(df, "lien", [])
