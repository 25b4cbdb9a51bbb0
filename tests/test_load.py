"""Loads: crawl ends, cards that fail, rejected rows, what each layout sends, counters of writes."""

import os

import pytest
from pyspark.sql import functions as F

from carlot.operators.extract import crawl_prefix, html_cards, parse_anchors, parse_cards
from carlot.operators.load import crawl, load_into_store, one_page_load, source_load
from carlot.operators.quality import catalogue_coverage
from carlot.operators.resolve import rejected_rows, resolve_models
from carlot.operators.store import last_per_link, patch_rows, split_rejects, upsert_rows
from carlot.sources.sinks import latest_version, write_counted, write_rejects

BAD = "<![bad[ x ]]>"
PAGES = "crawl string, page_num int, html string"


def seen():
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


def card_2(link, price, extra=""):
    lines = ["Disponible", "Peugeot", "208 GT", "Finition", "Essence", "Manuelle", "2019", "12 km", f"{price} €"]
    text = "".join(f"<p>{x}</p>" for x in lines)
    return f'<a class="product-card" href="{link}" makerid="peugeot" modelid="208">{extra}<div class="product-card-content-wrapper">{text}</div></a>'


def card_1(guid, price="100", extra=""):
    return f'<article data-guid="{guid}" data-make="peugeot" data-model="208" data-price="{price}">{extra}<h2>Peugeot 208</h2></article>'


def test_a_missing_page_ends_a_crawl(spark):
    rows = [("a", 1, False), ("a", 2, False), ("a", 4, False), ("a", 5, True), ("b", 2, False), ("b", 3, False),
            ("c", 1, False), ("c", 2, False), (None, 1, False), (None, 3, False), ("d", 1, True), ("d", 2, False)]
    pages = spark.createDataFrame(rows, "crawl string, page_num int, stop boolean")
    kept = lambda **kw: sorted(((r.crawl, r.page_num) for r in crawl_prefix(pages, "crawl", "page_num", F.col("stop"), **kw).collect()), key=repr)
    assert kept(first_page=1) == sorted([("a", 1), ("a", 2), ("c", 1), ("c", 2), (None, 1)], key=repr)
    assert kept(first_page=1, inclusive=True) == sorted([("a", 1), ("a", 2), ("c", 1), ("c", 2), (None, 1), ("d", 1)], key=repr)
    assert ("a", 4) in kept() and ("b", 2) in kept()


def test_a_card_fails_alone(spark):
    html = f"<p>top</p>{card_1('g1')}\n{card_1('g2', extra=BAD)}{BAD}{card_1('g3')}<a href='/offres/x'>x</a>{BAD}<a href='/offres/y'>y</a>"
    assert [(c["attrs"]["data-guid"], c["error"] is None) for c in parse_cards(html)] == [("g1", True), ("g2", False), ("g3", True)]
    assert parse_anchors(html) == ["/offres/x", "/offres/y"]
    nested = f"<article id=1>a<article id=2>{BAD}c</article>d</article><article id=3>e</article>"
    assert [c["error"] is None for c in parse_cards(nested)] == [False, False, True]
    assert [c["error"] is None for c in parse_cards("<article id=1>a</article>\n\n<article id=2><![ x")] == [True, False]
    rows = html_cards(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).collect()
    assert [(r.card_pos, r.attrs is None, r.error is None) for r in rows] == [(0, False, True), (1, True, False), (2, False, True)]


def test_rejects_beside_good_cards(spark, small_catalog):
    good = card_1("a-b-c-d-1") + card_1("a-b-c-d-2", "1.2.3") + card_1("a-b-c-d-3", extra=BAD) + card_1("a-b-c-d-4", "12.990")
    pages = spark.createDataFrame([("c", 1, good), ("c", 2, card_1("x", extra=BAD)), ("c", 3, good),
                                   ("d", 1, f"Access denied {card_1('y', extra=BAD)}")], PAGES)
    got = crawl(pages, 1, "https://s.example", "s", markers=["access denied"])
    assert sorted((r.crawl, r.page_num, r.card_pos) for r in got.listings.collect()) == [("c", 1, 0), ("c", 1, 3)]
    # page 2 has no good card: it ends the crawl, and its card is a reject too; a blocked page isn't read
    rejects = {(r.crawl, r.page_num, r.card_pos): r.reason.split(":")[0] for r in got.rejects.collect()}
    assert rejects == {("c", 1, 1): "prix_illisible", ("c", 1, 2): "carte_illisible", ("c", 2, 0): "carte_illisible"}


def test_layout_2_sends_everything_and_the_last_stays(spark, small_catalog):
    page = lambda *cards: f"<html>{''.join(cards)}</html>"
    pages = spark.createDataFrame([("c", 1, page(card_2("/v/1", 100), card_2("", 1), card_2("/v/2", 5))),
                                   ("c", 2, page(card_2("/v/1?x", 200), card_2("#", 2), card_2("/v/1", 200)))], PAGES)
    rows = source_load(pages, 2, small_catalog, "https://b.example", "b", seen_at=seen(), fuzzy=False)
    assert sorted((r.lien_annonce, r.prix) for r in rows.collect()) == [
        ("N/A", 2.0), ("https://b.example/v/1", 200.0), ("https://b.example/v/2", 5.0)]
    one = one_page_load(pages, 2, small_catalog, "https://b.example", "b", seen_at=seen(), fuzzy=False)
    assert [(r.card_pos, r.prix) for r in one.orderBy("card_pos").collect()] == [(0, 100.0), (1, 1.0), (2, 5.0)]


def test_one_page_load_is_not_deduplicated(spark, small_catalog, tmp_path):
    pages = spark.createDataFrame([("c", 1, card_1("g", "1") + card_1("g", "2") + card_1("g", "3"))], PAGES)
    rows = one_page_load(pages, 1, small_catalog, "https://s.example", "s", seen_at=seen(), fuzzy=False)
    assert sorted(r.prix for r in rows.collect()) == [1.0, 2.0, 3.0]
    base = os.path.join(str(tmp_path), "store")
    assert load_into_store(rows, base) == {"sent": 3, "inserted": 1, "updated": 0, "unchanged": 0, "kept": 0, "errors": 0}
    stored = latest_version(spark, base)
    assert [r.prix for r in stored.collect()] == [3.0] and "card_pos" not in stored.columns
    # first per link under G1
    assert [r.prix for r in source_load(pages, 1, small_catalog, "https://s.example", "s", fuzzy=False).collect()] == [1.0]


def test_counters_of_an_upsert(spark, tmp_path):
    store = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, None, 4.0)], "id long, lien_annonce string, prix double")
    batch = spark.createDataFrame([(1, "a", 9.0), (2, "a", 8.0), (3, "b", 2.0), (4, "d", 1.0), (5, None, 1.0), (6, "", None), (7, "c", -1.0)],
                                  "o long, lien_annonce string, prix double")
    good, bad = split_rejects(batch, {"prix_negatif": F.col("prix") < 0, "unreachable": F.col("prix") < -5})
    assert [(r.lien_annonce, r.reason) for r in bad.collect()] == [("c", "prix_negatif")]
    rows = upsert_rows(store, good, batch_order=["o"])
    path = os.path.join(str(tmp_path), "t")
    assert write_counted(rows, path) == {"sent": 6, "inserted": 3, "updated": 1, "unchanged": 1, "kept": 2}
    written = spark.read.parquet(path)
    assert "_status" not in written.columns and written.count() == 7
    assert {r.lien_annonce: r.prix for r in written.where("lien_annonce IN ('a', 'b', 'c')").collect()} == {"a": 8.0, "b": 2.0, "c": 3.0}
    assert write_rejects(bad, os.path.join(str(tmp_path), "bad")) == 1
    assert write_counted(upsert_rows(store, good.limit(0), batch_order=["o"]), os.path.join(str(tmp_path), "none"))["sent"] == 0


def test_counters_of_a_patch(spark, tmp_path):
    store = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "id long, m string, o string")
    updates = spark.createDataFrame([(1, "a"), (2, "c"), (9, "no such row")], "id long, m string")
    counters = write_counted(patch_rows(store, updates, "id", ["m"]), os.path.join(str(tmp_path), "t"))
    assert counters == {"sent": 2, "inserted": 0, "updated": 1, "unchanged": 1, "kept": 1}


def test_counting_takes_no_second_pass(spark, tmp_path):
    """The counters come from the job that writes: its rows are computed once."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def watched(x):
        made.add(1)
        return x

    batch = spark.range(50).repartition(2).select(watched("id").alias("prix"), F.col("id").cast("string").alias("lien_annonce"))
    store = spark.createDataFrame([], "lien_annonce string, prix long")
    assert write_counted(upsert_rows(store, batch, batch_order=["prix"]), os.path.join(str(tmp_path), "t"))["inserted"] == 50
    assert made.value == 50


def test_last_per_link(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, ""), (4, ""), (5, None), (6, None)], "o long, lien string")
    assert sorted(r.o for r in last_per_link(df, "lien", ["o"]).collect()) == [2, 4, 5, 6]


def test_listings_without_a_make_are_reported(spark, small_catalog):
    listings = spark.createDataFrame([(1, None, "208"), (2, None, "208"), (3, "Peugeot", "208")], "i long, raw_make string, raw_model string")
    covered = {r.i: (r.model, r.found) for r in catalogue_coverage(listings, small_catalog).collect()}
    assert covered == {1: ("208", False), 2: ("208", False), 3: ("208", True)}
    assert [(r.reason, r.n) for r in rejected_rows(resolve_models(listings, small_catalog), listings).collect()] == [("UNKNOWN_MAKE", 2)]


@pytest.mark.parametrize("missing", ["carlot.llm.nothing", "no_such_module"])
def test_import_errors_inside_the_operators_are_not_swallowed(monkeypatch, missing):
    import builtins
    import importlib

    import __spark_entry__ as entry
    real = builtins.__import__

    def failing(name, *args, **kw):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return real(name, *args, **kw)

    monkeypatch.setattr(builtins, "__import__", failing)
    with pytest.raises(ModuleNotFoundError):
        importlib.reload(entry)
    monkeypatch.undo()
    importlib.reload(entry)
