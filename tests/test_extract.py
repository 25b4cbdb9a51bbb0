"""Card extraction: HTML flattening, both card layouts, crawl prefix, JSON-LD, guid links."""

from pyspark.sql import functions as F

from carlot.operators.extract import (cards_to_listing_a, cards_to_listing_b, crawl_prefix, guid_links, html_cards,
                                      jsonld_blocks, jsonld_items, parse_cards)

PAGE_1 = """<html><body><nav><a href="/offres/nav">x</a></nav>
<article data-guid="g-1" data-make="mercedes-benz" data-model="classe a" data-price="29990" data-mileage="12000"
 data-first-registration="03-2019" data-fuel-type="d">
 <h2>Mercedes-Benz Classe A</h2><p>200 d&amp;Style</p><img src="a.jpg"><img src="b.jpg">
 <a href="/other">o</a><a href="/offres/mb-classe-a-g-1?x=1">go</a>
 <script>var no = "text";</script></article>
<article id="g-2"><h2>Peugeot 208 GT</h2><p>line1</p></article>
</body></html>"""

# 15-line layout-2 card (bullets included), as captured text
CARD_2_LINES = ["24 heures", "Kia Sportage", "Hybride 239 ch BVA6", "•", "Active", "Hybride essence", "•", "Auto.",
                "2026", "•", "Voiture 0 km", "29 999 €", "Dès 114 €/mois", "40 450 €", "Économisez 10 451 €"]


def test_parse_cards_layout1():
    cards = parse_cards(PAGE_1, layout=1, href_marker="/offres/")
    assert len(cards) == 2
    c = cards[0]
    assert c["attrs"]["data-guid"] == "g-1" and c["img"] == "a.jpg" and c["href"] == "/offres/mb-classe-a-g-1?x=1"
    assert [l.strip() for l in c["text"].split("\n") if l.strip()] == ["Mercedes-Benz Classe A", "200 d&Style", "o", "go"]


def test_listing_a(spark):
    pages = spark.createDataFrame([(1, PAGE_1)], "page_id long, html string")
    rows = cards_to_listing_a(html_cards(pages), "https://s.example").orderBy("card_pos").collect()
    a, b = rows
    assert (a.marque, a.modele, a.prix, a.kilometrage, a.annee, a.date_mec, a.carburant) == \
        ("Mercedes-Benz", "CLASSE A", "29990 €", "12000 km", "2019", "03/2019", "Diesel")
    assert a.lien == "https://s.example/offres/mb-classe-a-g-1" and a.titre == "Mercedes-Benz Classe A 200 d&Style"
    assert (b.marque, b.modele, b.prix, b.lien, b.puissance) == ("Peugeot", "208 GT", "N/A", "https://s.example/offres/-g-2", "N/A")


def test_listing_b_state_machine(spark):
    html = ('<a class="product-card x" href="/voiture/1?p=2" makerid="kia" modelid="sportage">'
            '<div class="product-card-content-wrapper">' + "".join(f"<span>{l}</span>" for l in CARD_2_LINES) +
            '</div><img src="k.jpg"></a>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    r = cards_to_listing_b(html_cards(pages, layout=2), "https://b.example").collect()[0]
    assert (r.disponibilite, r.titre, r.version, r.finition, r.carburant, r.boite) == \
        ("24 heures", "Kia Sportage Hybride 239 ch BVA6", "Hybride 239 ch BVA6", "Active", "Hybride essence", "Auto.")
    assert (r.annee, r.kilometrage, r.prix, r.mensualite, r.prix_origine, r.economie) == \
        ("2026", "0 km", "29 999 €", "Dès 114 €/mois", "40 450 €", "Économisez 10 451 €")
    assert (r.marque, r.modele, r.lien, r.image) == ("Kia", "SPORTAGE", "https://b.example/voiture/1", "k.jpg")


def test_crawl_prefix(spark):
    rows = [("c1", 1, False), ("c1", 2, False), ("c1", 3, True), ("c1", 4, False), ("c2", 1, False)]
    df = spark.createDataFrame(rows, "crawl string, page_num int, stop boolean")
    got = sorted((r.crawl, r.page_num) for r in crawl_prefix(df, "crawl", "page_num", F.col("stop"), max_pages=10).collect())
    assert got == [("c1", 1), ("c1", 2), ("c2", 1)]


def test_jsonld(spark):
    html = ('<script type="application/ld+json">{"@type":"ItemList","itemListElement":[{"item":{"@type":"Car",'
            '"url":"u1","name":"n1","brand":{"name":"Kia"},"offers":{"lowPrice":"100"},"mileageFromOdometer":{"value":5},'
            '"image":["i1","i2"],"modelDate":2020}},{"url":"u2","brand":"VW","mileageFromOdometer":7}]}</script>'
            '<script type="application/ld+json">{"@type":"Organization"}</script>'
            '<script type="application/ld+json">not json</script>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = jsonld_items(jsonld_blocks(pages), "block", keep=["page_id", "block_pos"]).orderBy("item_pos").collect()
    assert [(r.lien, r.marque, r.prix, r.kilometrage, r.image, r.annee) for r in rows] == \
        [("u1", "Kia", "100 EUR", "5", "i1", "2020"), ("u2", "VW", "N/A", "7", "N/A", "N/A")]


def test_guid_links(spark):
    a = spark.createDataFrame([(1, 0, "/offres/x-a-b-c-d-e?q"), (1, 1, "/offres/y-a-b-c-d-e"), (1, 2, "/p")],
                              "page_id long, a_pos int, href string")
    assert [(r.guid, r.path) for r in guid_links(a).collect()] == [("a-b-c-d-e", "/offres/x-a-b-c-d-e")]


def test_self_closing_nested_and_sourceless(spark):
    from carlot.operators.extract import parse_cards
    html = ('<article id="a"><script src="x"/><p>one</p><img alt="no source"><img src="late.jpg">'
            '<article id="b">two<a href="/offres/b">l</a></article>three</article><article id="c"/>after<article id="d">four</article>')
    cards = {c["attrs"]["id"]: c for c in parse_cards(html)}
    assert list(cards) == ["a", "b", "c", "d"]
    assert cards["a"]["text"] == "one\ntwo\nl\nthree"
    assert cards["a"]["img"] == "" and cards["a"]["href"] == "/offres/b"
    assert (cards["b"]["text"], cards["c"]["text"], cards["d"]["text"]) == ("two\nl", "", "four")


def test_guid_links(spark):
    from carlot.operators.extract import guid_links, html_cards, page_anchors, with_guid_links
    guid = "dfd82e9d-5166-42c7-8c3f-4f205e278cdf"
    html = (f'<a href="/offres/x-{guid}?utm=1">a</a><a href="/offres/y-{guid}">b</a><a>none</a>'
            f'<article data-guid="{guid}">one</article><article id="other">two</article>')
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    cards = with_guid_links(html_cards(pages), guid_links(page_anchors(pages)))
    assert sorted((r.card_pos, r.href) for r in cards.collect()) == [(0, f"/offres/x-{guid}"), (1, "")]


def test_jsonld_missing_empty_and_bad_items(spark):
    import json

    from carlot.operators.extract import jsonld_items
    full = {"url": "u", "brand": {"name": "B"}, "offers": {"price": 0, "lowPrice": 5, "priceCurrency": "CHF"}, "mileageFromOdometer": {"value": 7}}
    blocks = [json.dumps(x) for x in (
        {"@type": "Car", "url": "only"}, [full, None, {}, "", 0, {"url": "last"}], [{"url": "good"}, "x", {"url": "never"}],
        [{"url": "good2"}, {"url": "bad", "offers": [1]}, {"url": "never"}], {"@type": "Thing"}, 5)] + ["not json"]
    rows = jsonld_items(spark.createDataFrame([(i, b) for i, b in enumerate(blocks)], "i int, b string"), "b", ["i"]).collect()
    got = {(r.i, r.item_pos): (r.lien, r.marque, r.prix, r.kilometrage) for r in rows}
    assert got == {(0, 0): ("only", "N/A", "N/A", "N/A"), (1, 0): ("u", "B", "5 CHF", "7"), (1, 1): ("last", "N/A", "N/A", "N/A"),
                   (2, 0): ("good", "N/A", "N/A", "N/A"), (3, 0): ("good2", "N/A", "N/A", "N/A")}
