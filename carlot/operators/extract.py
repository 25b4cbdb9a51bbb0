"""Captured pages → cards → canonical listings.

Only the HTML flattening runs in Python (``mapInPandas`` with the standard-library
``html.parser``, one pass per page, Arrow batches). Everything after it — line
splitting, positional fields, the layout-2 line classifier, links, fuel codes,
prices, resolution — is native column work.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.functions.codes import BLOCK_MARKERS_1, CARD_FUELS, CARD_GEARBOXES, blocked, decode_fuel
from carlot.functions.numbers import registration_split
from carlot.functions.text import (LINE_BREAK_CHARS, WS, _as_col, line_break_class, squash, title_case,
                                  whitespace_chars)
from carlot.functions.urls import absolute_link
from carlot.session import ship_package, spread

CARD_SCHEMA = ("page_id long, card_pos int, attrs map<string,string>, text string, "
               "img string, href string, error string")

_SKIP_TEXT_IN = {"script", "style", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _CardParser(HTMLParser):
    """Collects cards from one page.

    ``layout=1``: every ``<article>``, nested ones too, in document order (attrs, text
    nodes joined by newline, ``src`` of the first ``img``, first ``a@href`` containing
    ``href_marker``).
    ``layout=2``: every ``<a class="product-card">``; text of the first
    ``.product-card-content-wrapper`` inside it when present, else of the anchor.

    Open cards form a stack, so a text node belongs to all cards around it. A
    self-closing tag is opened and closed at once; a missing end tag is closed by that of
    an element around it.
    """

    def __init__(self, layout: int, href_marker: str):
        super().__init__(convert_charrefs=True)
        self.layout, self.marker = layout, href_marker
        self.cards: list[dict] = []
        self.open: list[dict] = []  # cards around the current place
        self.stack: list[str] = []

    def _is_card(self, tag: str, attrs: dict) -> bool:
        if self.layout == 1:
            return tag == "article"
        return tag == "a" and "product-card" in (attrs.get("class") or "").split()

    def handle_starttag(self, tag, attrs_list):
        attrs = {k: (v if v is not None else "") for k, v in attrs_list}
        depth = len(self.stack) + 1
        for card in self.open:
            if tag == "img" and card["img"] is None:
                card["img"] = attrs.get("src", "")
            if self.layout == 1 and tag == "a" and card["href"] is None and self.marker in attrs.get("href", ""):
                card["href"] = attrs.get("href", "")
            if self.layout == 2 and not card["has_wrap"] and \
                    "product-card-content-wrapper" in (attrs.get("class") or "").split():
                card["has_wrap"], card["wrap_depth"] = True, depth
        if self._is_card(tag, attrs):
            card = {"attrs": attrs, "error": None, "parts": [], "wparts": [], "img": None, "href": None, "depth": depth,
                    "has_wrap": False, "wrap_depth": None}
            self.cards.append(card)
            self.open.append(card)
        if tag not in _VOID:
            self.stack.append(tag)

    def handle_startendtag(self, tag, attrs_list):
        self.handle_starttag(tag, attrs_list)
        if tag not in _VOID:
            self.handle_endtag(tag)
        if tag in self.CDATA_CONTENT_ELEMENTS:
            self.clear_cdata_mode()

    def handle_endtag(self, tag):
        if tag in _VOID or tag not in self.stack:
            return
        while self.stack:
            depth, top = len(self.stack), self.stack.pop()
            for card in self.open:
                if card["wrap_depth"] == depth:
                    card["wrap_depth"] = None
            self.open = [c for c in self.open if c["depth"] != depth]
            if top == tag:
                break

    def handle_data(self, data):
        if self.open and not any(t in _SKIP_TEXT_IN for t in self.stack):
            for card in self.open:
                card["parts"].append(data)
                if card["wrap_depth"] is not None:
                    card["wparts"].append(data)

    def found(self) -> list[dict]:
        return [{"attrs": c["attrs"], "error": c["error"], "text": "\n".join(c["wparts"] if c["has_wrap"] else c["parts"]), "img": c["img"] or "",
                 "href": (c["href"] or "") if self.layout == 1 else c["attrs"].get("href", "")} for c in self.cards]


def parse_cards(html: str, layout: int = 1, href_marker: str = "/offres/") -> list[dict]:
    """Python helper used inside the ``mapInPandas`` step (and by tests).

    A construct that the HTML parser can't read fails the cards around it: their ``error`` says why."""
    p = _CardParser(layout, href_marker)
    for error in _read(p, html or ""):
        for card in p.open:
            card["error"] = error
    return p.found()


def _read(parser: HTMLParser, html: str) -> Iterator[str]:
    """Feed a page; what the parser can't read is yielded as an error, passed over up to the next
    ``>``, and the page goes on behind it."""
    while True:
        try:
            parser.feed(html)
            parser.close()
            return
        except AssertionError as e:  # what html.parser raises
            yield f"{type(e).__name__}: {e}"
            line, at = parser.getpos()
            if line > 1:
                at += [m.end() for m in re.finditer("\n", html)][line - 2]
            end = html.find(">", at)
            html = html[end + 1:] if end >= 0 else ""
            parser.rawdata, parser.lineno, parser.offset = "", 1, 0


class _AnchorParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs_list):
        if tag == "a":
            self.hrefs += [v or "" for k, v in attrs_list if k == "href"][:1]


def parse_anchors(html: str) -> list[str]:
    """``href`` of every ``a`` that has one, in document order."""
    p = _AnchorParser()
    for _ in _read(p, html or ""):
        pass
    return p.hrefs


#: Cards handed on at once from a batch of pages.
CARDS_AT_ONCE = 256


def html_cards(pages: DataFrame, layout: int = 1, href_marker: str = "/offres/",
               id_col: str = "page_id", html_col: str = "html", extra: Sequence[str] = ()) -> DataFrame:
    """C1 / C2 — one row per card: ``page_id, card_pos, attrs, text, img, href, error``.

    A card that can't be read has ``error`` set and nothing else but its place; so does a page as a
    whole, without a place (D15: the failure is isolated to the card, or the page). ``extra`` string columns of the page are carried
    through to its cards (no join back to the pages is needed).
    """
    extra = list(extra)
    ship_package(pages.sparkSession)  # the HTML flattening runs in Python workers
    names = ["page_id", "card_pos", "attrs", "text", "img", "href", "error", *extra]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for row_i, (pid, html) in enumerate(zip(pdf["page_id"], pdf["html"])):
                ex = [pdf[c].iat[row_i] for c in extra]
                try:
                    cards = parse_cards(html, layout, href_marker)
                except Exception as e:  # noqa: BLE001 — isolate the page
                    rows.append((pid, None, None, None, None, None, f"{type(e).__name__}: {e}", *ex))
                    cards = []
                rows += [(pid, i, None, None, None, None, c["error"], *ex) if c["error"] else
                         (pid, i, dict(c["attrs"]), c["text"], c["img"], c["href"], None, *ex) for i, c in enumerate(cards)]
                if len(rows) >= CARDS_AT_ONCE:  # whole pages of text: never a whole batch's cards at once
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    src = spread(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"),
                              *[F.col(c).cast("string").alias(c) for c in extra]))
    schema = CARD_SCHEMA + "".join(f", `{c}` string" for c in extra)
    return src.mapInPandas(run, schema)


#: A page's cards as one JSON text (``page_card_lists``).
CARD_LIST = "array<struct<attrs:map<string,string>,text:string,img:string,href:string,error:string>>"


def page_card_lists(pages: DataFrame, layout: int, markers: Sequence[str], href_marker: str = "/offres/") -> DataFrame:
    """(crawl, page_num, blocked, n_cards, cards): one row a page, for stateful streams. ``n_cards``
    counts the cards that could be read; ``cards`` is a JSON text of all (``CARD_LIST``)."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [parse_cards(html, layout, href_marker) for html in pdf["html"]]
            lists = [json.dumps([{k: c[k] for k in ("attrs", "text", "img", "href", "error")} for c in cards]) for cards in found]
            yield pd.DataFrame({"crawl": pdf["crawl"], "page_num": pdf["page_num"], "blocked": pdf["blocked"],
                                "n_cards": [sum(c["error"] is None for c in cards) for cards in found], "cards": lists})

    given = pages.select("crawl", F.col("page_num").cast("int").alias("page_num"), "html", is_blocked_page("html", markers).alias("blocked"))
    return given.mapInPandas(run, "crawl string, page_num int, blocked boolean, n_cards int, cards string")


def listed_cards(lists: DataFrame) -> DataFrame:
    """The cards of ``page_card_lists`` as ``html_cards`` gives them, with ``crawl`` and ``page_num``."""
    page = ["crawl", "page_num"]
    each = lists.select(*page, F.xxhash64(*page).alias("page_id"), F.posexplode(F.from_json("cards", CARD_LIST)).alias("card_pos", "card"))
    return each.select(*page, "page_id", "card_pos", "card.*")


def _inline_to_space() -> tuple[str, str]:
    chars = "".join(ch for ch in whitespace_chars() if ch not in LINE_BREAK_CHARS)
    return chars, " " * len(chars)


def clean_lines(text, drop: Sequence[str] = ()) -> Column:
    """D2 — ``text.splitlines()`` → whitespace-squashed, non-empty lines (minus ``drop``).

    One regex pass over the whole text squashes in-line whitespace to single spaces;
    splitting on line boundaries and a plain ``trim`` per line then finish the job
    (no regex per line)."""
    flat = F.regexp_replace(F.translate(_as_col(text), *_inline_to_space()), " {2,}", " ")
    lines = F.transform(F.split(flat, line_break_class()), lambda l: F.trim(l))
    keep = lambda l: (l != "") & ~l.isin(list(drop)) if drop else (l != "")
    return F.filter(lines, keep)


def _get_or_na(arr: Column, i: int) -> Column:
    return F.coalesce(F.get(arr, i), F.lit("N/A"))


def cards_to_listing_a(cards: DataFrame, base_url: str, source: str = "autoscout24",
                       href_marker: str = "/offres/", keep: Sequence[str] = ()) -> DataFrame:
    """C3 — layout-1 card → listing by attributes and line positions.

    0 title, 1 version, 9 power, 10 seller, 11 place (0-based, ``N/A`` when absent).
    """
    a = F.col("attrs")
    lines = clean_lines(F.col("text"))
    l0 = _get_or_na(F.col("_lines"), 0)
    has_l0 = F.get(F.col("_lines"), 0).isNotNull()
    guid = F.coalesce(a["data-guid"], a["id"], F.lit(""))
    make_attr, model_attr = a["data-make"], a["data-model"]
    words0 = F.split(l0, " ")
    marque = title_case(F.coalesce(make_attr, F.when(has_l0, F.get(words0, 0)).otherwise(F.lit("N/A"))))
    modele = F.upper(F.coalesce(model_attr, F.when(has_l0, F.array_join(F.slice(words0, 2, 1 << 30), " "))
                                .otherwise(F.lit("N/A"))))
    date_mec, annee = registration_split(F.coalesce(a["data-first-registration"], F.lit("")))
    prix_raw, km_raw = F.coalesce(a["data-price"], F.lit("")), F.coalesce(a["data-mileage"], F.lit(""))
    return cards.where(F.col("error").isNull()).withColumn("_lines", lines).select(
        *keep, "page_id", "card_pos",
        squash(F.concat(l0, F.lit(" "), _get_or_na(F.col("_lines"), 1))).alias("titre"),
        marque.alias("marque"), modele.alias("modele"),
        _get_or_na(F.col("_lines"), 1).alias("version"),
        F.when(prix_raw != "", F.concat(prix_raw, F.lit(" €"))).otherwise(F.lit("N/A")).alias("prix"),
        annee.alias("annee"), date_mec.alias("date_mec"),
        F.when(km_raw != "", F.concat(km_raw, F.lit(" km"))).otherwise(F.lit("N/A")).alias("kilometrage"),
        decode_fuel(F.coalesce(a["data-fuel-type"], F.lit(""))).alias("carburant"),
        _get_or_na(F.col("_lines"), 9).alias("puissance"),
        _get_or_na(F.col("_lines"), 10).alias("vendeur"),
        _get_or_na(F.col("_lines"), 11).alias("localisation"),
        F.lit(source).alias("source"),
        absolute_link(F.col("href"), base_url, href_marker, guid=guid, make=make_attr, model=model_attr,
                      offer_path=href_marker).alias("lien"),
        F.coalesce(F.col("img"), F.lit("")).alias("image"),
    )


# ── layout 2: line classifier as a fold over the card's lines ──

def _kw(low: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


def _is_annee(l: Column) -> Column:
    return l.rlike(r"^20\p{Nd}{2}$")


def _digits_display(l: Column, unit: str) -> Column:
    ws = WS()
    d = squash(F.regexp_replace(l, "[^\\p{Nd}" + ws[1:-1] + "]", ""))
    return F.when(d != "", F.concat(d, F.lit(" " + unit))).otherwise(F.lit("N/A"))


def classify_card_lines(df: DataFrame, lines_col: str, out: str = "card",
                        fuels: Sequence[str] = CARD_FUELS, gearboxes: Sequence[str] = CARD_GEARBOXES) -> DataFrame:
    """C4 / G3 / G4 / D8 — layout-2 state machine over bullet-free lines.

    Returns ``struct(disponibilite, titre, version, finition, carburant, boite, annee,
    autonomie, kilometrage, mensualite, economie, prix, prix_origine)``.
    Lines 3–7 fill fuel / gearbox / trim; lines 6+ fill year, range, mileage (first
    hit), monthly and saving (last hit) and collect prices in order. Line features are
    computed once per line (one lower-casing, one scan per test) before the folds, and
    each fold result is its own column (folds are not code-generated, so a repeated
    reference would re-run them).
    """
    NA = F.lit("N/A")
    lines = F.col(lines_col)

    def head_features(l):
        low = F.lower(l)
        return F.struct(l.alias("l"), _kw(low, fuels).alias("fuel"), _kw(low, gearboxes).alias("gear"))

    head = F.transform(F.slice(lines, 4, 5), head_features)
    init1 = F.struct(NA.alias("carburant"), NA.alias("boite"), NA.alias("finition"))

    def step1(acc, x):
        return (F.when((acc["carburant"] == "N/A") & x["fuel"], acc.withField("carburant", x["l"]))
                .when((acc["boite"] == "N/A") & x["gear"], acc.withField("boite", x["l"]))
                .when((acc["finition"] == "N/A") & (acc["carburant"] == "N/A") & (acc["boite"] == "N/A"),
                      acc.withField("finition", x["l"]))
                .otherwise(acc))

    df = df.withColumn("_r1", F.aggregate(head, init1, step1))
    r1 = F.col("_r1")

    def tail_features(l):
        low = F.lower(l)
        wltp = F.contains(low, F.lit("wltp"))
        monthly_low = F.contains(low, F.lit("/mois"))
        euro = F.contains(l, F.lit("€"))
        return F.struct(
            l.alias("l"),
            _is_annee(l).alias("annee"),
            wltp.alias("wltp"),
            (F.contains(low, F.lit("km")) & ~wltp).alias("km"),
            monthly_low.alias("monthly"),
            (F.contains(low, F.lit("conomisez")) |
             (euro & F.contains(l, F.lit("%")) & l.rlike(r"-\p{Nd}+%"))).alias("saving"),
            (euro & ~F.contains(l, F.lit("/mois")) & l.rlike(r"\p{Nd}")).alias("price"))

    tail = F.transform(F.slice(lines, 7, 1 << 30), tail_features)
    init2 = F.struct(NA.alias("annee"), NA.alias("autonomie"), NA.alias("kilometrage"),
                     NA.alias("mensualite"), NA.alias("economie"),
                     F.array().cast("array<string>").alias("prix"))

    def step2(acc, x):
        return (F.when(x["annee"] & (acc["annee"] == "N/A"), acc.withField("annee", x["l"]))
                .when(x["wltp"] & (acc["autonomie"] == "N/A"), acc.withField("autonomie", x["l"]))
                .when(x["km"] & (acc["kilometrage"] == "N/A"), acc.withField("kilometrage", _digits_display(x["l"], "km")))
                .when(x["monthly"], acc.withField("mensualite", x["l"]))
                .when(x["saving"], acc.withField("economie", x["l"]))
                .when(x["price"], acc.withField("prix", F.concat(acc["prix"], F.array(_digits_display(x["l"], "€")))))
                .otherwise(acc))

    df = df.withColumn("_r2", F.aggregate(tail, init2, step2))
    r2 = F.col("_r2")
    n = F.size(lines)
    carb = r1["carburant"]
    carb = F.when((carb != "N/A") & (carb.isin("O", "Unknown") | (F.length(carb) <= 2)), NA).otherwise(carb)
    return df.withColumn(out, F.struct(
        _get_or_na(lines, 0).alias("disponibilite"),
        F.when(n > 2, squash(F.concat(F.get(lines, 1), F.lit(" "), F.get(lines, 2)))).otherwise(NA).alias("titre"),
        F.when(n > 2, F.get(lines, 2)).otherwise(NA).alias("version"),
        r1["finition"].alias("finition"), carb.alias("carburant"), r1["boite"].alias("boite"),
        r2["annee"].alias("annee"), r2["autonomie"].alias("autonomie"), r2["kilometrage"].alias("kilometrage"),
        r2["mensualite"].alias("mensualite"), r2["economie"].alias("economie"),
        _get_or_na(r2["prix"], 0).alias("prix"), _get_or_na(r2["prix"], 1).alias("prix_origine"))).drop("_r1", "_r2")


def cards_to_listing_b(cards: DataFrame, base_url: str, source: str = "aramisauto",
                       keep: Sequence[str] = ()) -> DataFrame:
    """C4 — layout-2 card → listing (attributes ``makerid`` / ``modelid`` + line classifier)."""
    a = F.col("attrs")
    base = cards.where(F.col("error").isNull()).withColumn("_lines", clean_lines(F.col("text"), drop=["•"]))
    return (classify_card_lines(base, "_lines", "_c")
            .select(*keep, "page_id", "card_pos", "_c.titre",
                    title_case(F.coalesce(a["makerid"], F.lit("N/A"))).alias("marque"),
                    F.upper(F.coalesce(a["modelid"], F.lit("N/A"))).alias("modele"),
                    "_c.version", "_c.finition", "_c.prix", "_c.prix_origine", "_c.economie", "_c.mensualite",
                    "_c.annee", "_c.kilometrage", "_c.autonomie", "_c.carburant", "_c.boite", "_c.disponibilite",
                    F.lit(source).alias("source"),
                    absolute_link(F.col("href"), base_url, "/").alias("lien"),
                    F.coalesce(F.col("img"), F.lit("")).alias("image")))


# ── crawl control ──

def crawl_prefix(pages: DataFrame, crawl_col: str, page_col: str, stop: Column, max_pages: int | None = None,
                 first_page: int | None = None, inclusive: bool = False) -> DataFrame:
    """G2 / H6 — keep pages before the first stop page of each crawl (timeout, blocked
    page, zero cards or extraction error), and at most ``max_pages`` pages. ``inclusive`` keeps
    the stop page too (a page that was never captured can't be kept).

    With ``first_page`` crawls are numbered from there without gaps, so a page that timed out is
    one that was never captured: the crawl ends before it. A page whose predecessor is missing is
    found by a self-join on (crawl, page), which no long crawl makes one task.

    The stop page per crawl is a hash aggregate (one row per crawl); it joins back to
    the pages by crawl — AQE broadcasts it once its measured size is small.
    """
    p = pages.where(F.col(page_col) <= max_pages) if max_pages is not None else pages
    stops = p.where(stop).select(crawl_col, F.col(page_col).alias("_stop"))
    if first_page is not None:
        before = p.select(F.col(crawl_col).alias("_crawl"), (F.col(page_col) + 1).alias("_next")).distinct()
        gap = p.select(crawl_col, page_col).where(F.col(page_col) > first_page).join(
            before, F.col(crawl_col).eqNullSafe(F.col("_crawl")) & (F.col(page_col) == F.col("_next")), "left_anti")
        stops = stops.unionByName(gap.select(crawl_col, (F.col(page_col) - 1).alias("_stop")))
    stops = stops.groupBy(F.col(crawl_col).alias("_crawl")).agg(F.min("_stop").alias("_stop"))
    kept = F.col(page_col) <= F.col("_stop") if inclusive else F.col(page_col) < F.col("_stop")
    return (p.join(stops, F.col(crawl_col).eqNullSafe(F.col("_crawl")), "left")
            .where(F.col("_stop").isNull() | kept).drop("_stop", "_crawl"))


def is_blocked_page(html, markers: Sequence[str] = BLOCK_MARKERS_1) -> Column:
    """D1."""
    return blocked(html, list(markers))


def guid_links(anchors: DataFrame, href_marker: str = "/offres/") -> DataFrame:
    """E18 — per page, guid (last five ``-`` parts of the path) → first path carrying it.

    ``anchors``: (page_id, a_pos, href). Returns (page_id, guid, path).
    """
    path = F.split_part(F.col("href"), F.lit("?"), F.lit(1))
    guid = F.array_join(F.slice(F.split(path, "-"), -5, 5), "-")
    return (anchors.where(F.contains(F.col("href"), F.lit(href_marker)))
            .select("page_id", "a_pos", path.alias("path"), guid.alias("guid"))
            .where(F.col("guid") != "")
            .groupBy("page_id", "guid").agg(F.min_by("path", "a_pos").alias("path")))


def page_anchors(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, a_pos, href) of every anchor with a link."""
    ship_package(pages.sparkSession)

    @F.pandas_udf("array<string>")
    def hrefs(html: pd.Series) -> pd.Series:
        return html.map(parse_anchors)

    return spread(pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))).select(
        "page_id", F.posexplode(hrefs("html")).alias("a_pos", "href"))


def with_guid_links(cards: DataFrame, links: DataFrame) -> DataFrame:
    """E18 — each card's ``href`` from the page's anchors by its guid (``data-guid``, else
    ``id``); an empty text where no anchor has it."""
    guid = F.coalesce(F.col("attrs")["data-guid"], F.col("attrs")["id"], F.lit(""))
    c = cards.withColumn("_guid", guid)
    found = links.select(F.col("page_id").alias("_page"), F.col("guid").alias("_g"), "path")
    return (c.join(found, (c["page_id"] == found["_page"]) & (c["_guid"] == found["_g"]), "left")
            .withColumn("href", F.coalesce("path", F.lit(""))).drop("_page", "_g", "path", "_guid"))


# ── JSON-LD ──

_ITEM_TYPES = ("Car", "Vehicle", "Product")


def jsonld_items(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """C5 / J29 — JSON-LD block (text) → listing rows.

    A block is a list of items, an ``ItemList`` (``itemListElement[].item`` or the
    element itself) or one ``Car`` / ``Vehicle`` / ``Product``; anything else yields
    nothing, and an unparsable block is skipped (D15). Empty items (NULL, ``{}``, ``""``,
    ``0``, ``[]``, ``false``) are passed over; the first item that is no object, or whose offers
    are none, ends its block. Polymorphic fields (brand, mileage, image) are read with both
    shapes; an absent one is ``N/A``, and a price of 0 counts as none.
    """
    v = F.try_parse_json(F.col(json_col))
    typ = F.try_variant_get(v, "$['@type']", "string")
    as_list = F.try_variant_get(v, "$", "array<variant>")
    elems = F.try_variant_get(v, "$.itemListElement", "array<variant>")
    from_list = F.transform(elems, lambda e: F.coalesce(F.try_variant_get(e, "$.item", "variant"), e))
    items = (F.when(as_list.isNotNull(), as_list)
             .when(typ == "ItemList", from_list)
             .when(typ.isin(*_ITEM_TYPES), F.array(v)))
    # what a JSON value is, from its text: falsy values, objects
    text = lambda e: F.to_json(e)
    falsy = lambda e: e.isNull() | F.is_variant_null(e) | text(e).isin("{}", '""', "0", "0.0", "[]", "false")
    # offers may be absent, but not null or anything other than an object
    offers = lambda e: F.try_variant_get(e, "$.offers", "variant")
    sound = lambda e: text(e).startswith("{") & (offers(e).isNull() | F.coalesce(F.to_json(offers(e)).startswith("{"), F.lit(True)))
    kept = F.filter(items, lambda e: ~falsy(e))
    # items before the first unsound one: each item is marked once, the list is cut once
    marked = df.select(*keep, kept.alias("_kept")).withColumn("_sound", F.transform("_kept", lambda e: F.coalesce(sound(e), F.lit(False))))
    stop = F.array_position("_sound", False)
    before = F.when(stop == 0, F.col("_kept")).otherwise(F.slice("_kept", F.lit(1), F.greatest(stop - 1, F.lit(0)).cast("int")))
    x = marked.select(*keep, F.posexplode(before).alias("item_pos", "it"))

    def g(path: str, t: str = "string") -> Column:
        return F.try_variant_get(F.col("it"), path, t)

    def s(path: str) -> Column:  # Python str() of a scalar; objects → NULL here
        return g(path, "string")

    def truthy(path: str) -> Column:
        return F.when(~s(path).isin("", "false") & ~(F.coalesce(F.to_json(g(path, "variant")), F.lit("")).isin("0", "0.0")), s(path))

    price = F.coalesce(truthy("$.offers.price"), truthy("$.offers.lowPrice"))
    currency = F.coalesce(s("$.offers.priceCurrency"), F.lit("EUR"))
    odo_obj = g("$.mileageFromOdometer", "map<string,variant>")
    km = F.when(odo_obj.isNotNull(), F.coalesce(s("$.mileageFromOdometer.value"), F.lit("N/A"))) \
        .otherwise(F.coalesce(s("$.mileageFromOdometer"), F.lit("N/A")))
    brand_obj = g("$.brand", "map<string,variant>")
    marque = F.when(brand_obj.isNotNull(), F.coalesce(s("$.brand.name"), F.lit("N/A"))) \
        .otherwise(F.coalesce(s("$.brand"), F.lit("N/A")))
    eng_obj = g("$.vehicleEngine", "map<string,variant>")
    puissance = F.when(eng_obj.isNotNull(), F.coalesce(s("$.vehicleEngine.enginePower"), F.lit("N/A"))) \
        .otherwise(F.lit("N/A"))
    img_list = g("$.image", "array<string>")
    image = F.when(img_list.isNotNull(), F.coalesce(F.get(img_list, 0), F.lit("N/A"))) \
        .otherwise(F.coalesce(s("$.image"), F.lit("N/A")))
    # first present date key (a key present with a JSON null counts as absent here)
    annee = F.coalesce(s("$.vehicleModelDate"), s("$.modelDate"), F.lit("N/A"))
    return x.select(
        *keep, "item_pos",
        F.coalesce(s("$.url"), F.lit("N/A")).alias("lien"),
        F.coalesce(s("$.name"), F.lit("N/A")).alias("titre"),
        marque.alias("marque"),
        F.when(price.isNotNull(), squash(F.concat(price, F.lit(" "), currency))).otherwise(F.lit("N/A")).alias("prix"),
        annee.alias("annee"),
        km.alias("kilometrage"),
        F.coalesce(s("$.fuelType"), F.lit("N/A")).alias("carburant"),
        F.coalesce(s("$.vehicleTransmission"), F.lit("N/A")).alias("boite"),
        puissance.alias("puissance"),
        F.coalesce(s("$.color"), F.lit("N/A")).alias("couleur"),
        image.alias("image"))


def jsonld_blocks(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Script blocks of type ``application/ld+json`` → one row per block."""
    pat = r"(?is)<script[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
    return pages.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(pat), 1))
                        .alias("block_pos", "block"))
