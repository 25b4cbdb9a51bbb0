"""Source loads (K14, K15): captured pages → cards → listings → resolution → store rows → store.

One function for both layouts. Pages are ``(crawl, page_num, html)``; a crawl starts at page 1 and
ends at its first blocked page, page without cards or page that was never captured (D1, G2), and at
``max_pages``. Parsed cards are written once, because the stop pages, the listings and the rejected
cards all come from them.

Cards that can't be read and listings whose typing fails are no part of a load: they are its
rejects, a table of places and reasons (D15, B3), and the rest is loaded.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.functions.codes import BLOCK_MARKERS_1, BLOCK_MARKERS_2
from carlot.functions.numbers import unreadable_price
from carlot.operators.extract import (cards_to_listing_a, cards_to_listing_b, crawl_prefix, guid_links, html_cards,
                                      is_blocked_page, page_anchors, with_guid_links)
from carlot.operators.resolve import Catalog, resolve_listings
from carlot.operators.store import first_per_key, last_per_link, split_rejects, to_store_rows, upsert_rows
from carlot.session import cut_lineage
from carlot.sources.sinks import latest_version, new_version, write_counted, write_rejects

PAGE = ["crawl", "page_num"]
#: The order in which cards are met.
PLACE = [*PAGE, "card_pos"]


class Crawled(NamedTuple):
    """Listings of a crawl and its rejects (``crawl, page_num, card_pos, lien, reason``)."""
    listings: DataFrame
    rejects: DataFrame


def crawl(pages: DataFrame, layout: int, base_url: str, source: str, max_pages: int | None = None,
          href_marker: str = "/offres/", links_by_guid: bool = False, markers: Sequence[str] | None = None) -> Crawled:
    """Listings of the pages before each crawl's end, with ``crawl``, ``page_num``, ``card_pos``.

    With ``links_by_guid`` the links of layout-1 cards come from all anchors of the page (E18).
    Rejected cards come from the page that ends a crawl too, unless it is blocked."""
    keyed = pages.select("crawl", F.col("page_num").cast("int").alias("page_num"), "html",
                         F.xxhash64("crawl", F.col("page_num").cast("int")).alias("page_id"))
    if max_pages is not None:
        keyed = keyed.where(F.col("page_num") <= max_pages)
    cards = cut_lineage(html_cards(keyed, layout=layout, href_marker=href_marker, extra=PAGE)
                        .withColumn("page_num", F.col("page_num").cast("int")))
    good = F.col("error").isNull()
    with_cards = cards.where(good).select("page_id").distinct().withColumn("_cards", F.lit(True))
    blocked = is_blocked_page("html", markers or (BLOCK_MARKERS_1 if layout == 1 else BLOCK_MARKERS_2))
    seen = cut_lineage(keyed.select(*PAGE, "page_id", blocked.alias("_blocked")).join(with_cards, "page_id", "left"))
    stop = F.col("_blocked") | F.col("_cards").isNull()
    visited = lambda inclusive: crawl_prefix(seen, "crawl", "page_num", stop, first_page=1, inclusive=inclusive)
    failed = cards.where(~good).join(visited(True).where(~F.col("_blocked")).select("page_id"), "page_id", "left_semi")
    cards = cards.where(good).join(visited(False).select("page_id"), "page_id", "left_semi")
    if layout == 1 and links_by_guid:
        cards = with_guid_links(cards, guid_links(page_anchors(keyed), href_marker))
    return card_listings(cards, failed, layout, base_url, source, href_marker)


def card_listings(cards: DataFrame, failed: DataFrame, layout: int, base_url: str, source: str,
                  href_marker: str = "/offres/") -> Crawled:
    """Listings of good cards; rejects from cards that failed and listings that can't be typed."""
    if layout == 2:
        listings = cards_to_listing_b(cards, base_url, source=source, keep=PAGE)
    else:
        listings = cards_to_listing_a(cards, base_url, source=source, href_marker=href_marker, keep=PAGE)
    failed = failed.select(*PLACE, F.lit(None).cast("string").alias("lien"), F.concat(F.lit("carte_illisible: "), "error").alias("reason"))
    typed, untyped = split_rejects(cut_lineage(listings), {"prix_illisible": unreadable_price("prix")})
    return Crawled(typed, failed.unionByName(untyped.select(*PLACE, "lien", "reason")))


def crawled_listings(pages: DataFrame, layout: int, base_url: str, source: str, **kw) -> DataFrame:
    """Listings of the pages before each crawl's end."""
    return crawl(pages, layout, base_url, source, **kw).listings


def store_rows(listings: DataFrame, layout: int, catalogue: Catalog, gens: DataFrame | None = None,
               seen_at: Column | None = None, fuzzy: bool = True, dedup: bool = True) -> DataFrame:
    """Resolved (make, model, generation) store rows of listings. Layout 1 keeps the first listing
    per link and none without one; layout 2 sends all its listings in order, so that the last per
    link stays, an empty one and ``N/A`` being links like any other. ``dedup=False`` sends all of
    either, each with its place (``crawl, page_num, card_pos``)."""
    resolved = resolve_listings(listings, catalogue, gens=gens, fuzzy=fuzzy)
    if not dedup:
        return to_store_rows(resolved, seen_at=seen_at, keep=PLACE)
    return to_store_rows((first_per_key if layout == 1 else last_per_link)(resolved, "lien", PLACE), seen_at=seen_at)


def source_load(pages: DataFrame, layout: int, catalogue: Catalog, base_url: str, source: str,
                gens: DataFrame | None = None, seen_at: Column | None = None, fuzzy: bool = True,
                dedup: bool = True, **kw) -> DataFrame:
    """K14 — store rows of a load."""
    return store_rows(crawled_listings(pages, layout, base_url, source, **kw), layout, catalogue, gens, seen_at, fuzzy, dedup)


def one_page_load(pages: DataFrame, layout: int, catalogue: Catalog, base_url: str, source: str, **kw) -> DataFrame:
    """K15 — all rows of each crawl's first page, in the order of their places (no G1)."""
    return source_load(pages, layout, catalogue, base_url, source, max_pages=1, dedup=False, **kw)


def load_into_store(rows: DataFrame, store_base: str, rejects: DataFrame | None = None) -> dict[str, int]:
    """Upsert store rows into the newest version of a store (the first load makes one) and return the
    run's counters: sent, inserted, updated, unchanged, kept, errors. Of rows with one link the last
    by time, then by place, stays. Rejects go to a table beside the version (``rejects-<version>``)."""
    order = ["last_seen_at", *(c for c in PLACE if c in rows.columns)]
    try:
        store = latest_version(rows.sparkSession, store_base)
    except FileNotFoundError:
        store = rows.drop(*PLACE).limit(0)
    path = new_version(store_base)
    counters = write_counted(upsert_rows(store, rows, batch_order=order).drop(*PLACE), path)
    errors = 0
    if rejects is not None:
        errors = write_rejects(rejects, os.path.join(store_base, "rejects-" + os.path.basename(path)))
    return counters | {"errors": errors}
