"""Continuous loads (§2.12): captured pages and dump files arriving in folders.

* ``start_page_stream``: single captured pages → cards → listings → resolution → store.
* ``start_crawl_stream``: K14 for both layouts. Keyed state holds where each crawl stands: pages are
  taken in their order, pages ahead of a gap wait, and a crawl that has stopped stays stopped in
  later batches (D1, G2).
* ``start_dump_stream``: K13. The field roles are fixed by the first batch that decides them and
  stored beside the store; items that came before wait there too.

Every micro-batch publishes a new immutable store version under ``store_base``. Writes are keyed by
link, so a micro-batch that is run again changes nothing (exactly-once effect with the
checkpointed source offsets). No watermark: a crawl has no time, only an order.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from carlot.functions.codes import BLOCK_MARKERS_1, BLOCK_MARKERS_2
from carlot.operators.extract import cards_to_listing_a, html_cards, listed_cards, page_card_lists
from carlot.operators.ingest import decided_roles, dump_rows, field_columns
from carlot.operators.load import card_listings, load_into_store, store_rows
from carlot.operators.resolve import Catalog, resolve_listings
from carlot.operators.store import first_per_key, insert_absent, to_store_rows, upsert
from carlot.session import cut_lineage, ship_package
from carlot.sources.sinks import exists, latest_version, write_version

PAGES_SCHEMA = "page_id long, url string, html string"
CRAWL_SCHEMA = "crawl string, page_num int, html string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- single pages ------------------------------------------------------------------------

def listings_from_pages(pages: DataFrame, cat: Catalog, base_url: str, gens: DataFrame | None = None,
                        source: str = "pages", href_marker: str = "/", fuzzy: bool = True) -> DataFrame:
    """K14 transform shared by the batch and the streaming job (no aggregation)."""
    cards = html_cards(pages, layout=1, href_marker=href_marker, extra=["url"])
    cards = cards.withColumn("href", F.when(F.coalesce(F.col("href"), F.lit("")) == "", F.col("url"))
                             .otherwise(F.col("href")))
    listings = cut_lineage(cards_to_listing_a(cards, base_url, source=source, href_marker=href_marker))
    return resolve_listings(listings, cat, gens=gens, fuzzy=fuzzy)


def apply_batch(spark: SparkSession, batch: DataFrame, store_base: str, seen_at=None) -> str:
    """G1 + C7 + B3 for one batch of resolved listings; returns the new version path."""
    first = first_per_key(batch, "lien", ["page_id", "card_pos"])
    rows = to_store_rows(first, seen_at=seen_at)
    try:
        store = latest_version(spark, store_base)
        merged = upsert(store, rows, "lien_annonce", batch_order=["last_seen_at"])
    except FileNotFoundError:
        merged = rows
    return write_version(merged, store_base)


def _start(stream: DataFrame, each, checkpoint: str, trigger_once: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()


def start_page_stream(spark: SparkSession, pages_path: str, store_base: str, checkpoint: str,
                      cat: Catalog, base_url: str, seen_at=None, trigger_once: bool = True,
                      gens: DataFrame | None = None) -> StreamingQuery:
    """Start the streaming load of single pages; ``checkpoint`` must be on shared storage."""
    stream = spark.readStream.schema(PAGES_SCHEMA).parquet(pages_path)

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        # the resolution cascade materialises its vocabulary tables, so it runs on each
        # micro-batch as a batch DataFrame
        resolved = listings_from_pages(batch_df, cat, base_url, gens=gens)
        apply_batch(batch_df.sparkSession, resolved, store_base, seen_at=seen_at)

    return _start(stream, each, checkpoint, trigger_once)


# --- crawls ------------------------------------------------------------------------------

class CrawlOrder(StatefulProcessor):
    """State of one crawl: the page that comes next, whether it has stopped, and pages that came
    ahead of their turn. Pages leave in order; the page that stops a crawl leaves marked, so that
    its failed cards are reported, and nothing leaves after it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", "next int, stopped boolean")
        self.ahead = handle.getMapState("ahead", "page_num int", "blocked boolean, n_cards int, cards string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        at, stopped = self.place.get() if self.place.exists() else (1, False)
        for frame in rows:
            for page, blocked, n_cards, cards in zip(frame["page_num"], frame["blocked"], frame["n_cards"], frame["cards"], strict=True):
                if not stopped and page >= at:
                    self.ahead.updateValue((int(page),), (bool(blocked), int(n_cards), cards))
        out = []
        while not stopped and self.ahead.containsKey((at,)):
            blocked, n_cards, cards = self.ahead.getValue((at,))
            self.ahead.removeKey((at,))
            stopped = blocked or n_cards == 0
            if not blocked:
                out.append((key[0], at, not stopped, cards))
            at += 1
        if stopped:
            self.ahead.clear()
        self.place.update((at, stopped))
        yield pd.DataFrame(out, columns=["crawl", "page_num", "kept", "cards"])

    def close(self) -> None:
        pass


def start_crawl_stream(spark: SparkSession, pages_path: str, store_base: str, checkpoint: str, layout: int,
                       cat: Catalog, base_url: str, source: str, seen_at, gens: DataFrame | None = None,
                       fuzzy: bool = True, href_marker: str = "/offres/", markers: Sequence[str] | None = None,
                       files_a_batch: int | None = None, trigger_once: bool = True) -> StreamingQuery:
    """K14 as pages ``(crawl, page_num, html)`` arrive, in any order. ``seen_at`` is the time of the whole
    load: links that the store has from it keep their first listing in layout 1 (G1 over all batches);
    in layout 2 the last one stays. Rejects go beside each version, as in a batch load."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ship_package(spark)
    reader = spark.readStream.schema(CRAWL_SCHEMA)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    lists = page_card_lists(reader.parquet(pages_path), layout, markers or (BLOCK_MARKERS_1 if layout == 1 else BLOCK_MARKERS_2), href_marker)
    in_order = lists.groupBy("crawl").transformWithStateInPandas(
        CrawlOrder(), "crawl string, page_num int, kept boolean, cards string", "Append", "None")

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        pages = cut_lineage(batch_df)
        good = F.col("error").isNull()
        found = card_listings(listed_cards(pages.where("kept")).where(good), listed_cards(pages).where(~good), layout, base_url, source, href_marker)
        rows = store_rows(found.listings, layout, cat, gens, seen_at, fuzzy)
        if layout == 1:
            try:
                loaded = latest_version(spark, store_base).where(F.col("last_seen_at") == seen_at).select("lien_annonce")
                rows = rows.join(loaded, "lien_annonce", "left_anti")
            except FileNotFoundError:
                pass
        load_into_store(rows, store_base, found.rejects)

    return _start(in_order, each, checkpoint, trigger_once)


# --- dumps -------------------------------------------------------------------------------

def start_dump_stream(spark: SparkSession, dumps_path: str, store_base: str, checkpoint: str, brands: DataFrame, words: DataFrame,
                      seen_at=None, files_a_batch: int | None = None, trigger_once: bool = True) -> StreamingQuery:
    """K13 as dump files (JSON arrays) arrive. The first batch whose items, with those that wait, show
    year and mileage fixes the field roles (``store_base/roles``) for all later ones; items that came
    before wait in ``store_base/waiting``. Of items with one link the first in arrival, file and
    place is inserted."""
    reader = spark.readStream
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    # a streamed file is one row; its items are exploded from it
    files = reader.text(dumps_path, wholetext=True).select("value", F.col("_metadata.file_path").alias("name"))
    roles_path, waiting_path = os.path.join(store_base, "roles"), os.path.join(store_base, "waiting")

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        items = batch_df.select(F.struct(F.lit(epoch_id).alias("place"), "name").alias("_file"),
                                F.posexplode(F.from_json("value", "array<map<string,string>>")).alias("_pos", "item"))
        items = cut_lineage(items.withColumn("_pos", F.col("_pos").cast("long")))
        if exists(spark, waiting_path):
            earlier = spark.read.parquet(waiting_path).where(F.col("epoch") != epoch_id).drop("epoch")
            known_late = exists(spark, roles_path)
            items = items if known_late else cut_lineage(earlier.unionByName(items))
        if exists(spark, roles_path):
            roles = {r["role"]: r["field"] for r in spark.read.parquet(roles_path).collect()}  # three rows at most
        else:
            roles = decided_roles(field_columns(items))
            if roles is None:
                items.where(F.col("_file.place") == epoch_id).withColumn("epoch", F.lit(epoch_id)).write.mode("append").parquet(waiting_path)
                return
        rows = dump_rows(field_columns(items, roles.values()), roles, brands, words, seen_at=seen_at)
        order = ["_file", "_pos"]
        try:
            merged = insert_absent(latest_version(spark, store_base), rows, "lien_annonce", batch_order=order)[0].drop(*order)
        except FileNotFoundError:
            empty = rows.drop(*order).limit(0)
            merged = insert_absent(empty, rows, "lien_annonce", batch_order=order)[0].drop(*order)
        write_version(merged, store_base)
        if not exists(spark, roles_path):  # last, so that a batch that fails before is decided again
            spark.createDataFrame(list(roles.items()), "role string, field string").coalesce(1).write.parquet(roles_path)

    return _start(files, each, checkpoint, trigger_once)
