"""Streaming variant: the store written by the stream equals the batch result."""

import json
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from carlot.operators.ingest import brand_tables, dump_rows, read_dumps
from carlot.operators.load import crawl, load_into_store, store_rows
from carlot.operators.store import insert_absent
from carlot.plans.resolve_queries import part_catalog
from carlot.sources.sinks import latest_version
from carlot.streaming.stream import (CRAWL_SCHEMA, apply_batch, listings_from_pages, start_crawl_stream, start_dump_stream,
                                     start_page_stream)

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    SEEN = F.lit("2024-01-31 00:00:00").cast("timestamp")
    work = tempfile.mkdtemp(prefix="carlot-stream-")
    src = os.path.join(work, "pages")
    os.makedirs(src)
    shutil.copy(f"{SF}/pages.parquet", os.path.join(src, "part-0.parquet"))
    cat = part_catalog(spark, SF)

    q = start_page_stream(spark, src, os.path.join(work, "store_stream"), os.path.join(work, "ckpt"),
                          cat, "https://s.example", seen_at=SEEN)
    q.awaitTermination(300)
    streamed = latest_version(spark, os.path.join(work, "store_stream"))

    batch = listings_from_pages(spark.read.parquet(src), cat, "https://s.example")
    apply_batch(spark, batch, os.path.join(work, "store_batch"), seen_at=SEEN)
    batched = latest_version(spark, os.path.join(work, "store_batch"))

    a = sorted(tuple(r) for r in streamed.collect())
    b = sorted(tuple(r) for r in batched.collect())
    assert len(a) > 0 and a == b

    # replaying the same batch into the store changes nothing (upsert keyed by link)
    apply_batch(spark, batch, os.path.join(work, "store_batch"), seen_at=SEEN)
    assert sorted(tuple(r) for r in latest_version(spark, os.path.join(work, "store_batch")).collect()) == b


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(spark, folder, name, df, at):
    """One file of a stream's folder, with its time."""
    os.makedirs(folder, exist_ok=True)
    made = tempfile.mkdtemp(prefix="carlot-part-")
    df.coalesce(1).write.mode("overwrite").parquet(made)
    part = next(f for f in os.listdir(made) if f.endswith(".parquet"))
    shutil.copy(os.path.join(made, part), os.path.join(folder, f"{name}.parquet"))
    os.utime(os.path.join(folder, f"{name}.parquet"), (at, at))


def crawl_page(layout, cards):
    if layout == 1:
        return "".join(f'<article data-guid="a-b-c-d-{g}" data-make="peugeot" data-model="208" data-price="{p}" data-first-registration="03-2015">{x}'
                       "<h2>Peugeot 208</h2></article>" for g, p, x in cards)
    lines = lambda p: "".join(f"<p>{t}</p>" for t in ["Dispo", "Peugeot", "208 GT", "Fin", "Essence", "Manuelle", "2015", "12 km", f"{p} €"])
    return "".join(f'<a class="product-card" href="/v/{g}" makerid="peugeot" modelid="208">{x}'
                   f'<div class="product-card-content-wrapper">{lines(p)}</div></a>' for g, p, x in cards)


@pytest.mark.parametrize("layout", [1, 2])
def test_crawl_stream_equals_batch(spark, small_catalog, small_generations, layout):
    """Pages out of order, a gap that is filled later and one that never is, a blocked page in batch 2 whose
    crawl stays stopped in batch 3, a page without good cards, a link that comes back."""
    bad, seen = "<![bad[ x ]]>", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    page = lambda *cards: crawl_page(layout, cards)
    pages = [
        [("a", 1, page((1, 10, ""), (2, "1.2.3" if layout == 1 else 20, ""))), ("b", 2, page((20, 7, ""))), ("c", 1, page((30, 5, ""), (31, 5, bad)))],
        [("a", 2, "Access denied" + page((3, 30, ""))), ("b", 1, page((10, 6, ""))), ("c", 2, page((32, 5, bad)))],
        [("a", 3, page((4, 40, ""))), ("b", 3, page((10, 8, ""), (21, 9, ""))), ("b", 5, page((22, 1, ""))), ("c", 3, page((33, 5, "")))],
    ]
    work = tempfile.mkdtemp(prefix="carlot-crawl-")
    src = os.path.join(work, "pages")
    for k, rows in enumerate(pages):
        put(spark, src, f"p{k}", spark.createDataFrame(rows, CRAWL_SCHEMA), 1_700_000_000 + k)
    args = dict(gens=small_generations, seen_at=seen, fuzzy=False)
    q = start_crawl_stream(spark, src, os.path.join(work, "streamed"), os.path.join(work, "ckpt"), layout, small_catalog,
                           "https://s.example", "s", files_a_batch=1, markers=["access denied"], **args)
    q.awaitTermination(300)
    streamed = latest_version(spark, os.path.join(work, "streamed"))

    found = crawl(spark.read.parquet(src), layout, "https://s.example", "s", markers=["access denied"])
    load_into_store(store_rows(found.listings, layout, small_catalog, **args), os.path.join(work, "batch"), found.rejects)
    batch = latest_version(spark, os.path.join(work, "batch"))
    assert rows_of(streamed) == rows_of(batch)
    links = {r.lien_annonce[-2:].strip("-/"): r for r in batch.collect()}
    assert set(links) == ({"1", "10", "20", "21", "30"} if layout == 1 else {"1", "2", "10", "20", "21", "30"})
    assert links["10"].prix == (6.0 if layout == 1 else 8.0) and {r.generation for r in links.values()} != {"N/A"}
    rejects = lambda base: rows_of(spark.read.parquet(*[os.path.join(base, d) for d in os.listdir(base) if d.startswith("rejects-")]))
    assert rejects(os.path.join(work, "streamed")) == rejects(os.path.join(work, "batch")) and len(found.rejects.collect()) == (3 if layout == 1 else 2)


def test_dump_stream_equals_batch(spark):
    """Three files: the first decides no roles, so its items wait; the roles of the second hold for the third."""
    item = lambda n, **kw: {"text-body-1": f"Vends Clio {n}", "text-callout": f"{1000 + n} €", "absolute href": f"https://d/{n}",
                            "absolute src": f"https://i/{n}"} | kw
    files = [
        [item(n, **{"text-body-2": "", "text-body-2 (2)": ""}) for n in range(3)] + [item(3, **{"text-body-2 (2)": "rien"})],
        [item(n, **{"text-body-2": str(2000 + n), "text-body-2 (2)": f"{n}0000 km", "text-body-2 (3)": "Diesel"}) for n in range(2, 9)],
        # here another column looks more like years, but the roles are fixed
        [item(n, **{"text-body-2": str(2000 + n) if n % 2 else "x", "text-body-2 (2)": f"{n}0000 km", "text-body-2 (4)": "2001"}) for n in range(7, 14)],
    ]
    work = tempfile.mkdtemp(prefix="carlot-dumps-")
    src = os.path.join(work, "dumps")
    os.makedirs(src)
    for k, items in enumerate(files):
        path = os.path.join(src, f"d{k}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(items, f, ensure_ascii=False, indent=1)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    brands, words = brand_tables(spark)
    seen = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    base = os.path.join(work, "streamed")
    q = start_dump_stream(spark, src, base, os.path.join(work, "ckpt"), brands, words, seen_at=seen, files_a_batch=1)
    q.awaitTermination(300)
    streamed = latest_version(spark, base)
    roles = {r.role: r.field for r in spark.read.parquet(os.path.join(base, "roles")).collect()}
    assert roles == {"annee": "text-body-2", "km": "text-body-2 (2)", "carburant": "text-body-2 (3)"}

    items = read_dumps(spark, [os.path.join(src, f"d{k}.json") for k in range(3)])
    rows = dump_rows(items, roles, brands, words, seen_at=seen)
    store, _ = insert_absent(rows.drop("_file", "_pos").limit(0), rows, batch_order=["_file", "_pos"])
    assert rows_of(streamed.select(sorted(streamed.columns))) == rows_of(store.select(sorted(streamed.columns)))
    assert streamed.count() == 12 and streamed.where("lien_annonce = 'https://d/7'").first().carburant == "Diesel"
    # a new query over the same files starts from the stored roles and inserts nothing
    q = start_dump_stream(spark, src, base, os.path.join(work, "ckpt2"), brands, words, seen_at=seen, files_a_batch=1)
    q.awaitTermination(300)
    assert rows_of(latest_version(spark, base)) == rows_of(streamed)
