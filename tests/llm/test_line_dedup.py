import hashlib

import numpy as np
import pytest
from helpers import LINE, all_docs, edge_docs, empty_docs, inputs, rows_of
from pyspark.sql import functions as F

from carlot.llm import line_dedup as ld


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()


def expected(rows):
    holders: dict[str, list] = {}
    for doc_id, text in rows:
        for k in {key_of(x) for x in text.split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(doc_id)
    keeper = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 3}
    out = []
    for doc_id, text in rows:
        lines = text.split("\n")
        kept = [x for x in lines if key_of(x) not in keeper or keeper[key_of(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("table", [edge_docs, all_docs])
def test_against_brute_force(spark, table):
    docs = table(spark)
    assert rows_of(ld.line_digests(docs)) == expected(inputs(docs))


@pytest.mark.parametrize("limit", [1 << 20, 64, 4])
def test_filter_groups(spark, monkeypatch, limit):
    """More filters than one broadcast holds: each group of shards is worked off, and shards whose
    filter alone is larger go to the exact join as they are."""
    monkeypatch.setattr(ld, "FILTER_BYTES", limit)
    monkeypatch.setattr(ld, "SHARD_KEYS", 5)
    docs = all_docs(spark)
    index = ld.build_index(docs)
    sizes = [r["n"] for r in index.filters.select(F.length("cuckoo").alias("n")).collect()]
    assert index.shards > 3 and (max(sizes) > limit) == (limit < 64)
    assert rows_of(ld.line_digests(docs)) == expected(inputs(docs))


def test_shards_follow_the_keys(spark, monkeypatch):
    monkeypatch.setattr(ld, "SHARD_KEYS", 5)
    docs = all_docs(spark)
    first = ld.build_index(docs.where("doc_id < 40"))
    grown = ld.insert_documents(first, docs.where("doc_id >= 40"))
    assert grown.shards > 2 * first.shards
    digests = ld.dedup_lines(docs, grown).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    assert rows_of(digests) == expected(inputs(docs))


def test_columns_named_like_its_own(spark):
    """Every name that the operator uses itself may be a column of the documents."""
    names = ["__id", "__lost", "__cut", "cut", "cutid", "cutrow", "cutlost", "cut_", "row", "hi", "lo", "shard", "n", "keeper", "lost",
             "cuckoo", "keys", "change", "n_lines", "n_dropped", "kept_text", "kept_sha256"]
    docs = edge_docs(spark)
    wide = docs.select("doc_id", "text", "n_chars", *[F.lit("x").alias(c) for c in names])
    assert rows_of(ld.line_digests(wide)) == rows_of(ld.line_digests(docs))
    out = ld.rewrite_documents(wide)
    assert out.columns == wide.columns and {r["cut"] for r in out.collect()} == {"x"}
    want = rows_of(ld.rewrite_documents(docs).select("doc_id", "text"))
    assert rows_of(out.select("doc_id", "text")) == want


def test_rows_that_share_an_id_lose_their_own_lines(spark):
    other = "another line that is long enough to count"
    rows = [(None, f"{LINE}\na"), (None, f"{other}\nb"), (None, f"c\n{LINE}\n{other}"), (4, LINE), (4, f"{other}\nd"), (4, f"{other}\nd"),
            (6, LINE), (6, "short"), (7, other)]
    assert rows_of(ld.line_digests(edge_docs(spark, rows))) == expected(rows)


def test_empty_table(spark):
    assert rows_of(ld.line_digests(empty_docs(spark))) == []


def test_rewrite_keeps_columns(spark):
    docs = edge_docs(spark)
    out = ld.rewrite_documents(docs)
    assert out.dtypes == docs.dtypes
    assert out.count() == docs.count()
    assert out.where(F.col("n_chars") != F.char_length("text")).count() == 0


def state(index):
    filters = {r["shard"]: sorted(x for row in ld.CuckooFilter.load(bytes(r["cuckoo"])).table.tolist() for x in row if x)
               for r in index.filters.collect() if r["keys"]}
    return rows_of(index.postings), rows_of(index.shared), filters


def test_insert_and_delete_are_reversible(spark):
    docs = all_docs(spark)
    first, second = docs.where("doc_id < 120"), docs.where("doc_id >= 120")
    start = ld.build_index(first)
    grown = ld.insert_documents(start, second)
    assert state(grown)[:2] == state(ld.build_index(docs))[:2]
    assert rows_of(ld.dedup_lines(docs, grown)) == rows_of(ld.dedup_lines(docs))
    back = ld.delete_documents(grown, second.select("doc_id"))
    assert state(back) == state(start)
    assert rows_of(ld.dedup_lines(first, back)) == rows_of(ld.dedup_lines(first))


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 64, 5000, dtype="u8")
    f = ld.CuckooFilter.of(keys)
    assert f.contains(keys).all()
    assert f.contains(rng.integers(0, 1 << 64, 20_000, dtype="u8")).mean() < 0.002
    f.delete(keys[:2500])
    assert f.contains(keys[2500:]).all()
    assert f.contains(keys[:2500]).mean() < 0.01
    assert ld.CuckooFilter.load(f.dump()).contains(keys[2500:]).all()


def test_cuckoo_filter_one_by_one():
    """Small filters, full ones and equal marks: what is in is found, what is taken out once is gone once."""
    rng = np.random.default_rng(7)
    for n in (0, 1, 3, 4, 5, 40, 333):
        keys = rng.integers(0, 1 << 64, n, dtype="u8")
        keys = np.concatenate((keys, keys[:n // 3]))  # twice
        f = ld.CuckooFilter.of(keys)
        assert f.contains(keys).all() and (f.table != 0).sum() == len(keys)
        f.delete(keys[n:])
        assert f.contains(keys[:n]).all() and (f.table != 0).sum() == n
        f.delete(keys[:n])
        assert not f.table.any()
        assert f.insert(keys[:n]) and f.contains(keys[:n]).all()
    tight = ld.CuckooFilter(np.zeros((2, ld.SLOTS), np.uint16))
    assert not tight.insert(rng.integers(0, 1 << 64, 9, dtype="u8"))


def test_shared_line_of_repeated_rows(spark):
    rows = [(1, LINE), (1, LINE), (2, f"{LINE}\nx")]
    assert rows_of(ld.line_digests(edge_docs(spark, rows))) == expected(rows)
