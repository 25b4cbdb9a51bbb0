import hashlib
import random

import numpy as np
import pytest
from helpers import all_docs, edge_docs, empty_docs, inputs, rows_of

from carlot.llm import suffix_dedup as sd


def expected(rows, depth=50):
    rank = lambda i: -(1 << 63) if i is None else i
    first: dict[bytes, int] = {}
    for doc_id, text in rows:
        b = text.encode()
        for p in range(len(b) - depth + 1):
            w = b[p:p + depth]
            first[w] = min(first.get(w, rank(doc_id)), rank(doc_id))
    out = []
    for doc_id, text in rows:
        b = text.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - depth + 1):
            if first[b[p:p + depth]] < rank(doc_id):
                gone[p:p + depth] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, "u1")[~gone])).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("table", [edge_docs, all_docs])
def test_against_brute_force(spark, table):
    docs = table(spark)
    assert rows_of(sd.removal_digests(docs)) == expected(inputs(docs))


def test_overlapping_and_periodic_passages(spark, monkeypatch):
    """Cuts of common material, short alphabets and periods, in small batches and blocks."""
    monkeypatch.setattr(sd, "BATCH_BYTES", 700)
    monkeypatch.setattr(sd, "BLOCK_BYTES", 300)
    rng = random.Random(5)
    pool = ["".join(rng.choice("abc ") for _ in range(160)) for _ in range(4)] + ["ab" * 90, "x" * 150, "é" * 70]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, len(p) - 1)
            text += p[a:a + rng.randint(20, 120)] + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 9)))
        rows.append((rng.choice([i, i, i, 7, None]), text))
    docs = edge_docs(spark, rows).repartition(3)
    assert rows_of(sd.removal_digests(docs)) == expected(rows)


def test_hot_digits_are_split(spark, monkeypatch):
    """A line that many documents hold in different surroundings: same result, and no shard of pass 3
    has all its runs."""
    monkeypatch.setattr(sd, "BATCH_BYTES", 2000)
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    line = "a line of more than fifty bytes that a lot of documents hold in other surroundings"
    rows = [(rng.choice([i, i, 7, None]), f"{word(rng.randint(0, 60))}{line[rng.choice([0, 0, 3]):]}{word(rng.randint(0, 60))}") for i in range(150)]
    docs = edge_docs(spark, rows).repartition(3)
    seen, edge_entries = [], sd.edge_entries

    def watched(*args):
        out = edge_entries(*args)
        seen.append({r["shard"]: r["n"] for r in out.selectExpr("shard", "length(windows) n").groupBy("shard").sum("n").toDF("shard", "n").collect()})
        return out

    monkeypatch.setattr(sd, "edge_entries", watched)
    want = expected(rows)
    assert rows_of(sd.removal_digests(docs)) == want
    monkeypatch.setattr(sd, "SPLIT_RUNS", 8)
    assert rows_of(sd.removal_digests(docs)) == want
    assert max(seen[0].values()) > 60 and max(seen[1].values()) <= 24 and len([s for s in seen[1] if s >= 12]) > 6


def test_other_depth(spark):
    docs = edge_docs(spark)
    assert rows_of(sd.removal_digests(docs, 21)) == expected(inputs(docs), 21)
    with pytest.raises(ValueError):
        sd.remove_repeats(docs, 10)


def test_empty_table(spark):
    assert rows_of(sd.removal_digests(empty_docs(spark))) == []


def test_radix_groups():
    data = np.frombuffer(b"abcdefghijXabcdefghijYabcdefghiZ", "u1")
    at = np.array([0, 11, 22])
    hit = sd.radix_groups(data, at, np.zeros(3, "u8"), np.array([1, 2, 3]), 10)
    assert hit.tolist() == [1]
    hit = sd.radix_groups(data, at, np.zeros(3, "u8"), np.array([1, 2, 3]), 9)
    assert sorted(hit.tolist()) == [1, 2]
    assert sd.radix_groups(data, at, np.zeros(3, "u8"), np.array([2, 2, 2]), 9).tolist() == []
