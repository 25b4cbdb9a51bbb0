import hashlib
import re

import pytest
from helpers import all_docs, edge_docs, empty_docs, inputs
from pyspark.sql import functions as F

from carlot.llm import sketch

END = re.compile(r"\n+|(?<=[.!?]) +(?=[AEIOUÀ-ÆÈ-ÏÒ-ÖÙ-Ü])")


def paragraphs(text):
    return {p.strip(" ") for p in END.split(text) if p.strip(" ")}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(ordered):
    out = []
    for k, (doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        n = len(text) // 4
        edited = text[:len(text) - n] + following[:n]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    round(likeness(text, edited), 9), round(likeness(text, following), 9)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9))
                   for r in df.collect()), key=repr)


def in_order(spark, docs):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
    return [(r["doc_id"], r["text"]) for r in rows]


@pytest.mark.parametrize("table", [edge_docs, all_docs])
def test_against_sets(spark, table):
    docs = table(spark)
    assert found(sketch.fingerprint_edits(docs)) == expected(in_order(spark, docs))


def test_empty_and_single(spark):
    assert found(sketch.fingerprint_edits(empty_docs(spark))) == []
    one = edge_docs(spark, [(3, "A text. And its own successor.")])
    assert found(sketch.fingerprint_edits(one)) == expected(in_order(spark, one))


def test_equal_texts_have_equal_fingerprints(spark):
    rows = {r["doc_id"]: r["fingerprint"] for r in sketch.fingerprint_edits(edge_docs(spark)).where("doc_id >= 10").collect()}
    assert rows[10] == rows[11] != rows[12]


def test_retries_until_decoded(spark):
    """Differences of up to thousands of paragraphs: far more than 24 cells hold."""
    texts = [("\n".join(f"{p} {i}" for i in range(n)), "\n".join(f"{q} {i}" for i in range(m)))
             for p, n, q, m in (("a", 3000, "b", 10), ("a", 40, "a", 60), ("a", 5, "b", 5), ("a", 0, "b", 900))]
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(texts)], "row bigint, x string, y string").select(
        "row", sketch.paragraph_digests(F.col("x")).alias("a"), sketch.paragraph_digests(F.col("y")).alias("b"))
    got = {(r["row"], r["other"]): r["different"] for r in sketch.differences(rows, "a", ["b", "a"]).collect()}
    assert got == {(k, 0): len(paragraphs(a) ^ paragraphs(b)) for k, (a, b) in enumerate(texts)} | {(k, 1): 0 for k in range(len(texts))}


def test_native_plan(spark):
    plan = sketch.with_successor(all_docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_successor_over_many_ranges(spark):
    docs = all_docs(spark)
    for ranges in (1, 2, 64, 1024):
        got = sorted((r["doc_id"], r["next"]["text"]) for r in sketch.with_successor(docs, ranges).collect())
        rows = sorted(inputs(docs))
        assert got == [(i, rows[(k + 1) % len(rows)][1]) for k, (i, _) in enumerate(rows)]
