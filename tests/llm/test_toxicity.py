import zlib

import numpy as np
import pytest
from helpers import edge_docs, empty_docs, rows_of
from pyspark.sql import functions as F

from carlot.llm import toxicity as tx

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def lexicon(spark, tables):
    return tx.learn(*tables)


def test_held_out_accuracy(tables, lexicon):
    docs, labels = tables
    rows = tx.score_texts(docs, lexicon).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97
    assert np.mean([a > b for a in toxic for b in clean]) > 0.9
    assert np.mean([s >= 0.5 for s in clean]) < 0.03


def naive_score(lexicon, text):
    """The score by looking for every term at every place, without an automaton."""
    if lexicon.empty:
        return 0.0
    folded = tx.fold(text)

    def places(phrase):
        at = folded.find(phrase)
        while at >= 0:
            yield at, at + len(phrase) - 1
            at = folded.find(phrase, at + 1)

    spared = [p for phrase in lexicon.exceptions if phrase in folded for p in places(phrase)]
    best = {}
    for term, weight in lexicon.terms.items():
        if term in folded:
            for a, b in places(term):
                if a not in best or weight > best[a][1]:
                    best[a] = (b, weight)
    total = sum(w for a, (b, w) in best.items() if not any(x <= a and b <= y for x, y in spared))
    words = max(1, len(folded.split(" ")) - 2)
    features = (np.log1p(total), total / words**0.5, 10 * total / (words + 10))
    z = lexicon.logistic[0] + sum(w * f for w, f in zip(lexicon.logistic[1:], features, strict=True))
    return 1 / (1 + np.exp(-min(30, max(-30, z))))


def test_scores_by_brute_force(tables, lexicon):
    """A lexicon learned from the larger table, every document of it scored by plain substring search."""
    docs, _ = tables
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id % 5 = 0 OR length(text) > 50000").collect()}
    got = {r["doc_id"]: r["score"] for r in tx.score_texts(docs, lexicon).collect()}
    assert len(lexicon.terms) > 3 and len(texts) > 1000
    for i, text in texts.items():
        assert abs(got[i] - naive_score(lexicon, text or "")) < 1e-9, i


def test_hits_by_brute_force():
    """Nested and overlapping terms and exceptions on small alphabets."""
    import random
    r = random.Random(8)
    word = lambda n: "".join(r.choices("ab", k=r.randint(1, n)))
    for _ in range(500):
        terms = {(f" {word(3)} " if r.random() < 0.5 else f" {word(3)}"): float(r.randint(1, 9)) for _ in range(r.randint(1, 5))}
        phrases = [p for _ in range(r.randint(0, 3)) if (p := f" {word(3)} {word(3)} " if r.random() < 0.5 else f" {word(4)} ") not in terms]
        lexicon = tx.Lexicon(terms, sorted(set(phrases)), (-2.0, 1.0, 0.5, 0.25))
        matcher = lexicon.matcher()
        for _ in range(10):
            text = " ".join(word(4) for _ in range(r.randint(0, 8)))
            assert abs(matcher.score(text) - naive_score(lexicon, text)) < 1e-12, (lexicon, text)


def test_held_out_flag(tables, lexicon):
    docs, _ = tables
    rows = tx.score_texts(docs, lexicon).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_held_out_labels_are_never_used(spark, tables, lexicon):
    docs, labels = tables
    wrong = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tx.learn(docs, wrong) == lexicon


def test_bounded_sample(tables):
    assert tx.training_rows(*tables, rows=50).count() == 50


def test_folding():
    assert tx.fold("Ιԁi0t  c1own!") == " idiot ciown "
    assert tx.fold("CLOWN") == tx.fold("сӏоwn") == tx.fold("cl0wn") == tx.fold("ｃｌｏｗｎ")
    assert tx.fold("") == "  "


def test_exceptions_and_length():
    lexicon = tx.Lexicon({" trash": 5.0, " moron ": 4.0}, [" trash can "], (-3.0, 1.0, 2.0, 2.0))
    m = lexicon.matcher()
    assert m.hits(tx.fold("a trash can")) == []
    assert [w for _, _, w in m.hits(tx.fold("trashy trash can moron morons"))] == [5.0, 4.0]
    assert m.score("trash") > m.score("trash " + "word " * 500) > m.score("word " * 500)
    assert m.score("a trash can") == m.score("a b c")


def test_edge_tables(spark, lexicon):
    assert rows_of(tx.score_texts(empty_docs(spark), lexicon)) == []
    rows = tx.score_texts(edge_docs(spark), lexicon).collect()
    assert len(rows) == edge_docs(spark).count()
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}


def test_no_labels(spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    lexicon = tx.learn(edge_docs(spark), labels)
    assert {r["score"] for r in tx.score_texts(edge_docs(spark), lexicon).collect()} == {0.0}


def test_drop_toxic_keeps_columns(spark, lexicon):
    docs = edge_docs(spark, [(1, "you stupid pathetic worthless idiot"), (2, "The and attion to thanedble the."), (None, None)])
    out = tx.drop_toxic(docs, lexicon)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 2]
