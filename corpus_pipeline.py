"""Corpus pipeline over ``documents``: toxic documents go, shared lines go, one document of each
group of near-duplicates stays, documents with benchmark passages go, and what is left is encoded.

Every stage works on all that the one before has kept. Stages return the columns of
``documents`` (``n_chars`` follows the text), the last one token counts and digests.

Edge cases, in every stage: rows with a NULL doc_id are scored, cut, compared and encoded like
others; rows that repeat an id, and whole repeated rows, are documents of their own, of which
near-duplicates keep one; NULL and empty texts are clean and empty (one of them stays); very long
texts are read whole; of equal ids (ties) all keep a shared line; an empty table passes all stages;
extra columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from carlot.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from carlot.llm.common import dropped, table, written
from carlot.session import Scratch

VOCABULARY = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1. The lexicon is learned from the labels; rejected documents go."""
    lexicon = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, lexicon)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8. Lines of 20 characters or more in three documents stay in the last of them only."""
    return line_dedup.rewrite_documents(docs, min_chars=20, min_docs=3)


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7. One row of each component of 4-word SimHashes within 4 bits stays, that of the least doc_id."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4. Documents that cover a benchmark item's words by tiles go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2. Token counts and digests of ids and decoded texts."""
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash", keep_one_near_duplicate),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]

#: Learned weights, bit counts and merges are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next. A stage's own
    intermediates, and the result that it has read, are deleted when its result has been written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with Scratch(spark) as scratch:
            before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            scratch.keep(docs.scratch_path)
        if name != STAGES[0][0]:
            dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
