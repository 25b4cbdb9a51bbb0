import re

import numpy as np
import pytest
import xxhash
from helpers import all_docs, edge_docs, empty_docs, inputs, rows_of

from carlot.llm import simhash
from carlot.llm.components import attached, components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall(re.sub(r"[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, bits):
    """Component number of each value, by comparing all pairs."""
    label = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= bits and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    label = linked(prints, 4)
    least = {x: min((rows[k][0] for k in range(len(rows)) if label[k] == x and rows[k][0] is not None), default=None) for x in set(label)}
    return sorted(((rows[k][0], f"{prints[k]:016x}", least[label[k]]) for k in range(len(rows))), key=repr)


@pytest.mark.parametrize("table", [edge_docs, all_docs])
def test_against_brute_force(spark, table):
    docs = table(spark)
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
    rows = [(i, t if len(t) < 100_000 else "word " * 10) for i, t in inputs(docs)]  # one word, however often
    assert rows_of(got) == expected(rows)


def test_empty_table(spark):
    assert rows_of(simhash.near_duplicates(empty_docs(spark))) == []


def planted(n_seeds=40, seed=3):
    """Fingerprints with chains and dense balls of near ones."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n_seeds):
        base = int(rng.integers(0, 1 << 63))
        for _ in range(8):
            for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                base ^= 1 << int(b)
            out.append(base)
    centre = int(rng.integers(0, 1 << 63))
    out += [centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(1, 64, 5)]
    return np.unique(np.array(out, "u8"))


@pytest.mark.parametrize("plan", [(6, 2), (7, 3), (8, 4), (10, 6)])
@pytest.mark.parametrize("bucket", [simhash.BUCKET, 7])
def test_links_find_all_components(spark, plan, bucket):
    values = planted()
    classes = simhash.with_pivot_rows(spark.createDataFrame([(int(v),) for v in values.view("i8")], "fp bigint"))
    edges = simhash.class_links(classes, 4, plan, bucket)
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    ours = [found.get(int(v), int(v)) for v in values.view("i8")]
    theirs = linked([int(v) for v in values], 4)
    assert len(set(zip(ours, theirs, strict=True))) == len(set(ours)) == len(set(theirs))


def test_too_few_blocks(spark):
    with pytest.raises(ValueError):
        simhash.class_links(spark.createDataFrame([(1,)], "fp bigint"), 4, (5, 2))


def test_long_chain_is_one_component(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (7, 7)], "u bigint, v bigint")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_keep_one(spark):
    docs = edge_docs(spark)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    # 3, 8 and a row without an id have no word, 2 and another such row no text: one component
    assert 10 in ids and 11 not in ids and ids.count(5) == 2 and ids.count(None) == 1


def test_keep_one_row_of_each_component(spark):
    """Rows that repeat an id or have none: exactly one of each group of copies stays, and a text of
    its own stays whatever its namesake does."""
    copy, other = "one two three four five six seven eight nine ten", "another text that has no copy but shares an id"
    nameless = "only rows without an id hold this text of ten words"
    rows = [(1, copy), (2, copy), (2, other), (3, copy), (3, copy), (None, copy), (None, nameless), (None, nameless), (None, nameless),
            (5, "five stands twice and both rows are alike"), (5, "five stands twice and both rows are alike")]
    docs = edge_docs(spark, rows)
    out = simhash.keep_one(docs)
    assert out.dtypes == docs.dtypes
    want = [(1, copy), (2, other), (None, nameless), rows[-1]]
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_pivots_discard_pairs():
    """Of the pairs in a bucket the pivot table leaves few, and no link is lost."""
    values = planted(400)
    seen = [0, 0, 0]
    simhash.bucket_links(np.zeros(len(values), "i8"), values, simhash.pivot_table(values), 4, seen)
    pairs, left_over, links = seen
    near = sum(int((np.bitwise_count(values[i + 1:] ^ v) <= 4).sum()) for i, v in enumerate(values))
    assert pairs == len(values) * (len(values) - 1) // 2 and links == near
    assert left_over < pairs / 20


def test_pivot_rows_are_written_with_the_classes(spark):
    values = planted(3)
    rows = simhash.with_pivot_rows(spark.createDataFrame([(int(v), 5) for v in values.view("i8")], "fp bigint, least bigint")).collect()
    table = simhash.pivot_table(np.array([r["fp"] for r in rows], "i8").view("u8"))
    assert [r["pivot"] for r in rows] == [bytes(x.tobytes()) for x in table] and {r["least"] for r in rows} == {5}
    references = simhash.pivots()
    assert table[0][3] == (int(values[0]) ^ int(references[3])).bit_count()


def test_a_hot_key_meets_its_value_in_chunks(spark):
    from pyspark.sql import functions as F
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("i"))
    values = rows.groupBy("k").agg(F.min("i").alias("m"))
    out = attached(rows, values, "k", "i")
    assert out.columns == ["k", "i", "m"]
    assert {(r.i, r.m) for r in out.collect()} == {(i, 1 if i % 3 else i) if i != 7 else (7, 1) for i in range(1000)}
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sizes = attached(rows, values, "k", "i").rdd.glom().map(len).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 1000 and max(sizes) < 300  # of 667 rows of one key


def test_a_star_is_one_component(spark):
    edges = spark.createDataFrame([(500, i) for i in range(1, 400)] + [(3, 900), (901, 902)], "u bigint, v bigint")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {i: 1 for i in [*range(1, 400), 500, 900]} | {901: 901, 902: 901}
