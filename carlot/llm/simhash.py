"""Operator 7: SimHash near-duplicates through pivot distance tables.

Fingerprint: A-Z to lower case, words between ASCII white space, shingles of ``shingle``
words joined by a space (the whole sequence if shorter), each hashed by XXH64 with seed 42;
a bit is set if more than half of the hashes have it. Texts without words have fingerprint 0,
which links like any other.

Linking: texts with the same fingerprint collapse to one *class* first, so copies are never
paired. Classes that differ in at most ``max_bits`` bits agree on ``agree`` of ``blocks`` bit
blocks if ``blocks - agree >= max_bits``; the values of every such choice of blocks are the
buckets in which classes meet (an equi-join key: no cross join). The pivot table, each class's Hamming
distances to ``PIVOTS`` reference fingerprints, is computed once and written with the classes; its
rows go with them into every bucket. By the triangle
inequality two classes differ by at least any difference of their coordinates, so pairs whose
maximum coordinate difference exceeds ``max_bits`` are discarded; the survivors are verified
on the fingerprints. A bucket yields a spanning forest of its links, not all its pairs.

Hot buckets: buckets over ``BUCKET`` classes are dealt as pairs of chunks, one task row set
each, so no task holds more than two chunks; all pairs are still compared.

Scale: the text is read once and not shuffled; what is shuffled are 8-byte fingerprints and their
rows of the pivot table. A fingerprint, component or star centre that many rows share meets its value
in chunks of these rows (``components.attached``).
The number of blocks follows the number of classes, so that random classes rarely share a
bucket at any size (every choice is exact).

Edge cases: NULL and empty texts have fingerprint 0; repeated rows share a class; an empty
table gives an empty result; rows with a NULL doc_id are linked, and a component of such rows
alone has component_id NULL; texts of any length are hashed in slices; ties have no part in it; columns
other than ``doc_id`` and ``text`` are ignored (``keep_one`` keeps them), whatever their names.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import arrow_map, dropped, map_texts, record_batch, written
from carlot.llm.components import attached, components

PIVOTS = 24
BUCKET = 2048
#: (blocks, agreeing blocks) in order of selectivity, for up to four differing bits
PLANS = ((6, 2), (7, 3), (8, 4), (10, 6))


def text_fingerprint(text: str, shingle: int) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for lo in range(0, n, 65536):  # bounded memory for very long texts
        hashes = np.array([digest(b" ".join(words[i:i + shingle]), 42) for i in range(lo, min(n, lo + 65536))], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""

    def make():
        return lambda texts: [np.array([text_fingerprint(t, shingle) for t in texts], "u8").view("i8")]

    return map_texts(docs, make, [("fp", "bigint")])


def pivots(n: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) for i in range(n)], "u8")


def bit_blocks(blocks: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of ``blocks`` blocks that share out 64 bits."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def plan_for(classes: int, max_bits: int) -> tuple[int, int]:
    """Blocks to cut and blocks to agree on, so that classes share few buckets by chance."""
    if max_bits != 4:
        return max_bits + 2, 2
    return next((p for p in PLANS if 64 * p[1] / p[0] >= math.log2(max(classes, 2)) + 2), PLANS[-1])


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances (a row a fingerprint) to the references."""
    return np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)


def with_pivot_rows(classes: DataFrame) -> DataFrame:
    """``classes`` with its rows of the pivot table (``pivot``, a byte a reference)."""
    kinds = [(name, kind) for name, kind in classes.dtypes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pivot_table(batch.column(batch.schema.names.index("fp")).to_numpy(zero_copy_only=False).view("u8"))
            ends = np.arange(len(rows) + 1, dtype="i4") * PIVOTS
            pivot = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns, pivot], names=[*batch.schema.names, "pivot"])

    return arrow_map(classes, run, [*kinds, ("pivot", "binary")])


def bucket_links(keys: np.ndarray, fps: np.ndarray, table: np.ndarray, max_bits: int,
                 seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links between equal keys (rows sorted by key), as a spanning forest: (fp, least fp linked to it).
    ``seen`` gets (pairs, pairs that the pivots leave, links) added."""
    label = np.arange(len(fps))
    left, right = [], []
    rows = np.arange(len(fps) - 1)
    step = 1
    while True:
        rows = rows[rows + step < len(fps)]
        rows = rows[keys[rows] == keys[rows + step]]
        if not len(rows):
            break
        near, pairs = rows, len(rows)
        for k in range(table.shape[1]):  # discard by the greatest coordinate difference
            near = near[np.abs(table[near, k] - table[near + step, k]) <= max_bits]
            if not len(near):
                break
        left_over = len(near)
        near = near[np.bitwise_count(fps[near] ^ fps[near + step]) <= max_bits]
        if seen is not None:
            seen[:] = [a + b for a, b in zip(seen, (pairs, left_over, len(near)), strict=True)]
        left.append(near)
        right.append(near + step)
        step += 1
    if not left:
        return fps[:0], fps[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def class_links(classes: DataFrame, max_bits: int, plan: tuple[int, int] | None = None, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between the classes (``fp`` and ``pivot``) that connect all within ``max_bits`` bits."""
    blocks, agree = plan or plan_for(classes.count(), max_bits)
    parts = bit_blocks(blocks)
    if blocks - agree < max_bits:
        raise ValueError("too few blocks for that many differing bits")
    # classes agree on a choice of blocks if they agree under its mask
    masks = [sum((1 << bits) - 1 << first for first, bits in chosen) for chosen in itertools.combinations(parts, agree)]
    signed = np.array(masks, "u8").view("i8").tolist()
    keyed = classes.select("fp", "pivot", F.posexplode(F.array(*[F.lit(m).cast("bigint") for m in signed])).alias("choice", "mask")).select(
        "fp", "pivot", F.xxhash64("choice", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    # a key is shared by classes that agree on a choice of blocks; keys of one class alone go
    many = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(many, "key")
    chunks = F.ceil(F.col("n") / bucket).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    # (own, other) for every chunk, smaller first; a single chunk is the pair (0, 0)
    dealt = met.select("key", "fp", "pivot", chunks.alias("chunks"), own.alias("own")).select(
        "key", "fp", "pivot", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"), "own").select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "fp", "pivot")
    fields = [("u", "bigint"), ("v", "bigint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, table = np.empty(0, "i8"), np.empty(0, "u8"), np.empty((0, PIVOTS), "i1")
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(2).to_pylist()), "i1").reshape(-1, PIVOTS)
            table = np.concatenate((table, rows))
            keys = np.concatenate((keys, batch.column(0).to_numpy(zero_copy_only=False)))
            fps = np.concatenate((fps, batch.column(1).to_numpy(zero_copy_only=False).view("u8")))
            if not len(keys):
                continue
            whole = int(np.searchsorted(keys, keys[-1]))  # the last unit may go on in the next batch
            u, v = bucket_links(keys[:whole], fps[:whole], table[:whole], max_bits)
            keys, fps, table = keys[whole:], fps[whole:], table[whole:]
            if len(u):
                yield record_batch([u.view("i8"), v.view("i8")], fields)
        u, v = bucket_links(keys, fps, table, max_bits)
        if len(u):
            yield record_batch([u.view("i8"), v.view("i8")], fields)

    return arrow_map(dealt.repartition("unit").sortWithinPartitions("unit", "fp"), run, fields).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """Per row: doc_id, fp, fingerprint (hex), component_id (least doc_id reachable)."""
    rows = written(fingerprints(docs, shingle).withColumn("place", F.monotonically_increasing_id()), "simhash-rows")
    classes = written(with_pivot_rows(rows.groupBy("fp").agg(F.min("doc_id").alias("least"))), "simhash-classes")
    linked = components(class_links(classes, max_bits), "simhash-links")
    named = written(classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "least", F.coalesce("component", "fp").alias("component")), "simhash-components")
    dropped(classes)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = attached(named.select("fp", "component"), least, "component", "fp").select("fp", "component_id")
    return attached(rows, ids, "fp", "place").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row (all columns) of each component: that of the least doc_id, NULL being greater than any.
    Rows are told apart by a key that is written with them, so of rows that repeat an id, or have
    none, exactly one stays too."""
    key = "row_key"
    while key in [c.lower() for c in docs.columns]:
        key += "_"
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "simhash-keyed")
    # in the order of their fields
    ids = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(key).alias("key"))
    found = near_duplicates(keyed.select(ids.alias("doc_id"), "text"), shingle, max_bits)
    out = found.where("doc_id.key <> component_id.key").select(F.col("doc_id.key").alias(key))
    return keyed.join(out, key, "left_anti").select(*docs.columns)
