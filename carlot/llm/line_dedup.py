"""Operator 8: reversible incremental line deduplication.

A line's key is the line without ASCII white space at its ends, A-Z in lower case, as a
128-bit digest. The index holds

* *postings*: one row a document and key (keys of at least ``min_chars`` code points), the
  exact base of
* *reference counts*: documents that hold the key, and the largest of their ids;
* *cuckoo filters*, one a shard of the key space, of the keys that at least ``min_docs``
  documents hold.

Cuckoo filters can delete as well as insert: ``insert_documents`` and ``delete_documents``
change the postings, count again the keys they touch, and move only keys that cross the
threshold into or out of the filters of their shards; inserting and then deleting a batch
gives the former index back.

Dropping: documents probe the filters first; only lines that a filter lets pass (all shared
lines and about one in 10 000 others) go to the exact reference counts, by a join on the key.

Scale: postings are aggregated before the shuffle, so a line that a third of all documents
hold is a row a task; the join of hits and counts has no aggregate above it on the key, so AQE
splits hot keys. The number of shards follows the number of keys (about ``SHARD_KEYS`` each), so each
filter is built in a task of bounded memory. Filters are broadcast in groups of shards of at most
``FILTER_BYTES``; each group reads only its own shards of the postings, and a shard whose filter is
larger than that isn't broadcast: all its postings go to the exact join. Texts are shuffled once, to
meet the keys that they lose, by their id and hash: rows that share an id, or have none, are dealt
by their texts.

Edge cases: NULL and empty texts are one empty line; rows that repeat a doc_id count as
documents of their own; a NULL doc_id counts and never is the largest; among holders with the largest
id (ties) all keep the line; texts and lines of any length are read whole; an empty table gives an
empty result; extra columns are ignored (``rewrite_documents`` keeps them), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import arrow_map, id_and_text, record_batch, written
from carlot.session import ship_package

#: Keys of a shard, about; a filter has two to five bytes a key.
SHARD_KEYS = 1 << 20
FILTER_BYTES = 48 << 20
SLOTS = 4
WHITE = b" \t\n\x0b\x0c\r"
KEY = ["hi", "lo"]


# --- cuckoo filter -------------------------------------------------------------------------

class CuckooFilter:
    """Buckets of four 16-bit marks; a key's mark stands in one of two buckets.

    The second bucket is the first one xor a hash of the mark, so a mark can move between its
    buckets, and be deleted, without its key."""

    def __init__(self, table: np.ndarray):
        self.table = table  # (buckets, SLOTS) of uint16, 0: free
        self.mask = np.uint64(len(table) - 1)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * 0.85 < max(keys, 1):
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        filled = cls.sized(len(keys))
        while not filled.insert(keys):
            filled = cls(np.zeros((2 * len(filled.table), SLOTS), np.uint16))
        return filled

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mark, first bucket, second bucket) of keys (uint64 hashes)."""
        marks = (keys >> np.uint64(48)).astype(np.uint16)
        marks[marks == 0] = 1
        first = (keys & self.mask).astype(np.int64)
        return marks, first, self.other(marks, first)

    def other(self, marks: np.ndarray, at: np.ndarray) -> np.ndarray:
        step = marks.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995)
        return at ^ ((step >> np.uint64(16)) & self.mask).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        marks, first, second = self.places(keys)
        return ((self.table[first] == marks[:, None]) | (self.table[second] == marks[:, None])).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if no free place was found: then the filter must be built anew, larger."""
        marks, at, other = self.places(keys)
        marks, at = self._settle(marks, at, other)
        for turn in range(500):
            if not len(marks):
                return True
            # marks that found both buckets full: one a bucket takes the place of a mark that stands
            # there, which moves on to its other bucket; the rest wait
            _, one = np.unique(at, return_index=True)
            slot = turn % SLOTS
            out = self.table[at[one], slot].copy()
            self.table[at[one], slot] = marks[one]
            waiting = np.ones(len(marks), bool)
            waiting[one] = False
            marks = np.concatenate((out, marks[waiting]))
            at = np.concatenate((self.other(out, at[one]), at[waiting]))
            marks, at = self._settle(marks, at, self.other(marks, at))
        return False

    def _settle(self, marks: np.ndarray, at: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put marks into free places of one bucket or the other; those left over, each at its other bucket."""
        for _ in range(2):
            left = self._put(marks, at)
            marks, at, other = marks[left], other[left], at[left]
        return marks, other

    def _put(self, marks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Fill the free places of buckets; which marks found none."""
        order = np.argsort(at, kind="stable")
        at = at[order]
        nth = np.arange(len(at)) - np.searchsorted(at, at)  # among the marks of the same bucket
        free = self.table[at] == 0
        fits = free & (np.cumsum(free, axis=1) == nth[:, None] + 1)
        row, slot = np.nonzero(fits)
        self.table[at[row], slot] = marks[order][row]
        left = np.ones(len(at), bool)
        left[order[row]] = False
        return np.flatnonzero(left)

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that are in the filter."""
        marks, at, other = self.places(keys)
        for _ in range(2):
            order = np.lexsort((marks, at))
            same = at[order] * (1 << 16) + marks[order]
            nth = np.arange(len(same)) - np.searchsorted(same, same)  # among equal marks of a bucket
            held = self.table[at[order]] == marks[order][:, None]
            row, slot = np.nonzero(held & (np.cumsum(held, axis=1) == nth[:, None] + 1))
            self.table[at[order][row], slot] = 0
            left = np.ones(len(at), bool)
            left[order[row]] = False
            marks, at, other = marks[left], other[left], at[left]


# --- lines ---------------------------------------------------------------------------------

def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def is_long(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def digest_of(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def text_hash(text: str | Column) -> Column:
    """What tells rows with one id apart."""
    return F.xxhash64(text)


def postings(docs: DataFrame, min_chars: int) -> DataFrame:
    """(hi, lo, doc_id, row): one row a document and distinct key of ``min_chars`` or more; ``row`` is
    the document's text hash."""
    texts = id_and_text(docs).withColumn("row", text_hash("text"))
    id_kind = texts.schema["doc_id"].dataType.simpleString()
    fields = [("hi", "bigint"), ("lo", "bigint"), ("doc_id", id_kind), ("row", "bigint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found, rows = [], []
                for row, text in enumerate(part.column(1)):
                    keys = {digest_of(k) for k in map(line_key, text.as_py().encode().split(b"\n")) if is_long(k, min_chars)}
                    found += keys
                    rows += [row] * len(keys)
                halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                rows = pa.array(rows, pa.int64())
                yield record_batch([halves[:, 0], halves[:, 1], part.column(0).take(rows), part.column(2).take(rows)], fields)

    return arrow_map(texts, run, fields)


def reference_counts(held: DataFrame) -> DataFrame:
    """(hi, lo, n, keeper): documents that hold a key, and the largest of them."""
    return held.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))


# --- the index -----------------------------------------------------------------------------

@dataclass(frozen=True)
class LineIndex:
    """Written tables: postings, counts of keys in ``min_docs`` documents or more, filters."""
    postings: DataFrame
    shared: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int
    min_docs: int


def shards_for(keys: int) -> int:
    return max(1, -(-keys // SHARD_KEYS))


def in_shards(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int"))


def _filters(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, keys, cuckoo): a filter of the distinct keys of each shard, built in its own task."""
    fields = [("shard", "int"), ("keys", "bigint"), ("cuckoo", "binary")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            shard, hi, lo = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for s in np.unique(shard):
                held.setdefault(int(s), []).append(hi[shard == s] ^ lo[shard == s])
        for s, parts in held.items():
            marks = np.concatenate(parts).view("u8")
            yield record_batch([[s], [len(marks)], [CuckooFilter.of(marks).dump()]], fields)

    return arrow_map(in_shards(keys, shards).select("shard", *KEY).repartition("shard"), build, fields)


def build_index(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> LineIndex:
    held = written(postings(docs, min_chars), "line-postings")
    return _indexed(held, min_chars, min_docs)


def _indexed(held: DataFrame, min_chars: int, min_docs: int) -> LineIndex:
    shared = written(reference_counts(held).where(F.col("n") >= min_docs), "line-counts")
    shards = shards_for(shared.count())
    return LineIndex(held, shared, written(_filters(shared, shards), "line-filters"), shards, min_chars, min_docs)


def insert_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with the documents ``docs`` added."""
    new = written(postings(docs, index.min_chars), "line-inserted")
    return _changed(index, written(index.postings.unionByName(new), "line-postings"), new)


def delete_documents(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without the documents whose ids are the column ``doc_id`` of ``doc_ids``."""
    gone = doc_ids.select("doc_id").distinct()
    old = written(index.postings.join(gone, "doc_id", "left_semi").select(*KEY, "doc_id", "row"), "line-deleted")
    return _changed(index, written(index.postings.join(gone, "doc_id", "left_anti").select(*KEY, "doc_id", "row"), "line-postings"), old)


def _changed(index: LineIndex, held: DataFrame, delta: DataFrame) -> LineIndex:
    """Count the touched keys again; move those that cross the threshold in or out of the filters."""
    touched = delta.select(*KEY).distinct()
    counted = reference_counts(held.join(touched, KEY, "left_semi")).where(F.col("n") >= index.min_docs)
    shared = written(index.shared.join(touched, KEY, "left_anti").unionByName(counted), "line-counts")
    shards = shards_for(shared.count())
    if not shards / 2 <= index.shards <= 2 * shards:  # other shards: all filters are built anew
        return LineIndex(held, shared, written(_filters(shared, shards), "line-filters"), shards, index.min_chars, index.min_docs)
    added = shared.join(index.shared, KEY, "left_anti").select(*KEY, F.lit(1).alias("change"))
    dropped = index.shared.join(shared, KEY, "left_anti").select(*KEY, F.lit(-1).alias("change"))

    def change(key, old, new):
        import pandas as pd
        marks = (new["hi"].to_numpy("i8") ^ new["lo"].to_numpy("i8")).view("u8")
        plus, minus = marks[new["change"].to_numpy() > 0], marks[new["change"].to_numpy() < 0]
        filled = CuckooFilter.load(old["cuckoo"].iloc[0]) if len(old) else CuckooFilter.sized(len(plus))
        n = (int(old["keys"].iloc[0]) if len(old) else 0) + len(plus) - len(minus)
        filled.delete(minus)
        # full: no data to build anew from here, so the shard is marked for that
        data = filled.dump() if n <= 0.9 * filled.table.size and filled.insert(plus) else None
        return pd.DataFrame({"shard": [key[0]], "keys": [n], "cuckoo": [data]})

    moved = in_shards(added.unionByName(dropped), index.shards)
    filters = written(index.filters.groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(
        change, "shard int, keys bigint, cuckoo binary"), "line-filters")
    full = [r["shard"] for r in filters.where("cuckoo is null").select("shard").collect()]  # numbers of shards
    rebuilt = _filters(in_shards(shared, index.shards).where(F.col("shard").isin(full)), index.shards)
    filters = written(filters.where("cuckoo is not null").unionByName(rebuilt), "line-filters")
    return LineIndex(held, shared, filters, index.shards, index.min_chars, index.min_docs)


# --- dropping ------------------------------------------------------------------------------

def candidate_hits(index: LineIndex, held: DataFrame) -> DataFrame:
    """Postings whose key is in its shard's filter: all shared keys, few others. Shards whose filter is
    too large to be broadcast pass all their postings."""
    spark = held.sparkSession
    sizes = index.filters.select("shard", F.length("cuckoo").alias("bytes")).orderBy("shard").collect()  # one row a shard
    groups, large, room = [], [], 0
    for row in sizes:
        if row["bytes"] > FILTER_BYTES:
            large.append(row["shard"])
            continue
        if not groups or room + row["bytes"] > FILTER_BYTES:
            groups.append([])
            room = 0
        groups[-1].append(row["shard"])
        room += row["bytes"]
    id_kind = held.schema["doc_id"].dataType.simpleString()
    fields = [("shard", "int"), ("hi", "bigint"), ("lo", "bigint"), ("doc_id", id_kind), ("row", "bigint")]
    dealt = in_shards(held, index.shards).select(*(name for name, _ in fields))
    parts = [dealt.where(F.col("shard").isin(large))]
    for shards in groups:
        rows = index.filters.where(F.col("shard").isin(shards)).collect()
        shared = spark.sparkContext.broadcast({r["shard"]: bytes(r["cuckoo"]) for r in rows})  # at most FILTER_BYTES

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            loaded: dict[int, CuckooFilter] = {}
            for batch in batches:
                shard, hi, lo = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
                hit = np.zeros(batch.num_rows, bool)
                for s in np.unique(shard).tolist():
                    if s not in loaded:
                        loaded[s] = CuckooFilter.load(shared.value[s])
                    at = np.flatnonzero(shard == s)
                    hit[at] = loaded[s].contains((hi[at] ^ lo[at]).view("u8"))
                yield batch.filter(pa.array(hit))

        parts.append(arrow_map(dealt.where(F.col("shard").isin(shards)), probe, fields))
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    return hits


def lost_keys(index: LineIndex, held: DataFrame) -> DataFrame:
    """(doc_id, row, lost): digests of the keys whose lines a document loses."""
    exact = (candidate_hits(index, held).join(index.shared.select(*KEY, "keeper"), KEY)
             .where(~F.col("doc_id").eqNullSafe(F.col("keeper"))))
    keys = F.collect_set(F.struct("hi", "lo"))
    return exact.groupBy("doc_id", "row").agg(F.flatten(F.transform(keys, lambda k: F.array(k["hi"], k["lo"]))).alias("lost"))


def kept_lines(min_chars: int):
    """Pandas UDF (text, lost) -> struct(n_lines, n_dropped, kept_text)."""

    @F.pandas_udf("n_lines bigint, n_dropped bigint, kept_text string")
    def cut(texts, lost):
        import pandas as pd
        out: tuple[list, list, list] = ([], [], [])
        for text, keys in zip(texts, lost, strict=True):
            lines = text.split("\n")
            n = len(lines)
            if keys is not None:
                halves = np.asarray(keys, "<i8").tobytes()
                gone = {halves[i:i + 16] for i in range(0, len(halves), 16)}
                lines = [x for x in lines if not (is_long(k := line_key(x.encode()), min_chars) and digest_of(k) in gone)]
                text = "\n".join(lines)
            for column, value in zip(out, (n, n - len(lines), text), strict=True):
                column.append(value)
        return pd.DataFrame({"n_lines": out[0], "n_dropped": out[1], "kept_text": out[2]})

    return cut


def _cut(docs: DataFrame, index: LineIndex | None, min_chars: int, min_docs: int) -> tuple[DataFrame, str]:
    """``docs`` with a struct of what ``kept_lines`` gives, and the name of its column."""
    index = index or build_index(docs, min_chars, min_docs)
    own = "cut"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    doc, row, gone = f"{own}id", f"{own}row", f"{own}lost"
    lost = lost_keys(index, index.postings).select(F.col("doc_id").alias(doc), F.col("row").alias(row), F.col("lost").alias(gone))
    ship_package(docs.sparkSession)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    joined = docs.join(lost, docs["doc_id"].eqNullSafe(F.col(doc)) & (text_hash(text) == F.col(row)), "left")
    return joined.withColumn(own, kept_lines(index.min_chars)(text, F.col(gone))).drop(doc, row, gone), own


def dedup_lines(docs: DataFrame, index: LineIndex | None = None, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_text.

    With an ``index`` the documents must be among its own; without one it is built from them."""
    cut, own = _cut(docs, index, min_chars, min_docs)
    return cut.select("doc_id", f"{own}.*")


def rewrite_documents(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with all its columns: shared lines are gone from ``text``, ``n_chars`` follows."""
    cut, own = _cut(docs, None, min_chars, min_docs)
    new = {"text": F.col(f"{own}.kept_text"), "n_chars": F.char_length(f"{own}.kept_text").cast("bigint")}
    kinds = dict(docs.dtypes)
    return cut.select(*[new[c].cast(kinds[c]).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def line_digests(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document: n_lines, n_dropped, kept_sha256."""
    out = dedup_lines(docs, None, min_chars, min_docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))
