"""Operator 10: token ids in fixed-width bit-packed files.

``write_tokens`` encodes texts with the tokenizers library, appends the end id to each
document and writes *blocks*: runs of whole documents of at least ``BLOCK_IDS`` ids, in
ascending ``doc_id`` order. A block is one binary record:

    magic "TIB1" | width (bits an id) u32 | documents u64 | ids u64 | end of each document in ids u64... | packed ids

Each id takes the least number of bits that hold the vocabulary's largest id; bit ``i *
width`` is where id ``i`` begins (little-endian bit order), so any id or document is found
by arithmetic on the offsets and unpacked with vectorised numpy. Block records are rows of
a Parquet folder, with their shard (range of ids), place, document ids and the position of
their first id in the shard: Spark's writer commits them on any shared store, whole or not
at all, whichever executors are lost. ``read_tokens`` unpacks blocks in parallel;
``read_document`` reads the blocks of one document only, by the pushed-down id bounds.

Scale: one shuffle of the texts, by ranges of ``doc_id``; encoding, packing and unpacking are
per-partition work. Positions over all files need one total a shard (as many rows as there
are files).

Edge cases: NULL and empty texts give the end id alone; NULL ids sort first; repeated rows
are documents of their own, rows with equal ids sort by text; an empty table gives no
blocks; a text longer than a block gets a longer block.
"""

from __future__ import annotations

import gc
import json
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carlot.llm.bpe import ByteBpe, Bounded, byte_characters, read_spec
from carlot.llm.common import arrow_map, id_and_text, id_ranges, record_batch
from carlot.session import shared_scratch_dir

BLOCK_IDS = 1 << 16
MAGIC = b"TIB1"
HEADER = struct.Struct("<4sIQQ")


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each, least significant bit first."""
    ids = np.asarray(ids, "<u4")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(packed, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` (exclusive), reading only the bytes that hold them."""
    if stop <= start:
        return np.empty(0, "<u4")
    raw = np.frombuffer(packed, np.uint8)
    if width in (8, 16, 32):
        size = width // 8
        return raw[start * size:stop * size].view(f"<u{size}").astype("<u4")
    lo = start * width
    bits = np.unpackbits(raw[lo // 8:(stop * width + 7) // 8], bitorder="little")[lo % 8:lo % 8 + (stop - start) * width]
    out = np.zeros((stop - start, 32), np.uint8)
    out[:, :width] = bits.reshape(-1, width)
    return np.packbits(out, axis=1, bitorder="little").view("<u4").ravel()


def make_block(documents: list[np.ndarray], width: int) -> bytes:
    ends = np.cumsum([len(d) for d in documents], dtype="<u8")
    ids = np.concatenate(documents)
    return HEADER.pack(MAGIC, width, len(documents), len(ids)) + ends.tobytes() + pack(ids, width)


class Block:
    """Random access into one block record."""

    def __init__(self, record: bytes):
        magic, self.width, documents, self.n_ids = HEADER.unpack_from(record)
        if magic != MAGIC:
            raise ValueError("not a token block")
        self.ends = np.frombuffer(record, "<u8", documents, HEADER.size)
        self.packed = memoryview(record)[HEADER.size + 8 * documents:]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        return unpack(self.packed, self.width, start, self.n_ids if stop is None else stop)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


class LibraryBpe(ByteBpe):
    """The tokenizers library's model behind the cache of pre-tokens: each pre-token that
    isn't known yet goes through the library once, and texts are joined from them."""

    def __init__(self, spec: str, cached: int = 700_000):
        from tokenizers import Tokenizer
        super().__init__(spec, cached=cached)
        self.tokenize = Tokenizer.from_str(spec).model.tokenize
        of_byte = byte_characters()
        #: Character -> its bytes as the vocabulary writes them.
        self.shown = Bounded(lambda c: "".join(of_byte[b] for b in c.encode()), 1 << 16)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word[1:].isalnum():
            shown = self.shown[word[0]] + word[1:]  # letters and digits stand for themselves
        else:
            shown = "".join(map(self.shown.__getitem__, word))
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()


_ENCODERS: dict[tuple, LibraryBpe] = {}


def library_encoder(spec: str) -> LibraryBpe:
    key = (len(spec), hash(spec))
    if key not in _ENCODERS:
        _ENCODERS[key] = LibraryBpe(spec)
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int | None, path: str,
                 block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write the blocks to ``path`` (a folder on a shared store)."""
    spec_text = read_spec(vocabulary)
    spec = json.loads(spec_text)
    largest = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    width = bits_for(max(largest, end_id or 0) + 1)
    shared = docs.sparkSession.sparkContext.broadcast(spec_text)
    texts = id_and_text(docs)
    id_kind = texts.schema["doc_id"].dataType.simpleString()
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    fields = [("shard", "int"), ("block", "bigint"), ("first", "bigint"), ("n_ids", "bigint"),
              ("doc_ids", f"array<{id_kind}>"), ("min_doc", id_kind), ("max_doc", id_kind), ("record", "binary")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(shared.value)
        shard = TaskContext.get().partitionId()
        waiting, ids, n, block, first = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            names = [x for x in ids if x is not None]
            return record_batch([[shard], [block], [first], [n], [ids], [min(names, default=None)],
                                 [max(names, default=None)], [make_block(waiting, width)]], fields)

        # nothing here makes cycles, and collections would walk through the large caches
        collecting = gc.isenabled()
        gc.disable()
        try:
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    document = np.frombuffer(encoder.encode(text.as_py()) + end, "<u4")
                    waiting.append(document)
                    ids.append(doc)
                    n += len(document)
                    if n >= block_ids:
                        yield flush()
                        first += n
                        block += 1
                        waiting, ids, n = [], [], 0
            if waiting:
                yield flush()
        finally:
            if collecting:
                gc.enable()

    # ranges of ids by quantiles, a partition each: the quantiles read the ids alone
    partitions = 1 << (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    in_order = texts.repartitionById(partitions, id_ranges(texts, partitions)).sortWithinPartitions("doc_id", "text")
    arrow_map(in_order, run, fields).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """(shard, shard_start): ids in all earlier shards. One row a file, so one small window."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shard_start"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: start, n_tokens, ids_crc32."""
    blocks = read_blocks(spark, path)
    id_kind = blocks.schema["min_doc"].dataType.simpleString()
    fields = [("shard", "int"), ("doc_id", id_kind), ("place", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, first, docs = (batch.column(k)[row].as_py() for k in range(3))
                block = Block(batch.column(3)[row].as_buffer())
                ids = block.ids()
                ends = block.ends.astype("i8")
                starts = np.concatenate(([0], ends[:-1]))
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield record_batch([[shard] * len(docs), docs, first + starts, ends - starts, crc], fields)

    found = arrow_map(blocks.select("shard", "first", "doc_ids", "record"), run, fields)
    return (found.join(shard_starts(blocks), "shard")
            .select("doc_id", (F.col("shard_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"))


def read_document(spark: SparkSession, path: str, doc_id) -> list[np.ndarray]:
    """Random access: ids of the documents with this id, from the blocks that can hold it."""
    rows = (read_blocks(spark, path).where((F.col("min_doc") <= doc_id) & (F.col("max_doc") >= doc_id))
            .orderBy("shard", "block").select("doc_ids", "record").toLocalIterator())
    return [Block(bytes(r["record"])).document(k) for r in rows for k, d in enumerate(r["doc_ids"]) if d == doc_id]


def token_files(docs: DataFrame, vocabulary: str, end_id: int | None, path: str | None = None,
                block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the files (to a fresh shared folder unless ``path`` is given) and read them back."""
    spark = docs.sparkSession
    path = path or shared_scratch_dir(spark, "token-files")
    write_tokens(docs, vocabulary, end_id, path, block_ids)
    return read_tokens(spark, path)
