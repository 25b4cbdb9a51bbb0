"""Operator 6: repeated passages by a depth-limited radix sort of suffixes.

Every suffix of a document that has ``depth`` bytes or more is a window; windows are sorted
through ``depth`` bytes only, most significant digit first, and groups that stay equal
through all digits are exactly the repeated windows. A byte goes if some window over it also
starts in a document with a smaller id. Windows never cross documents.

To sort 17 windows at the price of one, the most significant digit is defined by content:
it is the least hash among the ``GRAM``-byte strings of the window (its minimizer). Equal
windows have equal digits, and neighbouring windows mostly share theirs, so they travel
as one *run*:

1. first digit: runs are dealt by their digit; runs whose digit no other document has are done;
2. second digit: the hash of a run's whole content. Runs that an earlier document has too are
   repeated as a whole, and done;
3. the rest are runs at the edges of copies: the first holders of each distinct content under a
   digit that several contents share. Their windows are sorted byte by byte (eight bytes a pass),
   dropping groups of a single document after each pass, down to ``depth``. Under a digit with more
   than ``SPLIT_RUNS`` distinct contents (a line that many documents hold in different
   surroundings) windows are dealt by the hash of all their bytes instead: equal windows meet,
   one entry a batch, and no task holds the whole digit.

Scale: texts are kept as compressed batches in the shared folder, and pass 1 and 2 shuffle
14 packed bytes a run and batch (equal runs of a batch count once, so a passage that a third of all
documents hold is one entry a batch). Verdicts come back as a few bits a run. Work per shard
is bounded: the number of shards follows the bytes of text. Any task can be run again: batches
are written before they are used.

Edge cases: NULL and empty texts keep nothing and lose nothing; columns other than ``doc_id`` and
``text`` are ignored, whatever their names; a NULL doc_id counts as smaller
than any other; rows with equal ids never remove each other's bytes; an empty table gives an
empty result; a text longer than a batch makes a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import arrow_map, ddl, id_and_text, record_batch, written

GRAM = 16
RUN = 32  # windows in a run at most, so that a run's verdict fits a 32-bit mask
BATCH_BYTES = 4 << 20
BATCH_DOCS = 60_000
BLOCK_BYTES = 1 << 18
SHARD_BYTES = 8 << 20
SPLIT_RUNS = 4096  # distinct contents under a digit, above which its windows are dealt one by one
NO_ID = -(1 << 63)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = {"up": np.ones(1, "u8"), "down": np.ones(1, "u8")}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_BYTE = mix(np.arange(1, 257, dtype="u8") * _BASE)


def powers(kind: str, n: int) -> np.ndarray:
    if len(_POWERS[kind]) < n:
        steps = np.full(n, _BASE if kind == "up" else _INVERSE, "u8")
        steps[0] = 1
        _POWERS[kind] = np.cumprod(steps)
    return _POWERS[kind][:n]


@dataclass
class Runs:
    """Runs of windows with one digit: place of the first window, windows, digit, content, row."""
    start: np.ndarray
    windows: np.ndarray
    digit: np.ndarray
    content: np.ndarray
    row: np.ndarray


def block_runs(data: np.ndarray, ends: np.ndarray, depth: int) -> Runs:
    """Runs of documents that stand one behind the other in ``data``."""
    n, width = len(data), depth - GRAM + 1
    starts = np.concatenate(([0], ends[:-1]))
    fits = ends - starts >= depth
    none = np.empty(0, "i8")
    if not fits.any():
        return Runs(none, none, none.view("u8"), none.view("u8"), none)
    down = powers("down", n)
    # prefix sums of byte * base**place: the hash of any stretch is a difference, moved to place 0
    sums = np.concatenate((np.zeros(1, "u8"), np.cumsum(_BYTE[data] * powers("up", n))))
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1])
    least, step = grams, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:n - depth + 1], least[width - step:width - step + n - depth + 1])
    change = np.zeros(n + 1, "i4")
    change[starts[fits]] += 1
    change[ends[fits] - depth + 1] -= 1
    at = np.flatnonzero(np.cumsum(change[:n - depth + 1]) > 0)
    digit = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (digit[1:] != digit[:-1])
    places = np.arange(len(at))
    new |= (places - np.maximum.accumulate(np.where(new, places, 0))) % RUN == 0
    first = np.flatnonzero(new)
    start, windows = at[first], np.diff(np.append(first, len(at)))
    stop = start + windows - 1 + depth
    content = mix((sums[stop] - sums[start]) * down[start]) ^ windows.astype("u8")
    return Runs(start, windows, digit[first], content, np.searchsorted(ends, start, "right"))


class Batch:
    """Documents of one batch, and its entries: distinct (digit, content) with the least id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, data: bytes, depth: int, shards: int):
        self.ids, self.depth = ids, depth
        self.data = np.frombuffer(data, np.uint8)
        self.ends = np.cumsum(lengths)
        parts, lo = [], 0
        while lo < len(ids):  # in blocks, to bound memory
            base = int(self.ends[lo] - lengths[lo])
            hi = max(lo + 1, int(np.searchsorted(self.ends, base + BLOCK_BYTES)))
            r = block_runs(self.data[base:int(self.ends[hi - 1])], self.ends[lo:hi] - base, depth)
            parts.append(Runs(r.start + base, r.windows, r.digit, r.content, r.row + lo))
            lo = hi
        self.runs = Runs(*(np.concatenate([getattr(p, f) for p in parts]) if parts else np.empty(0, kind)
                           for f, kind in (("start", "i8"), ("windows", "i8"), ("digit", "u8"), ("content", "u8"), ("row", "i8"))))
        r = self.runs
        shard = (r.digit % np.uint64(shards)).astype("i4")
        doc = ids[r.row] if len(r.row) else np.empty(0, "i8")
        order = np.lexsort((doc, r.content, r.digit, shard))
        digit, content = r.digit[order], r.content[order]
        new = np.ones(len(order), bool)
        new[1:] = (digit[1:] != digit[:-1]) | (content[1:] != content[:-1])
        first = order[new]  # the run of the least id of each entry
        self.entry = np.empty(len(order), "i8")
        self.entry[order] = np.cumsum(new) - 1
        self.first = first
        self.digit, self.content, self.doc, self.row = digit[new], content[new], doc[first], r.row[first]
        self.holder = doc == self.doc[self.entry] if len(order) else np.empty(0, bool)
        #: entries of shard s: edges[s] to edges[s + 1]
        self.edges = np.searchsorted(shard[first], np.arange(shards + 1))


def packed_docs(ids: np.ndarray, rows: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Distinct ids as binary, and the place of each row's id among them."""
    table, places = np.unique(ids[rows], return_inverse=True)
    small = len(table) and int(table[-1]) - int(table[0]) < 1 << 32
    body = (table - table[0]).astype("<u4").tobytes() if small else table.astype("<i8").tobytes()
    return bytes([4 if small else 8]) + (int(table[0]) if small else 0).to_bytes(8, "little", signed=True) + body, places


def unpacked_docs(data: bytes) -> np.ndarray:
    base = int.from_bytes(data[1:9], "little", signed=True)
    return np.frombuffer(data, f"<{'u4' if data[0] == 4 else 'i8'}", offset=9).astype("i8") + base


# --- the passes ----------------------------------------------------------------------------

BATCH_FIELDS = [("batch", "bigint"), ("ids", "array<bigint>"), ("is_null", "binary"), ("lengths", "array<bigint>"), ("bytes", "bigint"), ("texts", "binary")]
ENTRY_FIELDS = [("shard", "int"), ("batch", "bigint"), ("docs", "binary"), ("entries", "binary")]
VERDICT_FIELDS = [("batch", "bigint"), ("shard", "int"), ("verdicts", "binary")]
EDGE_FIELDS = [("shard", "int"), ("batch", "bigint"), ("docs", "binary"), ("entries", "binary"), ("windows", "binary"), ("contents", "binary")]

DONE, REPEATED, EDGE, SPLIT = 0, 1, 2, 3


def text_batches(docs: DataFrame) -> DataFrame:
    """Compressed batches of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            nulls = np.packbits(np.array([i is None for i in ids], np.uint8)).tobytes()
            return record_batch([[number], [[NO_ID if i is None else i for i in ids]], [nulls], [[len(t) for t in texts]], [size], [data]], BATCH_FIELDS)

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(doc.as_py())
                texts.append(text.as_py().encode())
                size += len(texts[-1])
                if size >= BATCH_BYTES or len(ids) >= BATCH_DOCS:
                    yield flush()
                    number += 1
                    ids, texts, size = [], [], 0
        if ids:
            yield flush()

    return arrow_map(id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")), run, BATCH_FIELDS)


def loaded(batch: pa.RecordBatch, row: int, depth: int, shards: int) -> Batch:
    value = {name: batch.column(name)[row] for name in ("ids", "lengths", "texts", "bytes")}
    ids, lengths = (value[k].values.to_numpy(zero_copy_only=False) for k in ("ids", "lengths"))
    data = zstandard.ZstdDecompressor().decompress(value["texts"].as_py(), max_output_size=max(1, value["bytes"].as_py()))
    return Batch(ids, lengths, data, depth, shards)


def filled(edges: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The shards that get entries: a batch sends a row to these alone, at most one an entry."""
    for s in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        yield s, slice(int(edges[s]), int(edges[s + 1]))


def run_entries(batches: DataFrame, depth: int, shards: int) -> DataFrame:
    """Pass 1 and 2, sending side: the entries of each batch by shard, 14 bytes and the document's place each."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                b = loaded(batch, i, depth, shards)
                for s, at in filled(b.edges):
                    docs, places = packed_docs(b.ids, b.row[at])
                    entries = packed_entries(b.digit[at], b.content[at], places)
                    yield record_batch([[s], [batch.column("batch")[i].as_py()], [docs], [entries]], ENTRY_FIELDS)

    return arrow_map(batches, run, ENTRY_FIELDS)


def group_edges(*keys: np.ndarray) -> np.ndarray:
    """True where a row of sorted ``keys`` differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def judge_entries(table: pa.Table, split_runs: int) -> pa.Table:
    """Pass 1 and 2, one shard: a verdict for each entry, in the order of its batch."""
    digits, contents, docs, sizes = [], [], [], []
    for packed, data in zip(table.column("docs").to_pylist(), table.column("entries").to_pylist(), strict=True):
        n = len(data) // 15
        low = np.zeros((n, 8), "u1")
        low[:, :5] = np.frombuffer(data, "u1", 5 * n).reshape(-1, 5)
        digits.append(low.view("<u8").ravel())
        contents.append(np.frombuffer(data, "<u8", n, 5 * n))
        docs.append(unpacked_docs(packed)[np.frombuffer(data, "<u2", n, 13 * n)])
        sizes.append(n)
    digit, content, doc = (np.concatenate(x) for x in (digits, contents, docs))
    order = np.lexsort((doc, content, digit))
    digit, content, sorted_doc = digit[order], content[order], doc[order]
    by_digit, by_content = group_edges(digit), group_edges(digit, content)
    holder = sorted_doc[by_content]  # least id of each content
    content_no = np.cumsum(by_content) - 1
    first = np.flatnonzero(by_digit[by_content])  # first content of each digit
    several = np.minimum.reduceat(holder, first) != np.maximum.reduceat(holder, first)
    contents_of = np.diff(np.append(first, len(holder)))
    edge = np.repeat(np.where(several, np.where(contents_of > split_runs, SPLIT, EDGE), DONE), contents_of)
    verdict = np.empty(len(doc), "u1")
    verdict[order] = np.where(sorted_doc > holder[content_no], REPEATED, edge[content_no])
    pack = zstandard.ZstdCompressor(level=1)
    return pa.table([table.column("batch"), table.column("shard"),
                     pa.array([pack.compress(v.tobytes()) for v in np.split(verdict, np.cumsum(sizes)[:-1])], pa.binary())],
                    names=[n for n, _ in VERDICT_FIELDS])


def with_verdicts(batches: DataFrame, verdicts: DataFrame, name: str) -> DataFrame:
    by_batch = verdicts.groupBy("batch").agg(F.collect_list(F.struct("shard", "verdicts")).alias(name))
    return batches.join(by_batch, "batch", "left")


def gathered(batch: pa.RecordBatch, name: str, row: int, kind: str, shards: range | None = None) -> dict[int, np.ndarray]:
    return {v["shard"]: np.frombuffer(zstandard.ZstdDecompressor().decompress(v["verdicts"]), kind)
            for v in batch.column(name)[row].as_py() or [] if shards is None or v["shard"] in shards}


def entry_verdicts(found: dict[int, np.ndarray]) -> np.ndarray:
    return np.concatenate([found[s] for s in sorted(found)]) if found else np.empty(0, "u1")


class SplitWindows:
    """Windows of a batch's runs under split digits, and their entries: distinct (digit, hash of all
    bytes) with the least id, by shard of that hash."""

    def __init__(self, b: Batch, verdict: np.ndarray, shards: int):
        at = np.flatnonzero(verdict == SPLIT)
        start, windows = b.runs.start[b.first[at]], b.runs.windows[b.first[at]]
        self.run = np.repeat(at, windows)  # entry of the batch that each window belongs to
        self.nth = np.arange(len(self.run)) - np.repeat(np.cumsum(windows) - windows, windows)
        places, up = np.repeat(start, windows) + self.nth, powers("up", b.depth)
        hashes = np.empty(len(places), "u8")
        for lo in range(0, len(places), 1 << 14):  # in blocks, to bound memory
            own = b.data[places[lo:lo + (1 << 14), None] + np.arange(b.depth)]
            hashes[lo:lo + (1 << 14)] = mix((_BYTE[own] * up).sum(1, dtype="u8"))
        digit, self.doc, shard = b.digit[self.run], b.doc[self.run], (hashes % np.uint64(shards)).astype("i4")
        order = np.lexsort((self.doc, hashes, digit, shard))
        new = group_edges(digit[order], hashes[order])
        first = order[new]
        self.entry = np.empty(len(order), "i8")
        self.entry[order] = np.cumsum(new) - 1
        self.digit, self.hashes, self.least, self.row = digit[first], hashes[first], self.doc[first], b.row[self.run[first]]
        self.edges = np.searchsorted(shard[first], np.arange(shards + 1))

    def repeated(self, verdict: np.ndarray) -> np.ndarray:
        """Windows that a document with a smaller id holds too, by the verdicts on the entries."""
        return (verdict[self.entry] == REPEATED) | (self.doc > self.least[self.entry])


def packed_entries(digit: np.ndarray, content: np.ndarray, places: np.ndarray) -> bytes:
    return digit.view("u1").reshape(-1, 8)[:, :5].tobytes() + content.tobytes() + places.astype("<u2").tobytes()


def edge_entries(judged: DataFrame, depth: int, shards: int) -> DataFrame:
    """Pass 3, sending side: content of the runs whose windows must be sorted one by one, and the
    window entries of split digits, whose shards are numbered behind the others."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                b = loaded(batch, i, depth, shards)
                verdict = entry_verdicts(gathered(batch, "judged", i, "u1"))
                edge = np.flatnonzero(verdict == EDGE)
                for s, of_shard in filled(np.searchsorted(edge, b.edges)):
                    at = edge[of_shard]
                    docs, places = packed_docs(b.ids, b.row[at])
                    start, windows = b.runs.start[b.first[at]], b.runs.windows[b.first[at]]
                    contents = b"".join(b.data[x:x + w - 1 + depth].tobytes() for x, w in zip(start.tolist(), windows.tolist(), strict=True))
                    entries = b.digit[at].tobytes() + places.astype("<u2").tobytes()
                    yield record_batch([[s], [batch.column("batch")[i].as_py()], [docs], [entries],
                                        [windows.astype("u1").tobytes()], [contents]], EDGE_FIELDS)
                if (verdict == SPLIT).any():
                    w = SplitWindows(b, verdict, shards)
                    for s, at in filled(w.edges):
                        docs, places = packed_docs(b.ids, w.row[at])
                        yield record_batch([[shards + s], [batch.column("batch")[i].as_py()], [docs],
                                            [packed_entries(w.digit[at], w.hashes[at], places)], [b""], [b""]], EDGE_FIELDS)

    return arrow_map(judged, run, EDGE_FIELDS)


def digits_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one big-endian number."""
    words = np.concatenate((data, np.zeros(8, "u1"))).astype("u8")
    for bits in (8, 16, 32):
        words = (words[:-(bits // 8)] << np.uint64(bits)) | words[bits // 8:]
    return words


def radix_groups(data: np.ndarray, at: np.ndarray, group: np.ndarray, doc: np.ndarray, depth: int) -> np.ndarray:
    """Windows (indexes into ``at``) that a document with a smaller id holds too.

    ``group`` is the digit they were dealt by. Each pass sorts the groups that are left by the
    next eight bytes and drops those of a single document."""
    words = digits_of(data)
    alive = np.arange(len(at))
    for place in range(0, depth, 8):
        digit = words[at[alive] + place]
        if depth - place < 8:
            digit = digit >> np.uint64(8 * (8 - depth + place))
        order = np.lexsort((digit, group))
        alive, group, digit = alive[order], group[order], digit[order]
        new = group_edges(group, digit)
        first = np.flatnonzero(new)
        if not len(first):
            return alive
        least, most = np.minimum.reduceat(doc[alive], first), np.maximum.reduceat(doc[alive], first)
        group = np.cumsum(new) - 1
        keep = (least != most)[group]
        alive, group = alive[keep], group[keep]
    if not len(alive):
        return alive
    first = np.flatnonzero(group_edges(group))
    least = np.repeat(np.minimum.reduceat(doc[alive], first), np.diff(np.append(first, len(alive))))
    return alive[doc[alive] > least]


def judge_edges(depth: int, shards: int):
    def judge(table: pa.Table) -> pa.Table:
        """Pass 3, one shard: for each entry the mask of its windows that are repeated; for window
        entries a verdict as in pass 2, of which REPEATED alone counts."""
        if table.column("shard")[0].as_py() >= shards:
            return judge_entries(table, SPLIT_RUNS)
        digits, docs, sizes = [], [], []
        for packed, data in zip(table.column("docs").to_pylist(), table.column("entries").to_pylist(), strict=True):
            n = len(data) // 10
            digits.append(np.frombuffer(data, "<u8", n))
            docs.append(unpacked_docs(packed)[np.frombuffer(data, "<u2", n, 8 * n)])
            sizes.append(n)
        digit, doc = np.concatenate(digits), np.concatenate(docs)
        windows = np.frombuffer(b"".join(table.column("windows").to_pylist()), "u1").astype("i8")
        data = np.frombuffer(b"".join(table.column("contents").to_pylist()), "u1")
        start = np.cumsum(windows - 1 + depth) - (windows - 1 + depth)
        entry = np.repeat(np.arange(len(windows)), windows)
        nth = np.arange(len(entry)) - np.repeat(np.cumsum(windows) - windows, windows)
        hit = radix_groups(data, start[entry] + nth, digit[entry], doc[entry], depth)
        masks = np.zeros(len(windows), "<u4")
        np.bitwise_or.at(masks, entry[hit], np.uint32(1) << nth[hit].astype("u4"))
        pack = zstandard.ZstdCompressor(level=1)
        return pa.table([table.column("batch"), table.column("shard"),
                         pa.array([pack.compress(m.tobytes()) for m in np.split(masks, np.cumsum(sizes)[:-1])], pa.binary())],
                        names=[n for n, _ in VERDICT_FIELDS])

    return judge


def remove_repeats(docs: DataFrame, depth: int = 50) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and the bytes that are ``kept``."""
    if depth < GRAM + 1:
        raise ValueError(f"depth must be over {GRAM}")
    batches = written(text_batches(docs), "suffix-batches")
    size = batches.agg(F.sum("bytes")).first()[0] or 0
    shards = max(12, -(-size // SHARD_BYTES))
    schema = ddl(VERDICT_FIELDS)
    split_runs = SPLIT_RUNS
    judged = written(run_entries(batches, depth, shards).groupBy("shard")
                     .applyInArrow(lambda table: judge_entries(table, split_runs), schema), "suffix-verdicts")
    masks = written(edge_entries(with_verdicts(batches, judged, "judged"), depth, shards)
                    .groupBy("shard").applyInArrow(judge_edges(depth, shards), schema), "suffix-masks")
    fields = [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept", "binary")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                b = loaded(batch, i, depth, shards)
                verdict = entry_verdicts(gathered(batch, "judged", i, "u1"))
                mask = np.zeros(len(verdict), "u4")
                of_shard = gathered(batch, "masks", i, "<u4", range(shards))
                mask[verdict == EDGE] = np.concatenate([of_shard[s] for s in sorted(of_shard)]) if of_shard else 0
                if (verdict == SPLIT).any():
                    w = SplitWindows(b, verdict, shards)
                    hit = w.repeated(entry_verdicts(gathered(batch, "masks", i, "u1", range(shards, 2 * shards))))
                    np.bitwise_or.at(mask, w.run[hit], np.uint32(1) << w.nth[hit].astype("u4"))
                runs = b.runs
                repeated = (verdict[b.entry] == REPEATED) | ~b.holder
                change = np.zeros(len(b.data) + 1, "i4")
                np.add.at(change, runs.start[repeated], 1)
                np.add.at(change, runs.start[repeated] + runs.windows[repeated] - 1 + depth, -1)
                edge = np.flatnonzero(~repeated & (mask[b.entry] != 0))
                for k in range(RUN):
                    at = runs.start[edge[(mask[b.entry[edge]] >> np.uint32(k)) & np.uint32(1) == 1]] + k
                    np.add.at(change, at, 1)
                    np.add.at(change, at + depth, -1)
                gone = np.cumsum(change[:-1]) > 0
                nulls = np.unpackbits(np.frombuffer(batch.column("is_null")[i].as_py(), "u1"), count=len(b.ids)).astype(bool)
                lo = 0
                for part in range(0, len(b.ids), 512):
                    out: list[list] = [[], [], [], [], []]
                    for k in range(part, min(part + 512, len(b.ids))):
                        hi = int(b.ends[k])
                        own = gone[lo:hi]
                        spans = int(np.count_nonzero(own[1:] & ~own[:-1]) + (len(own) > 0 and own[0]))
                        for column, v in zip(out, [None if nulls[k] else int(b.ids[k]), hi - lo, int(np.count_nonzero(own)), spans, b.data[lo:hi][~own].tobytes()], strict=True):
                            column.append(v)
                        lo = hi
                    yield record_batch(out, fields)

    both = with_verdicts(with_verdicts(batches, judged, "judged"), masks, "masks")
    return arrow_map(both, run, fields)


def removal_digests(docs: DataFrame, depth: int = 50) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs, depth).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
