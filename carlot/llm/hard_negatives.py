"""Operator 12: hard negatives by angular triangle filtering.

Anchors (a stated query set: ids divisible by ``every``) are held against all vectors for two
questions: their best rows of the same label (positives), and for each positive the best rows of
another label whose score lies in a window of shares of the positive's score. Scores are integer
inner products of the quantised vectors.

Every row is stored once with its norm and its angles to ``REFERENCES`` reference directions.
For an anchor at angle t and a row at angle u from a reference, the angle between them lies in
[|t - u|, min(t + u, 2 pi - t - u)]; the tightest of these over all references, as cosines times
both norms, widened by more than any rounding error, bounds the score from both sides. Chunks of
rows, then rows, whose bounds don't overlap an anchor's window are discarded; the others are
scored in integers. A window's lower end rises to the last score that still counts as hits are
found. References come from a bounded sample (farthest-first among ``SAMPLE`` rows) and affect
the time only, never the result.

Scale: rows are packed in the partitions they are read in, without a shuffle. Blocks of rows meet
blocks of anchors in the cells of a grid (an equality join on the cell, each side dealt by hash),
so neither a label nor a vector that many rows share makes a large group. A cell gives at most
its anchors' best rows; a window per anchor merges the cells.

Edge cases: rows with a NULL label, a NULL vector, or any NULL or non-finite component take no
part; a row with a NULL id can be a positive or negative (its id stays NULL, and ties put it
last), never an anchor; rows that repeat an id are rows of their own, so an anchor's namesake can
be its positive; shorter vectors count as filled with zeros, zero vectors score 0; components
beyond +-2^52 count as +-2^52 and scores beyond +-2^62 as +-2^62; a table without rows or anchors
gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carlot.llm.common import arrow_map, ddl, dropped, record_batch, written

REFERENCES = 16
SAMPLE = 4096
#: Rows of a block and of a cell, anchors of a cell; rows and anchors whose bounds are found at once.
CELL_ROWS, CELL_ANCHORS = 1 << 16, 1 << 10
CHUNK_ROWS, CHUNK_ANCHORS = 2048, 128
#: Radians and shares of the norms' product by which bounds are widened (angles are kept in 32 bits).
SLACK = 1e-5
NO_ID = np.iinfo("i8").max
MOST = 1 << 62

BLOCK = [("block", "bigint"), ("n", "bigint"), ("ids", "binary"), ("labels", "binary"), ("vectors", "binary"),
         ("kind", "string"), ("norms", "binary"), ("angles", "binary")]


# --- rows ------------------------------------------------------------------------------

def quantised(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors as integers, filled with zeros to the longest)."""
    lengths = np.array(column.value_lengths().fill_null(0), "i8")
    flat = column.flatten()
    values = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.array(column.is_null())
    bad[row[~np.isfinite(values)]] = True
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.clip(np.floor(values * scale), -2.0**52, 2.0**52)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    good = ~bad[row]
    out = np.zeros((len(lengths), int(lengths[~bad].max(initial=0))), "f8")
    out[row[good], place[good]] = values[good]
    return np.flatnonzero(~bad), out[~bad].astype("i8")


def angles_to(references: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Radians, 32 bits: a column a reference. A zero vector's angles don't matter."""
    d = min(references.shape[1], vectors.shape[1])
    dots = vectors[:, :d].astype("f8") @ references[:, :d].T
    return np.arccos(np.clip(dots / np.maximum(norms, 1e-300)[:, None], -1, 1)).astype("f4")


def norms_of(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype("f8") ** 2).sum(axis=1))


def narrow(vectors: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as hold them."""
    most = int(np.abs(vectors).max(initial=0))
    return vectors.astype("i1" if most < 1 << 7 else "i2" if most < 1 << 15 else "i4" if most < 1 << 31 else "i8")


def reference_directions(vectors: DataFrame, scale: int) -> np.ndarray:
    """Farthest-first directions of a bounded sample: the rows of the least hashes."""
    sample = vectors.select("embedding").orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLE).toArrow()
    _, rows = quantised(sample.column(0).combine_chunks(), scale)
    norms = norms_of(rows)
    rows = rows[norms > 0] / norms[norms > 0][:, None]
    if not len(rows):
        return np.zeros((1, 1))
    chosen, nearest = [0], rows @ rows[0]
    while len(chosen) < min(REFERENCES, len(rows)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    return rows[chosen]


def packed_rows(vectors: DataFrame, references: np.ndarray, scale: int) -> DataFrame:
    """Blocks of rows with stored norms and angles. Inside a block, rows next to the same reference
    stand together, nearest first, so that chunks are narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting, n = TaskContext.get().partitionId() << 20, [], 0

        def flush() -> pa.RecordBatch:
            ids, labels = (np.concatenate([w[k] for w in waiting]) for k in (0, 1))
            rows = padded([w[2] for w in waiting])
            norms = norms_of(rows)
            angles = angles_to(references, rows, norms)
            near = angles.argmin(axis=1)
            order = np.lexsort((ids, angles[np.arange(len(near)), near], near))
            rows = narrow(rows[order])
            return record_batch([[block], [len(ids)], [ids[order].tobytes()], [labels[order].tobytes()], [rows.tobytes()],
                                 [rows.dtype.str], [norms[order].tobytes()], [angles[order].tobytes()]], BLOCK)

        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(lo, CHUNK_ROWS)
                keep, rows = quantised(part.column(2), scale)
                if len(keep):
                    ids = np.array(part.column(0).fill_null(NO_ID))[keep]
                    waiting.append((ids, np.array(part.column(1))[keep], rows))
                    n += len(keep)
                    if n >= CELL_ROWS:
                        yield flush()
                        block, waiting, n = block + 1, [], 0
        if waiting:
            yield flush()

    return arrow_map(vectors, run, BLOCK)


def padded(arrays: list[np.ndarray]) -> np.ndarray:
    width = max(a.shape[1] for a in arrays)
    return np.concatenate([np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in arrays])


class Rows:
    """Rows of some blocks: arrays of equal length, one place a row."""

    def __init__(self, blocks: list[dict]):
        self.ids, self.labels = (np.concatenate([np.frombuffer(b[c], "i8") for b in blocks]) for c in ("ids", "labels"))
        self.norms = np.concatenate([np.frombuffer(b["norms"], "f8") for b in blocks])
        self.angles = np.concatenate([np.frombuffer(b["angles"], "f4").reshape(b["n"], -1) for b in blocks])
        #: Unique over the table: block and place.
        self.keys = np.concatenate([np.array([b["block"]]) * CELL_ROWS * 2 + np.arange(b["n"]) for b in blocks])
        self.vectors = padded([np.frombuffer(b["vectors"], b["kind"]).reshape(b["n"], -1) for b in blocks])


# --- bounds and scores -----------------------------------------------------------------

def score_bounds(a_norms, a_angles, norms, angles) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) possible score of each anchor with each row."""
    low = np.zeros((len(a_angles), len(angles)), "f4")
    high = np.full_like(low, np.pi)
    gap, total = np.empty_like(low), np.empty_like(low)
    for r in range(angles.shape[1]):
        t, u = a_angles[:, r, None], angles[None, :, r]
        np.maximum(low, np.abs(np.subtract(t, u, out=gap), out=gap), out=low)
        np.add(t, u, out=total)
        np.minimum(high, np.minimum(total, 2 * np.pi - total, out=gap), out=high)
    return bounded(a_norms, norms, low, high)


def chunk_bounds(a_norms, a_angles, norms, angles) -> tuple[np.ndarray, np.ndarray]:
    """The same for a whole chunk of rows: a column alone."""
    least, most = angles.min(axis=0), angles.max(axis=0)
    low = np.maximum(np.maximum(a_angles - most, least - a_angles), 0).max(axis=1)
    high = np.minimum(a_angles + most, 2 * np.pi - a_angles - least).min(axis=1)
    small = bounded(a_norms, norms.min(keepdims=True), low[:, None], high[:, None])
    large = bounded(a_norms, norms.max(keepdims=True), low[:, None], high[:, None])
    return np.minimum(small[0], large[0])[:, 0], np.maximum(small[1], large[1])[:, 0]


def bounded(a_norms, norms, low, high) -> tuple[np.ndarray, np.ndarray]:
    product = a_norms[:, None] * norms[None, :]
    spare = product * SLACK + 1
    return (product * np.cos(np.minimum(high + SLACK, np.pi)) - spare,
            product * np.cos(np.maximum(low - SLACK, 0)) + spare)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products, a row of ``a`` with a row of ``b``."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    most = int(np.abs(a.astype("i8")).max(initial=0)) * int(np.abs(b.astype("i8")).max(initial=0)) * d
    if most < 1 << 53:  # every partial sum is an integer that a double holds
        return (a.astype("f8") @ b.astype("f8").T).astype("i8")
    if most < MOST:
        return a.astype("i8") @ b.astype("i8").T
    return np.clip(a.astype(object) @ b.astype(object).T, -MOST, MOST).astype("i8")


class Windows:
    """The best ``k`` rows of each slot (an anchor, or an anchor and a positive) whose scores lie in
    the slot's window. ``floor`` is the least score that can still count."""

    def __init__(self, floor: np.ndarray, ceiling: np.ndarray, k: int):
        self.floor, self.ceiling, self.k = floor, ceiling, k
        self.slot, self.score, self.id = (np.empty(0, "i8") for _ in range(3))

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        nth = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = nth < self.k
        self.slot, self.score, self.id = slot[kept], score[order][kept], ids[order][kept]
        last = nth == self.k - 1
        self.floor[slot[last]] = np.maximum(self.floor[slot[last]], score[order][last])


def search(anchors: Rows, rows: Rows, windows: Windows, slots: np.ndarray, same_label: bool) -> int:
    """Fill the windows from the rows; ``slots``: the slots of each anchor, -1 for none. Returns the
    number of pairs that were scored."""
    scored = 0
    for x in range(0, len(rows.ids), CHUNK_ROWS):
        chunk = slice(x, x + CHUNK_ROWS)
        for y in range(0, len(anchors.ids), CHUNK_ANCHORS):
            some = np.arange(y, min(y + CHUNK_ANCHORS, len(anchors.ids)))
            own = slots[some]
            floor = np.where(own >= 0, windows.floor[own], MOST).min(axis=1)
            ceiling = np.where(own >= 0, windows.ceiling[own], -MOST).max(axis=1)
            least, most = chunk_bounds(anchors.norms[some], anchors.angles[some], rows.norms[chunk], rows.angles[chunk])
            open_ = (floor <= ceiling) & (most >= floor) & (least <= ceiling)
            if not open_.any():
                continue
            some, own, floor, ceiling = some[open_], own[open_], floor[open_, None], ceiling[open_, None]
            least, most = score_bounds(anchors.norms[some], anchors.angles[some], rows.norms[chunk], rows.angles[chunk])
            wanted = (most >= floor) & (least <= ceiling)
            wanted &= (anchors.labels[some][:, None] == rows.labels[chunk][None, :]) == same_label
            if same_label:
                wanted &= anchors.keys[some][:, None] != rows.keys[chunk][None, :]
            columns = np.flatnonzero(wanted.any(axis=0))
            if not len(columns):
                continue
            wanted = wanted[:, columns]
            scored += int(wanted.sum())
            found = scores(anchors.vectors[some], rows.vectors[chunk][columns])
            wanted &= (found >= floor) & (found <= ceiling)
            ids = rows.ids[chunk][columns]
            hits = [np.empty((3, 0), "i8")]
            for j in range(own.shape[1]):
                slot = own[:, j]
                inside = wanted & (slot >= 0)[:, None] & (found >= windows.floor[slot][:, None]) & (found <= windows.ceiling[slot][:, None])
                i, c = np.nonzero(inside)
                hits.append(np.stack((slot[i], found[i, c], ids[c])))
            hits = np.concatenate(hits, axis=1)
            if hits.shape[1]:
                windows.offer(*hits)
    return scored


# --- the grid --------------------------------------------------------------------------

POSITIVES = [("positive_ids", "array<bigint>"), ("positive_scores", "array<bigint>")]
MET = [("anchor", "bigint"), ("anchor_id", "bigint"), ("slot", "int"), ("positive_id", "bigint"),
       ("positive_score", "bigint"), ("found_id", "bigint"), ("found_score", "bigint")]


def anchors_of(blocks: DataFrame, every: int) -> DataFrame:
    """One-row blocks of the anchors."""
    fields = [("anchor", "bigint"), *BLOCK]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                rows = Rows([b])
                for i in np.flatnonzero((rows.ids % every == 0) & (rows.ids != NO_ID)):
                    one = [rows.ids, rows.labels, rows.vectors, rows.norms, rows.angles]
                    ids, labels, vector, norms, angles = (x[i:i + 1].tobytes() for x in one)
                    yield record_batch([rows.keys[i:i + 1], [b["block"]], [1], [ids], [labels], [vector],
                                        [b["kind"]], [norms], [angles]], fields)

    return arrow_map(blocks, run, fields)


def in_cells(blocks: DataFrame, anchors: DataFrame, cells: tuple[int, int], k: int,
             shares: tuple[int, int] | None) -> DataFrame:
    """Best rows of each anchor (``shares`` None: of its label) or of each of its positives (of other
    labels, with scores between ``shares`` hundredths of the positive's), cell by cell."""
    across, down = cells
    left = anchors.withColumn("a", F.pmod(F.xxhash64("anchor"), F.lit(across)).cast("int"))
    left = left.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    right = blocks.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(down)).cast("int"))
    right = right.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))

    def meet(mine: pa.Table, others: pa.Table) -> pa.Table:
        if not (mine.num_rows and others.num_rows):
            return pa.table([pa.array([], pa.int64() if kind == "bigint" else pa.int32()) for _, kind in MET], names=[n for n, _ in MET])
        listed = mine.to_pylist()
        a, rows = Rows(listed), Rows(others.to_pylist())
        a.keys = np.array([b["anchor"] for b in listed])
        n = len(listed)
        if shares is None:
            slots, owner = np.arange(n)[:, None], np.arange(n)
            floor, ceiling = np.full(n, -MOST), np.full(n, MOST)
            place, ids, of = [None] * n, [None] * n, [None] * n
        else:
            owner = np.repeat(np.arange(n), [len(b["positive_ids"]) for b in listed])
            of = [s for b in listed for s in b["positive_scores"]]
            ids = [i for b in listed for i in b["positive_ids"]]
            place = [j for b in listed for j in range(len(b["positive_ids"]))]
            floor = np.array([-(-shares[0] * s // 100) for s in of], "i8")
            ceiling = np.array([shares[1] * s // 100 for s in of], "i8")
            slots = np.full((n, max(place, default=0) + 1), -1)
            slots[owner, place] = np.arange(len(of))
        windows = Windows(floor, ceiling, k)
        if len(of):
            search(a, rows, windows, slots, shares is None)
        s = windows.slot
        took = np.array(owner, "i8")[s]
        found = pa.array(windows.id, mask=windows.id == NO_ID)
        return pa.Table.from_batches([record_batch(
            [a.keys[took], a.ids[took], [place[i] for i in s], [ids[i] for i in s], [of[i] for i in s], found, windows.score], MET)])

    return left.groupBy("a", "g").cogroup(right.groupBy("a", "g")).applyInArrow(meet, ddl(MET))


def best(met: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("found_score"), F.asc_nulls_last("found_id"))
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, every: int, positives: int, negatives: int, shares: tuple[int, int], scale: int,
         relabel: tuple[int, int] | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``shares``: hundredths of the positive's score between which a negative's lies. ``relabel``
    (every, labels): where the id is divisible by ``every``, the label becomes the next of so many."""
    label = F.col("label").cast("bigint")
    if relabel:
        label = F.when(F.col("vec_id") % relabel[0] == 0, (label + 1) % relabel[1]).otherwise(label)
    vectors = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), "embedding").where(
        "label IS NOT NULL AND embedding IS NOT NULL")
    blocks = written(packed_rows(vectors, reference_directions(vectors, scale), scale), "hard-negatives-rows")
    anchors = written(anchors_of(blocks, every), "hard-negatives-anchors")
    rows, queries = blocks.agg(F.sum("n")).first()[0] or 0, anchors.count()
    down = -(-rows // CELL_ROWS) or 1
    busy = -(-2 * embeddings.sparkSession.sparkContext.defaultParallelism // down)
    cells = (max(-(-queries // CELL_ANCHORS), min(busy, queries), 1), down)
    near = best(in_cells(blocks, anchors, cells, positives, None), ["anchor"], positives)
    each = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "found_id", "found_score"))).alias("p"))
    asked = anchors.join(each, "anchor").select(*anchors.columns, F.col("p.found_id").alias("positive_ids"),
                                                F.col("p.found_score").alias("positive_scores"))
    asked = written(asked, "hard-negatives-positives")
    dropped(anchors)
    found = best(in_cells(blocks, asked, cells, negatives, shares), ["anchor", "slot"], negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
                        F.col("found_score").alias("negative_score"))
