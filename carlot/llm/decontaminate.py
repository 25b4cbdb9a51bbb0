"""Operator 4: benchmark decontamination by greedy string tiling.

Texts and benchmark items are lower-cased word sequences, compared by greedy string tiling: search
lengths go down, at each length Karp-Rabin hashes of all unmarked stretches of that length are looked
up, matches are extended, and the longest match of unmarked words is marked as a tile, again and again,
so tiles never overlap. An item
leaks into a document if tiles cover at least ``coverage`` of its words, in whatever order they stand
there; so reordered passages are caught.

The search is exact: every word of a tile stands in a common *seed*, ``SHORTEST_TILE`` words in a
row, so tiles cover no more of an item than its seeds that the document has. Pairs for which those
cover less than ``coverage`` are not tiled. Items shorter than a tile leak if the whole item stands
in the document as it is, as one tile.

Scale: the benchmark meets the documents as a broadcast of at most ``BENCHMARK_BYTES`` of text; a
larger benchmark is worked off in groups of items of that size, one pass over the documents each.
Documents are read where they lie: no shuffle on either side, no pairs but those with common seeds.

Edge cases: NULL and empty texts and items leak nothing; repeated items and rows, and rows with NULL
or repeated ids, are reported each; of equally long matches the first in the item, then in the text,
is marked; empty tables give an empty result; very long texts are hashed and matched in vectorised
passes; other columns are ignored (``drop_contaminated`` keeps them), whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import arrow_map, id_and_text, record_batch
from carlot.session import ship_package

SHORTEST_TILE = 3
COVERAGE = 0.8
BENCHMARK_BYTES = 32 << 20

WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def spread(x: np.ndarray) -> np.ndarray:
    x = (x.astype("u8") + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


class Hashed:
    """Word numbers with prefix sums, from which the Karp-Rabin hash of any stretch follows."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        n = len(numbers)
        up = np.full(n, _BASE, "u8")
        up[:1] = 1
        self.down = np.full(n, _INVERSE, "u8")
        self.down[:1] = 1
        self.down = np.cumprod(self.down)
        self.sums = np.concatenate((np.zeros(1, "u8"), np.cumsum(spread(numbers) * np.cumprod(up))))

    def stretches(self, length: int) -> np.ndarray:
        """Hash of the stretch of ``length`` words from every place."""
        if len(self.numbers) < length:
            return np.empty(0, "u8")
        return (self.sums[length:] - self.sums[:-length]) * self.down[:len(self.numbers) - length + 1]


def unmarked(marked: np.ndarray, length: int) -> np.ndarray:
    """Places from which ``length`` words are all unmarked."""
    if len(marked) < length:
        return np.empty(0, "i8")
    sums = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(sums[length:] == sums[:-length])


def equal_runs(a: np.ndarray, b: np.ndarray, n: int, i: int, j: int, length: int) -> list[tuple[int, int, int]]:
    """The runs of at least ``length`` equal words in one stretch: all of it, unless hashes met by chance."""
    equal = np.concatenate(([0], a[i:i + n] == b[j:j + n], [0]))
    begin, end = np.flatnonzero(np.diff(equal) > 0), np.flatnonzero(np.diff(equal) < 0)
    return [(y - x, i + x, j + x) for x, y in zip(begin.tolist(), end.tolist(), strict=True) if y - x >= length]


def matches(a: Hashed, b: Hashed, marked_a: np.ndarray, marked_b: np.ndarray, length: int) -> np.ndarray:
    """Maximal matches of at least ``length`` unmarked words: columns words, place in a, place in b."""
    at_a, at_b = unmarked(marked_a, length), unmarked(marked_b, length)
    hash_a, hash_b = a.stretches(length)[at_a], b.stretches(length)[at_b]
    order = np.argsort(hash_b, kind="stable")
    hash_b, at_b = hash_b[order], at_b[order]
    left = np.searchsorted(hash_b, hash_a, "left")
    count = np.searchsorted(hash_b, hash_a, "right") - left
    if not count.any():
        return np.empty((0, 3), "i8")
    i = np.repeat(at_a, count)
    j = at_b[np.arange(count.sum()) + np.repeat(left - np.cumsum(count) + count, count)]
    # pairs of equal stretches that follow each other on a diagonal are one match
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1))))
    found = np.stack((np.diff(np.concatenate((first, [len(i)]))) + length - 1, i[first], j[first]), axis=1)
    n = found[:, 0]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    equal = a.numbers[np.repeat(found[:, 1], n) + step] == b.numbers[np.repeat(found[:, 2], n) + step]
    if equal.all():
        return found
    return np.array([run for m in found.tolist() for run in equal_runs(a.numbers, b.numbers, *m, length)], "i8").reshape(-1, 3)


def without(found: np.ndarray, tile: np.ndarray, length: int) -> np.ndarray:
    """What a new tile leaves of the matches, in stretches of at least ``length`` words."""
    for side in (1, 2):
        lo, hi = tile[side], tile[side] + tile[0]
        n, at = found[:, 0], found[:, side]
        hit = (at < hi) & (at + n > lo)
        if hit.any():
            cut = found[hit]
            before, skip = lo - cut[:, side], hi - cut[:, side]
            head, tail = cut.copy(), cut + skip[:, None]
            head[:, 0], tail[:, 0] = before, cut[:, 0] - skip
            found = np.concatenate((found[~hit], head, tail))
            found = found[found[:, 0] >= length]
    return found


def tiles(item: np.ndarray, text: np.ndarray, shortest: int = SHORTEST_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (words, place in item, place in text), longest first, none overlapping.

    Always the longest match of words that are unmarked yet becomes the next tile, the first in the
    item and then in the text among equals; what it leaves of other matches competes by its length."""
    a, b = Hashed(item), Hashed(text)
    marked_a, marked_b = np.zeros(len(item), bool), np.zeros(len(text), bool)
    out, length = [], max(shortest, len(item))
    while True:
        found = matches(a, b, marked_a, marked_b, length)
        while len(found):
            longest = found[found[:, 0] == found[:, 0].max()]
            longest = longest[longest[:, 1] == longest[:, 1].min()]
            tile = longest[longest[:, 2].argmin()]
            n, i, j = tile.tolist()
            marked_a[i:i + n] = marked_b[j:j + n] = True
            out.append((n, i, j))
            found = without(found, tile, length)
        if length == shortest or marked_a.all():
            return out
        length = max(shortest, length // 2)


class Benchmark:
    """Items as numbers of words, and their seeds: all stretches of ``SHORTEST_TILE`` words, or the
    whole item if it is shorter."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        seeds: dict[int, list[np.ndarray]] = {n: [] for n in range(1, SHORTEST_TILE + 1)}
        places: dict[int, list[np.ndarray]] = {n: [] for n in seeds}
        end = 0
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], "i8")
            n = min(len(words), SHORTEST_TILE)
            seeds[n].append(Hashed(numbers).stretches(n))
            places[n].append(end + np.arange(len(seeds[n][-1])))
            end += len(words)
            self.items.append((item_id, numbers))
        self.lengths = np.array([len(numbers) for _, numbers in self.items], "i8")
        #: item of each word of all items, one item behind the other
        self.owner = np.repeat(np.arange(len(self.items)), self.lengths)
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by length: hashes in order, place of each among the words
        for n in seeds:
            if seeds[n]:
                hashes, at = np.concatenate(seeds[n]), np.concatenate(places[n])
                order = np.argsort(hashes, kind="stable")
                self.seeds[n] = hashes[order], at[order]

    def candidates(self, numbers: np.ndarray, coverage: float) -> np.ndarray:
        """Items whose words stand to at least ``coverage`` in seeds that the text has too."""
        # words that no item has are all one number: seeds hold none of them
        foreign = np.concatenate(([0], np.cumsum(numbers < 0)))
        hashed, covered = Hashed(numbers), []
        for n, (seeds, at) in self.seeds.items():
            if len(numbers) < n:
                continue
            places = np.flatnonzero(foreign[n:] == foreign[:-n])
            hashes = np.unique(hashed.stretches(n)[places])
            left, right = np.searchsorted(seeds, hashes, "left"), np.searchsorted(seeds, hashes, "right")
            count = right - left
            # left[0], left[0] + 1, ..., right[0] - 1, left[1], ...
            hits = np.arange(count.sum()) + np.repeat(left - np.cumsum(count) + count, count)
            covered += [at[hits] + k for k in range(n)]
        words = np.unique(np.concatenate(covered)) if covered else np.empty(0, "i8")
        items, known = np.unique(self.owner[words], return_counts=True)
        return items[known / self.lengths[items] >= coverage]

    def leaks(self, text: str, coverage: float) -> list[tuple[int, float, int, int]]:
        """(item_id, share of its words that tiles cover, tiles, longest tile)."""
        get = self.vocabulary.get
        numbers = np.array([get(w, -1) for w in words_of(text)], "i8")
        candidates = self.candidates(numbers, coverage).tolist()
        if not candidates:
            return []
        # foreign words never match: each is its own number
        text_numbers = np.where(numbers < 0, -1 - np.arange(len(numbers)), numbers)
        out = []
        for k in candidates:
            item_id, item = self.items[k]
            found = tiles(item, text_numbers, min(len(item), SHORTEST_TILE))
            covered = sum(n for n, _, _ in found) / len(item)
            if found and covered >= coverage:
                out.append((item_id, covered, len(found), max(n for n, _, _ in found)))
        return out


def item_groups(benchmark: DataFrame, limit: int = BENCHMARK_BYTES) -> list[DataFrame]:
    """The benchmark's items in groups of about ``limit`` bytes of text, by a hash of their id."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-2 * size // limit))  # twice as many as needed, as hashed groups are uneven
    if groups == 1:
        return [items]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))
    return [items.where(part == g) for g in range(groups)]


def shared_items(group: DataFrame):
    """A group's items on all workers: at most ``BENCHMARK_BYTES`` of text."""
    return group.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in group.collect()])


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest_tile) of all leaking pairs."""
    texts = id_and_text(docs)
    id_kind = texts.schema["doc_id"].dataType.simpleString()
    fields = [("doc_id", id_kind), ("item_id", "bigint"), ("coverage", "double"), ("n_tiles", "bigint"), ("longest_tile", "bigint")]
    parts = []
    for group in item_groups(benchmark):

        def run(batches: Iterator[pa.RecordBatch], shared=shared_items(group)) -> Iterator[pa.RecordBatch]:
            items = Benchmark(shared.value)
            for batch in batches:
                rows, found = [], []
                for row, text in enumerate(batch.column(1)):
                    leaks = items.leaks(text.as_py(), coverage)
                    found += leaks
                    rows += [row] * len(leaks)
                if rows:
                    columns = list(map(list, zip(*found, strict=True)))
                    yield record_batch([batch.column(0).take(pa.array(rows, pa.int64())), *columns], fields)

        parts.append(arrow_map(texts, run, fields))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` (all columns) into which no item leaks. Each row is judged by its own text
    where it lies, so ids that are NULL or repeated make no difference."""
    out, place = docs, [c.lower() for c in docs.columns].index("text")
    for group in item_groups(benchmark):

        def run(batches: Iterator[pa.RecordBatch], shared=shared_items(group)) -> Iterator[pa.RecordBatch]:
            items = Benchmark(shared.value)
            for batch in batches:
                texts = batch.column(place).cast(pa.string())
                yield batch.filter(pa.array([not items.leaks(text.as_py() or "", coverage) for text in texts], pa.bool_()))

        ship_package(docs.sparkSession)
        out = out.mapInArrow(run, docs.schema)
    return out
