"""Operator 13: documents packed into as few token sequences as can be.

A document's tokens (and its end id) are one *piece*; only documents longer than a sequence are
cut, into whole sequences and a rest. How many pieces there are of each length is all that a
packing depends on, so it is decided on that histogram: at most ``capacity`` numbers, whatever
the corpus holds. Bin completion takes the largest length left, enumerates the *undominated*
fillings of the room beside it (least waste first, then the largest pieces), applies one as often
as the counts allow, and goes on depth first. A branch ends when its waste, or the lower bound of
what is left, can no longer beat the incumbent, which begins as the best-fit-decreasing packing.
The search ends when the incumbent meets the lower bound (proven optimal), when it has seen
everything, or after ``NODES`` nodes: the incumbent is always a whole packing.

The plan is a list of (filling, copies). Each piece finds its place by its rank among those of its
length: the running count in its input partition plus the counts of earlier partitions. So
tokenising and placing are per-partition work, and the only shuffles are of piece rows without
texts or ids, by (partition, length), of which no key holds more than one partition's pieces.

Edge cases: NULL and empty texts are the end id alone; repeated rows, and rows with NULL or
repeated ids, are documents of their own; ties (equal lengths) go by input order; a text of any
length is cut into as many pieces as it needs; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, combinations, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carlot.llm.bpe import byte_characters, read_spec
from carlot.llm.common import TEXTS_AT_ONCE, arrow_map, id_and_text, record_batch, written

#: Nodes that the search for a better packing visits, and fillings that it tries at each.
NODES, BREADTH = 4_000, 24
#: Longer words leave the cache with the texts that they came with.
CACHED_CHARS = 64

Counts = dict[int, int]
Filling = tuple[int, ...]


# --- tokens ----------------------------------------------------------------------------

#: Letters whose normal form and lower case are one letter each, in any context.
LATIN = "".join(c for c in map(chr, range(0xC0, 0x250))
                if c.isalpha() and len(c.lower()) == 1 and unicodedata.normalize("NFC", c.lower()) == c.lower())
#: Words of these and of printable signs are cut here; the library takes the others whole.
CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN.lower()}]+|[0-9]|[^a-z0-9{LATIN.lower()}]+")


class Words:
    """Ids of whole texts, word by word. The vocabulary drops white space, and no token reaches over
    it, so a text's ids are those of what stands between its spaces and line breaks. New words are
    cut into parts (letters, a digit, other signs), which go to the library's model. Words that its normaliser could change other than by lower case,
    and special tokens, go to the whole library."""

    def __init__(self, spec: str, limit: int = 600_000):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(spec)
        self.model = self.library.model.tokenize
        special = "|".join(re.escape(t["content"]) for t in json.loads(spec)["added_tokens"])
        self.other = re.compile(f"[^ ]*(?:[^ !-~{LATIN}]{'|' * bool(special)}{special})[^ ]*")
        of_byte = byte_characters()
        self.shown = str.maketrans({c: "".join(of_byte[b] for b in c.encode()) for c in LATIN.lower()})
        #: Word or part of one -> ids. A full cache starts anew, but words that are met again come back
        #: from the one before.
        self.limit, self.words, self.before = limit, {"": b""}, {}

    def _part(self, part: str) -> bytes:
        return array("I", [t.id for t in self.model(part if part.isascii() else part.translate(self.shown))]).tobytes()

    def _learn(self, new: set[str]) -> None:
        words = list(new)
        for word in set(self.other.findall(" ".join(words))):
            self.words[word] = array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()
            new.remove(word)
        words = list(new)
        known, of_part = self.words, self._part
        for word, lower in zip(words, " ".join(words).lower().split(" ") if words else ()):
            if lower.isalpha():
                known[word] = known.get(lower) or of_part(lower)
            else:
                ids = []
                for part in CUT.findall(lower):
                    if (found := known.get(part)) is None:
                        found = of_part(part)
                        if len(part) <= CACHED_CHARS:
                            known[part] = found
                    ids.append(found)
                known[word] = b"".join(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.limit:
            self.words, self.before = {"": b""}, self.words
        cuts = [text.replace("\n", " ").split(" ") for text in texts]
        new = set(chain.from_iterable(cuts)).difference(self.words)
        long = [word for word in new if len(word) > CACHED_CHARS]
        before = self.before
        if again := [word for word in new if word in before]:
            self.words.update(zip(again, map(before.__getitem__, again), strict=True))
            new.difference_update(again)
        self._learn(new)
        ids = self.words.__getitem__
        out = [b"".join(map(ids, words)) for words in cuts]
        for word in long:
            del self.words[word]
        return out


_WORDS: dict[tuple, Words] = {}


def words_of(spec: str) -> Words:
    """One a worker process, with its cache."""
    key = len(spec), hash(spec)
    if key not in _WORDS:
        _WORDS[key] = Words(spec)
    return _WORDS[key]


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth): ``nth`` counts the earlier pieces of
    the same length in the input partition ``part``."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(vocabulary))
    texts = id_and_text(docs)
    id_kind = texts.schema["doc_id"].dataType.simpleString()
    fields = [("doc_id", id_kind), ("piece", "int"), ("start", "bigint"), ("length", "bigint"),
              ("ids_crc32", "bigint"), ("part", "bigint"), ("nth", "bigint")]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, seen = words_of(spec.value), TaskContext.get().partitionId(), [0] * (capacity + 1)
        collecting = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and collections would walk through the tokens' objects
        try:
            yield from pieces(batches, words, part, seen)
        finally:
            if collecting:
                gc.enable()

    def pieces(batches: Iterator[pa.RecordBatch], words: Words, part: int, seen: list[int]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, TEXTS_AT_ONCE):
                rows = whole.slice(lo, TEXTS_AT_ONCE)
                of, piece, start, length, crc, nth = [], [], [], [], [], []
                for row, ids in enumerate(words.encode(rows.column(1).to_pylist())):
                    ids = memoryview(ids + end)
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[a:a + 4 * capacity]
                        n = len(cut) // 4
                        of.append(row)
                        piece.append(k)
                        start.append(a // 4)
                        length.append(n)
                        crc.append(zlib.crc32(cut))
                        nth.append(seen[n])
                        seen[n] += 1
                yield record_batch([rows.column(0).take(pa.array(of, pa.int64())), piece, start, length, crc,
                                    [part] * len(of), nth], fields)

    return arrow_map(texts, run, fields)


# --- the packing of a histogram --------------------------------------------------------

def best_fit(counts: Counts, capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit-decreasing: each piece goes to the fullest sequence that has room for it. Equal
    sequences are handled together."""
    room: dict[int, list[list]] = {}  # room left -> [filling, copies]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            tight = min((r for r in room if r >= length), default=None)
            if tight is None:
                filling, copies, tight = (), left, capacity
            else:
                filling, copies = room[tight].pop()
                if not room[tight]:
                    del room[tight]
            fit = tight // length
            full = min(copies, left // fit)
            rest = left - full * fit if full < copies and left - full * fit < fit else 0
            used = full + (rest > 0)
            for n, k in ((full, fit), (int(rest > 0), rest)):
                if n:
                    room.setdefault(tight - k * length, []).append([filling + (length,) * k, n])
            if filling and copies > used:
                room.setdefault(tight, []).append([filling, copies - used])
            left -= full * fit + rest
    return [(filling, n) for groups in room.values() for filling, n in groups]


def lower_bound(counts: Counts, capacity: int) -> int:
    """Sequences that any packing needs: pieces over half a sequence meet only in pairs with small
    ones, so for each threshold what the small ones exceed the room beside the large by."""
    if not counts:
        return 0
    per = np.zeros(capacity + 1, object if sum(counts.values()) * capacity >= 1 << 62 else np.int64)
    for length, n in counts.items():
        per[length] = n
    number, total = np.cumsum(per), np.cumsum(per * np.arange(capacity + 1))
    k = np.arange(0, capacity // 2 + 1)
    half = capacity // 2
    large = number[capacity] - number[half]                     # more than half
    beside = number[capacity - k] - number[half]                # of these, at most capacity - k
    room = beside * capacity - (total[capacity - k] - total[half])
    small = total[half] - np.where(k > 0, total[np.maximum(k - 1, 0)], 0)
    need = np.maximum(small - room, 0)
    return int(max(large + -(-need // capacity)))


def dominated(filling: Filling, counts: Counts, capacity: int) -> bool:
    """Whether one piece left over could stand for some of the filling's pieces (or for nothing)
    that are together no larger: then the other filling is never worse."""
    slack = capacity - sum(filling)
    left = 0
    for length, n in counts.items():
        if n > filling.count(length):
            left |= 1 << length
    window = (1 << (slack + 1)) - 1
    if (left >> 1) & (window >> 1):
        return True
    distinct = set(filling)
    if slack and any((left >> (x + 1)) & (window >> 1) for x in distinct):
        return True
    sizes = range(2, len(filling) + 1) if len(filling) <= 8 else (2,)
    return any((left >> sum(some)) & window for size in sizes for some in set(combinations(filling, size)))


def fillings(counts: Counts, room: int, most: int) -> Iterator[Filling]:
    """Undominated fillings of ``room`` by pieces of ``counts``, least waste first, among equals
    the largest pieces first; ends after ``most`` candidates with a last item None."""
    lengths = sorted(x for x, n in counts.items() if n and x <= room)
    if not lengths:
        yield ()
        return
    usable = {x: counts[x] for x in lengths}
    full = (1 << (room + 1)) - 1
    reach = [1]  # reach[i]: sums of pieces of the i least lengths
    for x in lengths:
        sums, n, step = reach[-1], min(counts[x], room // x), 1
        while n:
            k = min(step, n)
            sums |= (sums << (x * k)) & full
            n -= k
            step *= 2
        reach.append(sums)

    def exact(total: int, i: int, taken: Filling) -> Iterator[Filling]:
        if total == 0:
            yield taken
            return
        while i and lengths[i - 1] > total:
            i -= 1
        while i and reach[i] >> total & 1:
            x = lengths[i - 1]
            for k in range(min(counts[x], total // x), 0, -1):
                if reach[i - 1] >> (total - k * x) & 1:
                    yield from exact(total - k * x, i - 1, taken + (x,) * k)
            i -= 1

    tried, total = 0, reach[-1].bit_length() - 1
    while total > 0:
        for filling in exact(total, len(lengths), ()):
            if tried == most:
                yield None
                return
            tried += 1
            if not dominated(filling, usable, room):
                yield filling
        total = (reach[-1] & ((1 << total) - 1)).bit_length() - 1


class Node:
    """Where the search stands at one depth: a filling of the largest length left, and how many copies
    of it are next. Fillings are enumerated anew on the way back, so that a node stays small."""

    def __init__(self, largest: int, banned: frozenset = frozenset()):
        self.largest, self.banned, self.seen, self.step, self.cut = largest, banned, 0, None, False

    def advance(self, left: Counts, capacity: int, breadth: int, spare_waste: int) -> tuple[Filling, int] | None:
        """The next (filling, copies), most copies first; None behind the last. ``spare_waste``: what
        may still be wasted by a packing that beats the incumbent."""
        if self.step and self.step[1] > 1:
            self.step = self.step[0], self.step[1] - 1
            return self.step
        here = {x: n for x, n in left.items() if n}
        beside = here | {self.largest: here[self.largest] - 1}
        for found in islice(fillings(beside, capacity - self.largest, breadth), self.seen, None):
            if found is None:
                self.cut = True
                return None
            self.seen += 1
            filling = (self.largest, *found)
            if filling not in self.banned:
                copies, waste = min(here[x] // filling.count(x) for x in set(filling)), capacity - sum(filling)
                if waste:
                    copies = min(copies, spare_waste // waste)
                if copies > 0:
                    self.step = filling, copies
                    return self.step
        return None


def bin_completion(counts: Counts, capacity: int, nodes: int = NODES,
                   breadth: int = BREADTH) -> tuple[list[tuple[Filling, int]], bool]:
    """((filling, copies), ...) and whether no packing with fewer sequences exists."""
    counts = {x: n for x, n in counts.items() if n}
    best = best_fit(counts, capacity)
    fewest, least = sum(n for _, n in best), lower_bound(counts, capacity)
    if fewest == least:
        return best, True
    weight = sum(x * n for x, n in counts.items())
    left, plan, used, waste, visited, cut = dict(counts), [], 0, 0, 0, False

    def put(step: tuple[Filling, int], sign: int) -> None:
        nonlocal used, waste
        filling, n = step
        for x in filling:
            left[x] -= sign * n
        used += sign * n
        waste += sign * n * (capacity - sum(filling))

    # behind each frame but the last stands a step of the plan
    stack = [Node(max(left))]
    while stack:
        node = stack[-1]
        if len(plan) == len(stack):
            put(plan.pop(), -1)  # back from below
        step = None
        if visited < nodes and fewest > least:
            step = node.advance(left, capacity, breadth, (fewest - 1) * capacity - weight - waste)
        if step is None:
            cut |= node.cut or visited >= nodes
            stack.pop()
            continue
        visited += 1
        put(step, 1)
        rest = {x: n for x, n in left.items() if n}
        if not rest and used < fewest:
            best, fewest = [*plan, step], used
        if not rest or waste > (fewest - 1) * capacity - weight or used + lower_bound(rest, capacity) >= fewest:
            put(step, -1)
            continue
        plan.append(step)
        deeper = max(rest)
        stack.append(Node(deeper, node.banned | {step[0]} if deeper == node.largest else frozenset()))
    return best, fewest == least or not cut


# --- places ------------------------------------------------------------------------------

class Places:
    """Rank of a piece among those of its length -> (sequence, offset), vectorised."""

    def __init__(self, plan: list[tuple[Filling, int]], counts: Counts):
        base, at = {}, 0
        for length in sorted(counts):
            base[length], at = at, at + counts[length]
        self.base = np.zeros(max(counts, default=0) + 1, "i8")
        for length, first in base.items():
            self.base[length] = first
        used, rows, sequence = dict.fromkeys(counts, 0), [], 0
        for filling, copies in plan:
            offset = 0
            for length in sorted(set(filling), reverse=True):
                times = filling.count(length)
                rows.append((base[length] + used[length], times, sequence, offset))
                used[length] += times * copies
                offset += times * length
            sequence += copies
        assert used == counts
        rows.sort()
        self.first, self.times, self.sequence, self.offset = np.array(rows, "i8").reshape(-1, 4).T

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank = self.base[length] + rank
        i = np.searchsorted(self.first, rank, "right") - 1
        copy, slot = np.divmod(rank - self.first[i], self.times[i])
        return self.sequence[i] + copy, self.offset[i] + slot * length


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(pieces_of(docs, vocabulary, end_id, capacity), "packing-pieces")
    each = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = each.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    plan, _ = bin_completion(counts, capacity)
    places = docs.sparkSession.sparkContext.broadcast(Places(plan, counts))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = pieces.join(starts, ["part", "length"]).select(*kept, (F.col("before") + F.col("nth")).alias("rank"))
    fields = [(c, pieces.schema[c].dataType.simpleString()) for c in kept] + [("sequence_id", "bigint"), ("offset", "bigint")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = places.value.find
        for batch in batches:
            yield record_batch([*batch.columns[:5], *find(batch.column(3).to_numpy(), batch.column(5).to_numpy())], fields)

    return arrow_map(ranked, place, fields)
