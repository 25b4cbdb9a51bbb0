"""Splittable reads of JSON arrays.

Spark reads a multi-line JSON file as a whole, in one task. Here a file is read by as many tasks as
it has splits: Spark's text reader cuts it at every ``}``, on any store and at any block boundary,
and the items are put together again.

A piece between two braces may begin inside a text and at any depth. That state is a prefix over
the file, and prefixes compose: a first pass finds for each split how it changes the state (whether
it flips "inside a text", and how far it moves the depth from either start), a running sum over the
splits of a file gives each its start, and a second pass cuts the items out. Items that cross a
split's end leave as fragments, which meet by the split that they began in.

A file holds one array or several, one behind the other, or objects alone; items are the objects and
arrays inside. Numbers, texts and literals that stand in an array by themselves are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carlot.session import cut_lineage, ship_package

QUOTE, BACKSLASH, OPEN, CLOSE = ord('"'), ord("\\"), b"{[", b"}]"


class Marks(NamedTuple):
    """Of each byte: how it changes the depth (if it stands outside a text), and whether an even number of
    quotes stands before it."""
    change: np.ndarray
    even: np.ndarray
    flips: bool


def marks(data: np.ndarray) -> Marks:
    """Marks of a stretch that doesn't begin behind a backslash."""
    slash = data == BACKSLASH
    places = np.arange(len(data))
    # length of the run of backslashes that ends before each byte
    last = np.maximum.accumulate(np.where(slash, -1, places)) if len(data) else places
    run = np.concatenate(([0], (places - last)[:-1])) if len(data) else places
    quotes = (data == QUOTE) & (run % 2 == 0)
    upto = np.cumsum(quotes)
    change = np.isin(data, np.frombuffer(OPEN, "u1")).astype("i8") - np.isin(data, np.frombuffer(CLOSE, "u1"))
    return Marks(change, (upto - quotes) % 2 == 0, bool(len(upto) and upto[-1] % 2))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    """(file, block) of each split in turn, and its stretches of bytes."""
    def stretches() -> Iterator[tuple[tuple[str, int], bytes]]:
        for batch in batches:
            names, blocks, values = (batch.column(k).to_pylist() for k in range(3))
            at = 0
            for split, rows in groupby(zip(names, blocks, strict=True)):
                n = sum(1 for _ in rows)
                yield split, b"".join(v.encode() + b"}" for v in values[at:at + n])
                at += n

    for split, found in groupby(stretches(), key=lambda x: x[0]):
        yield split, (data for _, data in found)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (name, block), stretches in _pieces(batches):
        moved, flips, first = [0, 0], False, ""
        for data in stretches:
            m = marks(np.frombuffer(data, "u1"))
            outside = m.even ^ flips  # if the split begins outside a text
            moved[0] += int(m.change[outside].sum())
            moved[1] += int(m.change[~outside].sum())
            first = first or next((chr(c) for c in data if chr(c) in "[{"), "")
            flips ^= m.flips
        yield pa.RecordBatch.from_pylist([{"name": name, "block": block, "flips": flips, "outside": moved[0], "inside": moved[1], "first": first}])


class Start(NamedTuple):
    """State at a split's beginning, and the depth at which items begin."""
    inside: bool
    depth: int
    level: int


def split_starts(pieces: DataFrame) -> dict[tuple[str, int], Start]:
    """The state at which each split begins: as many rows as the scan has splits, which the driver plans anyway."""
    found = pieces.mapInArrow(_summaries, "name string, block long, flips boolean, outside long, inside long, first string").collect()
    starts = {}
    for name, splits in groupby(sorted(found, key=lambda r: (r["name"], r["block"])), key=lambda r: r["name"]):
        splits = list(splits)
        level = 0 if next((r["first"] for r in splits if r["first"]), "[") == "{" else 1
        inside, depth = False, 0
        for r in splits:
            starts[name, r["block"]] = Start(inside, depth, level)
            depth += r["inside"] if inside else r["outside"]
            inside ^= r["flips"]
    return starts


def cut_items(stretches: Iterator[bytes], start: Start) -> Iterator[tuple[bool, bool, bytes]]:
    """(begins here, ends here, bytes) of the items in a split that begins at ``start``."""
    inside, depth, level = start
    is_open, waiting, begun = depth > level, [], False
    for data in stretches:
        m = marks(np.frombuffer(data, "u1"))
        change = np.where(m.even ^ inside, m.change, 0)
        after = depth + np.cumsum(change)
        begin = np.flatnonzero((change > 0) & (after == level + 1)).tolist()
        end = (np.flatnonzero((change < 0) & (after == level)) + 1).tolist()
        if is_open:
            begin = [0, *begin]
        for i, x in enumerate(begin):
            if i or not is_open:
                begun, waiting = True, []
            y = end[i] if i < len(end) else None
            waiting.append(data[x:y])
            if y is not None:
                yield begun, True, b"".join(waiting)
                waiting = []
        is_open = len(end) < len(begin)
        inside ^= m.flips
        depth = int(after[-1]) if len(after) else depth
    if is_open:
        yield begun, False, b"".join(waiting)


def array_items(spark: SparkSession, path: str) -> DataFrame:
    """(name, block, nth, item): the text of each item; (block, nth) is its order inside the file."""
    ship_package(spark)
    pieces = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("name"), F.col("_metadata.file_block_start").alias("block"), "value")
    starts = spark.sparkContext.broadcast(split_starts(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, stretches in _pieces(batches):
            rows, size = [], 0
            for nth, (begins, ends, item) in enumerate(cut_items(stretches, starts.value[split])):
                rows.append((*split, nth, begins, ends, item.decode()))
                size += len(item)
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True))), names=NAMES)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True))), names=NAMES)

    found = cut_lineage(pieces.mapInArrow(run, "name string, block long, nth long, begins boolean, ends boolean, item string"))
    whole = found.where("begins AND ends").select("name", "block", "nth", "item")
    # at most two fragments a split; one that doesn't begin belongs to the last that did
    at = Window.partitionBy("name").orderBy("block", "nth")
    began = F.last(F.when(F.col("begins"), F.struct("block", "nth")), ignorenulls=True).over(at)
    parts = found.where("NOT (begins AND ends)").withColumn("began", began).groupBy("name", "began").agg(
        F.array_sort(F.collect_list(F.struct("block", "nth", "item"))).alias("parts"))
    joined = parts.select("name", "began.block", "began.nth", F.array_join(F.col("parts.item"), "").alias("item"))
    return whole.unionByName(joined)


NAMES = ["name", "block", "nth", "begins", "ends", "item"]


def text_fields(items: DataFrame, keep: Sequence[str]) -> DataFrame:
    """A text column for each field that occurs in the items (the names of the fields are collected)."""
    fields = items.withColumn("fields", F.from_json("item", "map<string,string>"))
    names = fields.select(F.explode(F.map_keys("fields")).alias("k")).distinct().collect()
    return fields.select(*keep, *[F.col("fields")[r["k"]].alias(r["k"]) for r in sorted(names)])
