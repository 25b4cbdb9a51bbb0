import random

import numpy as np
import pytest
from helpers import SF, all_docs, edge_docs, empty_docs, inputs

from carlot.llm import decontaminate as dc


def brute_tiles(item, text, shortest):
    """The definition: mark a longest common stretch of unmarked words, as long as there is one."""
    a, b, covered = list(item), list(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and a[i + n] is not None:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < shortest:
            return covered
        a[i:i + n] = [None] * n
        b[j:j + n] = [None] * n
        covered += n


def random_pair(rng):
    words = rng.randint(2, 6)
    if rng.random() < 0.5:
        return ([rng.randrange(words) for _ in range(rng.randint(3, 24))], [rng.randrange(words) for _ in range(rng.randint(0, 36))])
    item = [rng.randrange(words) for _ in range(rng.randint(3, 24))]
    text = []
    for _ in range(rng.randint(1, 6)):  # pieces of the item, overlapping and out of order
        i = rng.randrange(len(item))
        text += item[i:i + rng.randint(1, 12)] + [rng.randrange(words)] * rng.randint(0, 2)
    return item, text


@pytest.mark.parametrize("seed", range(5))
def test_tiles_against_definition(seed):
    rng = random.Random(seed)
    for _ in range(10_000):
        item, text = random_pair(rng)
        found = dc.tiles(np.array(item, "i8"), np.array(text, "i8"))
        for side, words in ((1, item), (2, text)):
            taken = [m[side] + k for m in found for k in range(m[0])]
            assert len(set(taken)) == len(taken) and all(0 <= k < len(words) for k in taken)
        assert all(item[i:i + n] == text[j:j + n] and n >= dc.SHORTEST_TILE for n, i, j in found)
        assert found == sorted(found, key=lambda m: -m[0])
        assert sum(n for n, _, _ in found) == brute_tiles(item, text, dc.SHORTEST_TILE), (item, text)


def test_equal_hashes_by_chance():
    """With a hash that everything shares, the words decide."""
    rng = random.Random(9)
    for _ in range(300):
        item, text = random_pair(rng)
        a, b = dc.Hashed(np.array(item, "i8")), dc.Hashed(np.array(text, "i8"))
        want = dc.matches(a, b, np.zeros(len(item), bool), np.zeros(len(text), bool), 3)
        for h in (a, b):
            h.stretches = lambda length, h=h: np.zeros(max(0, len(h.numbers) - length + 1), "u8")
        got = dc.matches(a, b, np.zeros(len(item), bool), np.zeros(len(text), bool), 3)
        assert sorted(map(tuple, got.tolist())) == sorted(map(tuple, want.tolist()))


def test_repetitive_text_is_fast():
    import time
    benchmark = dc.Benchmark([(1, "word " * 20), (2, "one two three " * 8)])
    began = time.process_time()
    assert benchmark.leaks("word " * 300_000, 0.8) == [(1, 1.0, 1, 20)]
    assert [x[0] for x in benchmark.leaks("one two three x " * 60_000, 0.8)] == [2]
    assert time.process_time() - began < 8


def expected(rows, items):
    """Every pair whose document holds enough of the item's words at all, tiled by the definition."""
    out = []
    items = [(item_id, dc.words_of(item)) for item_id, item in items]
    for doc_id, text in rows:
        words = dc.words_of(text)
        held = set(words)
        for item_id, own in items:
            if own and sum(w in held for w in own) >= 0.8 * len(own):
                # the rest of the text can't be in a tile
                near = {p + k for p, w in enumerate(words) if w in own for k in (-1, 0, 1)}
                covered = brute_tiles(own, [w if p in near else None for p, w in enumerate(words)], min(3, len(own))) / len(own)
                if covered >= 0.8:
                    out.append((doc_id, item_id, round(covered, 6)))
    return sorted(out, key=repr)


def test_documents(spark):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = sorted(((r["doc_id"], r["item_id"], round(r["coverage"], 6)) for r in dc.find_leaks(all_docs(spark), benchmark).collect()), key=repr)
    assert got == expected(inputs(all_docs(spark)), [(r["item_id"], r["text"]) for r in benchmark.collect()])
    assert got


ITEM = "the quick brown fox jumps over the lazy dog while nine more animals watch from afar"


@pytest.mark.parametrize(("text", "leaks"), [
    (f"before {ITEM} after", True),
    ("While nine more animals watch from afar, and then: THE QUICK BROWN FOX jumps over the lazy dog!", True),
    ("the quick brown fox jumps over the lazy cat", False),
    ("watch from afar the lazy dog while", False),
    ("", False), (None, False),
])
def test_reordered_passages(spark, text, leaks):
    docs = edge_docs(spark, [(1, text)])
    benchmark = spark.createDataFrame([(9, ITEM), (9, ITEM), (8, "too short"), (7, None), (None, "")], "item_id bigint, text string")
    assert dc.find_leaks(docs, benchmark).count() == (2 if leaks else 0)
    assert dc.drop_contaminated(docs, benchmark).count() == (0 if leaks else 1)


@pytest.mark.parametrize(("text", "leaks"), [
    # every fifth word replaced: four-word tiles, coverage exactly 0.8
    ("the quick brown fox x over the lazy dog x nine more animals watch x", [(6, 0.8)]),
    # in pieces of four and three words
    ("animals watch from afar x while nine more x jumps over the lazy dog x the quick brown fox x", [(9, 1.0), (6, 1.0)]),
    ("lazy dog while x fox jumps over the x nine more animals watch x the quick brown", [(9, 0.875), (6, 0.933333)]),
    ("lazy dog while x fox jumps over the x nine more animals x the quick brown", [(9, 0.8125), (6, 0.866667)]),
    # two-word pieces are no tiles
    ("watch from x more animals x while nine x lazy dog x over the x fox jumps x quick brown", []),
    ("it is too short for that", [(8, 1.0)]), ("too x short", []), ("short too", []),
    ("one: WORD", [(5, 1.0)]), ("three words here", [(4, 1.0)]), ("three words x here", []),
    ("x four words in a row", [(3, 1.0)]), ("four words in a", []),
])
def test_short_seeds_and_items(text, leaks):
    items = [(9, ITEM), (8, "too short"), (7, None), (6, " ".join(ITEM.split()[:15])), (5, "word"), (4, "three words here"), (3, "words in a row")]
    found = dc.Benchmark([(i, t or "") for i, t in items]).leaks(text, 0.8)
    assert sorted((i, round(c, 6)) for i, c, _, _ in found) == sorted(leaks)


def test_search_is_exact():
    """Against tiling every pair, with no condition on seeds."""
    rng = random.Random(4)
    items = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 16)))) for k in range(60)]
    benchmark, found = dc.Benchmark(items), 0
    for _ in range(60):
        text = " ".join(rng.choice("abcdefghx") for _ in range(rng.randint(0, 30)))
        pieces = rng.choice(items)[1].split()
        cut = rng.randint(0, len(pieces))
        text = " ".join([text, *pieces[cut:], "x", *pieces[:cut]])
        want = []
        for k, item in items:
            own = item.split()
            covered = brute_tiles(own, text.split(), min(len(own), 3)) / len(own) if own else 0
            if covered >= 0.8:
                want.append((k, round(covered, 6)))
        got = [(k, round(c, 6)) for k, c, _, _ in benchmark.leaks(text, 0.8)]
        assert got == want
        found += len(got)
    assert found > 60


def test_rows_are_dropped_by_their_own_text(spark, monkeypatch):
    """Repeated and NULL ids: a leaking row goes, its namesake stays."""
    docs = edge_docs(spark, [(1, f"x {ITEM}"), (1, "clean"), (None, ITEM), (None, "clean too"), (None, None), (2, "watch this word")])
    benchmark = spark.createDataFrame([(9, ITEM), (8, "this word")], "item_id bigint, text string")
    want = [(1, "clean"), (None, None), (None, "clean too")]
    for limit in (dc.BENCHMARK_BYTES, 10):
        monkeypatch.setattr(dc.item_groups, "__defaults__", (limit,))
        out = dc.drop_contaminated(docs, benchmark)
        assert out.schema == docs.schema
        assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_large_benchmark_in_groups(spark, monkeypatch):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, dc.find_leaks(all_docs(spark), benchmark).collect()))
    monkeypatch.setattr(dc.item_groups, "__defaults__", (4000,))
    assert len(dc.item_groups(benchmark)) > 3
    assert sorted(map(tuple, dc.find_leaks(all_docs(spark), benchmark).collect())) == whole


def test_empty_tables(spark):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert dc.find_leaks(empty_docs(spark), benchmark).count() == 0
    assert dc.find_leaks(edge_docs(spark), benchmark.where("item_id < 0")).count() == 0
    assert dc.drop_contaminated(edge_docs(spark), benchmark).columns == edge_docs(spark).columns
