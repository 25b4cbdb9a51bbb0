import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import all_docs, edge_docs, empty_docs, inputs, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from carlot.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def fewest_sequences(items: list[int], capacity: int) -> int:
    """Brute force: every piece into every open sequence."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(i: int, full: list[int]) -> None:
        nonlocal best
        if i == len(items):
            best = min(best, len(full))
        elif len(full) < best:
            for k in range(len(full)):
                if full[k] + items[i] <= capacity and full[k] not in full[:k]:
                    go(i + 1, [*full[:k], full[k] + items[i], *full[k + 1:]])
            go(i + 1, [*full, items[i]])

    go(0, [])
    return best


def whole(plan, counts: dict, capacity: int) -> None:
    placed = Counter()
    for filling, copies in plan:
        assert sum(filling) <= capacity and copies > 0
        for x in filling:
            placed[x] += copies
    assert placed == counts


@pytest.mark.parametrize("seed", range(4))
def test_fewest_by_brute_force(seed):
    r, improved = random.Random(seed), 0
    for _ in range(1500):
        capacity = r.choice([10, 20, 30, 50, 100])
        high = r.choice([capacity, capacity // 2 + 1, 2 * capacity // 3])
        items = [r.randint(r.choice([1, capacity // 5 + 1]), high) for _ in range(r.randint(1, 11))]
        counts = Counter(items)
        plan, proven = packing.bin_completion(counts, capacity, nodes=10**6, breadth=10**6)
        whole(plan, counts, capacity)
        least = fewest_sequences(items, capacity)
        assert proven and sum(n for _, n in plan) == least, (items, capacity)
        first = packing.best_fit(counts, capacity)
        whole(first, counts, capacity)
        assert packing.lower_bound(counts, capacity) <= least <= sum(n for _, n in first)
        improved += least < sum(n for _, n in first)
    assert improved  # best fit alone isn't enough


def test_best_fit_one_by_one():
    """Equal sequences handled together give what placing piece after piece gives."""
    r = random.Random(5)
    for _ in range(300):
        capacity = r.randint(5, 60)
        items = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 60))), reverse=True)
        room = []
        for x in items:
            fits = [k for k, free in enumerate(room) if free >= x]
            if fits:
                room[min(fits, key=room.__getitem__)] -= x
            else:
                room.append(capacity - x)
        got = packing.best_fit(Counter(items), capacity)
        assert sorted(capacity - sum(f) for f, n in got for _ in range(n)) == sorted(room)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 10**15), max_size=12))
def test_large_counts(counts):
    plan, _ = packing.bin_completion(counts, 40, nodes=200)
    whole(plan, counts, 40)
    assert packing.lower_bound(counts, 40) <= sum(n for _, n in plan) <= sum(n for _, n in packing.best_fit(counts, 40))


def test_cut_search_keeps_the_incumbent():
    counts = Counter(random.Random(0).randint(200, 700) for _ in range(300))
    plan, _ = packing.bin_completion(counts, 1000, nodes=3, breadth=1)
    whole(plan, counts, 1000)


def test_places():
    counts = {7: 5, 3: 7, 1: 2}
    plan, _ = packing.bin_completion(counts, 10)
    places = packing.Places(plan, counts)
    taken = Counter()
    for length, n in counts.items():
        for s, o in zip(*places.find(np.full(n, length), np.arange(n)), strict=True):
            taken.update((s, o + k) for k in range(length))
    assert max(taken.values()) == 1 and len(taken) == 5 * 7 + 3 * 7 + 2
    for s in {s for s, _ in taken}:
        assert {o for t, o in taken if t == s} == set(range(sum(t == s for t, _ in taken)))


def expected_pieces(rows, capacity: int):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    for doc_id, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            cut = ids[a:a + capacity]
            yield doc_id, k, a, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())


def check_table(docs, capacity: int):
    got = rows_of(packing.pack(docs, PATH, 0, capacity))
    pieces = sorted(expected_pieces(inputs(docs), capacity), key=repr)
    assert sorted((r[:5] for r in got), key=repr) == pieces
    ends = {}
    for *_, length, _, sequence, offset in sorted(got, key=lambda r: r[5:]):
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
        assert ends[sequence] <= capacity
    counts = Counter(p[3] for p in pieces)
    assert packing.lower_bound(counts, capacity) <= len(ends) <= sum(n for _, n in packing.best_fit(counts, capacity))
    return len(ends), counts


@pytest.mark.parametrize("capacity", [1, 16, 2048])
def test_edge_cases(spark, capacity):
    check_table(edge_docs(spark).repartition(3), capacity)


def test_documents(spark):
    """The fewest sequences that hold the smallest table: best fit needs one more."""
    n, counts = check_table(all_docs(spark), 2048)
    assert n == packing.lower_bound(counts, 2048) < sum(n for _, n in packing.best_fit(counts, 2048))


def test_empty_table(spark):
    out = packing.pack(empty_docs(spark), PATH, 0, 2048)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() == 0


TEXTS = [
    "", " ", "It's we'll\tDON'T  \n\n x", "a<|endoftext|>b <|startoftext|>", " x y\u3000z\u0085w", "e\u0301 \u0301x \u0130 \u0391\u03a3 \u03a3\u0391\u03a3",
    "日本語テキスト 😀😀 ١٢٣ ²½", "x" * 500 + " " + "y" * 70, "\r\n\x0b\x0c\x1c\x1d\x1e\x1f\u180e\u200b\ufeff", "don’t n\u0303\nn\u0303o",
    "ÉÇÀ éÈ, œuvre's ÿŸ'S ǅ ŉ İı ſs ß ẞ ÄÖÜ&&& 12ab3. 'tis'll", "x\ty\rz a\x7fb a\x1fb",
    'Émentvié&&& ouleou,%%% "q"--_[]{}~`', "".join(map(chr, range(0x21, 0x250))), " ".join(map(chr, range(0x21, 0x3000))),
    "x".join(map(chr, range(0xC0, 0x250))), "Xé" * 90, "9" * 80 + "<|endoftext|" + "Ab" * 40]


@pytest.mark.parametrize("limit", [300_000, 3])
def test_words_are_cut_as_the_library_does(limit):
    from tokenizers import Tokenizer
    library, words = Tokenizer.from_file(PATH), packing.Words(open(PATH, encoding="utf-8").read(), limit)
    for texts in (TEXTS, TEXTS[::-1], *([t] for t in TEXTS)):
        for text, ids in zip(texts, words.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:80])
