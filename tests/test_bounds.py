"""Exactness of what makes the resolution cheap: the containment index and the bound by shared signs."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from carlot.functions.containment import SlugIndex
from carlot.functions.similarity import ratio_bound, sign_mask
from carlot.operators import resolve
from carlot.operators.resolve import Catalog, contained_makes, resolve_makes


def first_hit(slugs, text):
    return next((i for i, s in enumerate(slugs) if s in text or text in s), None)


@pytest.mark.parametrize("seed", range(3))
def test_containment_by_brute_force(seed):
    r = random.Random(seed)
    for _ in range(300):
        slugs = ["".join(r.choices("abc ", k=r.randint(0 if r.random() < 0.05 else 1, 8))) for _ in range(r.randint(0, 12))]
        index = SlugIndex(slugs)
        for _ in range(20):
            text = "".join(r.choices("abc d", k=r.randint(1, 10)))
            assert index.hit(text) == first_hit(slugs, text), (slugs, text)


def test_containment_in_groups_and_long_inputs(spark, monkeypatch):
    slugs = ["alfa romeo", "rover", "land rover", "mg mg motor", "a"]
    by_slug = spark.createDataFrame([(s, i * 10, s.title()) for i, s in enumerate(slugs)], "mslug string, first_pos long, make string")
    texts = ["mg", "q" * 100_000 + " rover", "x" * 5000, "zzz", "romeo", "land"]
    values = spark.createDataFrame([(t,) for t in texts], "slug_in string")
    want = {t: slugs[i].title() for t in texts if (i := first_hit(slugs, t)) is not None}
    for limit in (64 << 20, 300):
        monkeypatch.setattr(resolve, "BROADCAST_MAX_BYTES", limit)
        out = contained_makes(values, by_slug, len(slugs))
        assert {r.slug_in: r.m_contains for r in out.collect()} == want
        assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_no_make_is_exploded(spark):
    cat = Catalog(spark.createDataFrame([(0, "Rover"), (1, "Land Rover")], "make_pos int, make string"),
                  spark.createDataFrame([], "make string, model_pos int, model string"))
    long = "w" * 50_000 + " rover"
    out = resolve_makes(spark.createDataFrame([(long,), ("Roverr",), ("ove",)], "raw_make string"), cat)
    assert {r.raw_make[:4]: (r.make, r.make_stage) for r in out.collect()} == {
        "wwww": ("Rover", "contains"), "Rove": ("Rover", "fuzzy"), "ove": ("Rover", "contains")}


def test_bound_is_above_the_ratio(spark):
    """And shares a good part of the pairs that can't reach a cut-off."""
    r = random.Random(4)
    word = lambda: "".join(r.choices("abcdefgh é", k=r.randint(0, 14)))
    pairs = [(word(), word()) for _ in range(3000)]
    pairs += [(a, "".join(r.sample(a, len(a)))) for a, _ in pairs[:200]] + [("", ""), ("a", ""), ("a" * 200, "a" * 150)]
    pairs += [("".join(map(chr, range(0x4E00, 0x4E00 + n))), "".join(map(chr, range(0x4E10, 0x4E10 + n)))) for n in (5, 100, 300)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    df = df.withColumns({"ma": sign_mask(F.col("a")), "mb": sign_mask(F.col("b"))})
    bounds = {x.i: x.v for x in df.select("i", ratio_bound(F.col("a"), F.col("ma"), F.col("b"), F.col("mb")).alias("v")).collect()}
    low = 0
    for i, (a, b) in enumerate(pairs):
        ratio = SequenceMatcher(None, a, b).ratio() if a or b else 0.0
        assert bounds[i] >= ratio - 1e-9, (a, b)
        low += bounds[i] < 0.6
    assert low > len(pairs) / 3
