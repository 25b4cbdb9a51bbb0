import math
import random

import numpy as np
import pytest
from helpers import SF

from carlot.llm import hard_negatives as hn
from carlot.llm.queries import HARD_NEGATIVES_SQL, op12_hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, anchor int, slot string, rank int, found_id int, n int, a int, g int"


def mined(embeddings, **kw):
    args = {"every": 100, "positives": 5, "negatives": 10, "shares": (30, 90), "scale": 256, "relabel": (7, 10)} | kw
    return hn.mine(embeddings, **args)


def integers(v) -> list[int]:
    return [max(-(1 << 52), min(1 << 52, math.floor(256 * x) if abs(x) < 1e300 else int(math.copysign(1 << 60, x)))) for x in v]


def expected(rows, every=100, positives=5, negatives=10, shares=(30, 90)):
    """Brute force: every anchor with every row, in Python integers."""
    rows = [(i, label, integers(v)) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, math.fmod(label + 1, 10) if i is not None and i % 7 == 0 else label, v) for i, label, v in rows]
    last, out = 1 << 63, []
    for k, (anchor, label, v) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        met = [(-max(-hn.MOST, min(hn.MOST, sum(map(int.__mul__, v, w)))), last if i is None else i, other == label, n)
               for n, (i, other, w) in enumerate(rows) if n != k]
        near = sorted(m[:2] for m in met if m[2])[:positives]
        for positive, p in ((i, -s) for s, i in near):
            fit = sorted((s, i) for s, i, same, _ in met if not same and shares[0] * p <= -100 * s <= shares[1] * p)
            out += [(anchor, positive if positive != last else None, r, i if i != last else None, p, -s)
                    for r, (s, i) in enumerate(fit[:negatives], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *[1] * 7) for r in rows], SCHEMA).repartition(parts)


def clustered(seed, n, dims=6):
    """Vectors of three directions and noise, with whole copies among them."""
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    rows = []
    for i in range(n):
        m = r.choice(middles)
        v = [x + r.gauss(0, 0.3) for x in m] if r.random() < 0.7 else list(m)
        rows.append((i, v, r.randint(0, 3)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rows = clustered(seed, 500)
    assert rows_of(mined(table(spark, rows), every=10)) == expected(rows, every=10)


def test_many_cells(spark, monkeypatch):
    """Several blocks, cells and chunks give the same rows."""
    rows = clustered(3, 400)
    for name, n in {"CELL_ROWS": 90, "CELL_ANCHORS": 4, "CHUNK_ROWS": 16, "CHUNK_ANCHORS": 3}.items():
        monkeypatch.setattr(hn, name, n)
    assert rows_of(mined(table(spark, rows, 4), every=10)) == expected(rows, every=10)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5, -0.25, 1.0]
    rows = [(0, good, 1), (100, [0.0, 0.0, 0.0], 1), (200, [0.5], 1), (300, [], 2), (400, None, 1), (500, good, None),
            (600, [0.5, None, 1.0], 1), (700, [nan, 0.0, 0.0], 1), (800, [inf, 0.0, 0.0], 1), (None, good, 1),
            (None, [0.4, -0.2, 0.8], 2), (900, good, 2), (900, good, 2), (1000, [1e200, 3.0, -4.0], 3),
            (1001, [1e200, -3.0, 4.0], 3), (1002, [-1e200, 1.0, 1.0], 4), (1003, [2e15, 1.0], 4), (1100, [-0.5, 0.25, -1.0], 1)]
    rows += [(k, [0.3, -0.2, 0.7], k % 4) for k in range(1, 60)]
    rows += [(k, [0.45, -0.2, 0.9], 1) for k in range(1, 9)]
    assert rows_of(mined(table(spark, rows))) == expected(rows)
    assert rows_of(mined(table(spark, rows), shares=(-50, 100), positives=2, negatives=3)) == expected(
        rows, shares=(-50, 100), positives=2, negatives=3)


def test_no_anchors_and_no_rows(spark):
    assert rows_of(mined(table(spark, [(1, [1.0], 0), (2, [1.0], 1)]))) == []
    assert rows_of(mined(table(spark, [(100, None, 0)]))) == []
    assert rows_of(mined(table(spark, [(100, [1.0], 0)]).where("vec_id < 0"))) == []


def test_smallest_table(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = rows_of(op12_hard_negatives(spark, SF))
    assert got == expected(rows) and len(got) > 200
    assert "30 * positive_score" in HARD_NEGATIVES_SQL


def packed(rows, references):
    keep, vectors = np.arange(len(rows)), np.array([integers(v) for _, v, _ in rows])
    norms = hn.norms_of(vectors)
    block = {"block": 0, "n": len(rows), "ids": keep.astype("i8").tobytes(), "labels": np.array([r[2] for r in rows], "i8").tobytes(),
             "vectors": vectors.tobytes(), "kind": "<i8", "norms": norms.tobytes(),
             "angles": hn.angles_to(references, vectors, norms).tobytes()}
    return hn.Rows([block])


def directions(rows, n):
    v = np.array([integers(v) for _, v, _ in rows], "f8")
    v = v[hn.norms_of(v) > 0][:n]
    return v / hn.norms_of(v)[:, None]


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e4])
def test_bounds_hold_every_score(scale):
    rows = [(i, [x * scale for x in v], label) for i, v, label in clustered(7, 300)]
    r = packed(rows, directions(rows, 9))
    least, most = hn.score_bounds(r.norms, r.angles, r.norms, r.angles)
    exact = hn.scores(r.vectors, r.vectors)
    assert (least <= exact).all() and (exact <= most).all()
    low, high = hn.chunk_bounds(r.norms, r.angles, r.norms[:40], r.angles[:40])
    assert (low[:, None] <= exact[:, :40]).all() and (exact[:, :40] <= high[:, None]).all()


def test_filter_discards():
    """Most pairs of clustered rows are never scored."""
    rows = clustered(8, 3000)
    r = packed(rows, directions(rows, 16))
    anchors = packed(rows[:20], directions(rows, 16))
    windows = hn.Windows(np.full(20, -hn.MOST), np.full(20, hn.MOST), 5)
    assert hn.search(anchors, r, windows, np.arange(20)[:, None], True) < 20 * sum(x[2] == 0 for x in rows) * 0.9


def test_scores_are_exact():
    big = np.array([[1 << 40, 3], [-(1 << 52), 1 << 52], [1 << 20, -1]], "i8")
    want = [[max(-hn.MOST, min(hn.MOST, int(a[0]) * int(b[0]) + int(a[1]) * int(b[1]))) for b in big] for a in big]
    assert hn.scores(big, big).tolist() == want
