"""Splittable reads of JSON arrays and row numbers by file order."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carlot.operators.ingest import read_dumps
from carlot.sources.json_arrays import Start, array_items, cut_items, marks
from carlot.sources.store import read_saved_listings, read_sheet_links, with_row_numbers


def naive_marks(data: bytes):
    inside, escaped, change, even = False, False, [], []
    for c in data:
        even.append(not inside)
        change.append((c in b"{[") - (c in b"}]"))
        if escaped:
            escaped = False
        elif c == 92:
            escaped = True
        elif c == 34:
            inside = not inside
    return change, even, inside


def test_marks():
    r = random.Random(1)
    for _ in range(2000):
        data = "".join(r.choices('{}[]"\\\\ax', k=r.randint(0, 30))).encode()
        m = marks(np.frombuffer(data, "u1"))
        assert (m.change.tolist(), m.even.tolist(), m.flips) == naive_marks(data), data


ODD = ['}', '},{"', '{"a":1}', '\\', '\\\\"', '"', '[', ']', 'é€😀', '', ' ', '\n', '},{"b":', 'x' * 40, ' ', '}}]', ',', ':']


def random_item(r, depth=0):
    value = lambda: r.choice([r.choice(ODD), "".join(r.choices(ODD, k=3)), r.randint(0, 99), None, True, 1.5])
    out = {"".join(r.choices(["k", "a", "}", '"', "{", "é"], k=2)) + str(k): value() for k in range(r.randint(0, 4))}
    if depth < 2 and r.random() < 0.5:
        out["n"] = r.choice([random_item(r, depth + 1), [random_item(r, depth + 1) for _ in range(r.randint(0, 3))], [["}"], []]])
    return out


@pytest.fixture
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def in_order(df):
    return [json.loads(r["item"]) for r in df.orderBy("name", "block", "nth").collect()]


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_is_read_by_several_tasks(spark, small_splits, tmp_path, indent):
    r = random.Random(3)
    items = [random_item(r) for _ in range(150)]
    path = str(tmp_path / "a.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(items, f, ensure_ascii=False, indent=indent)
    found = array_items(spark, path)
    assert in_order(found) == items
    blocks = {r["block"] for r in found.select("block").distinct().collect()}
    assert len(blocks) > 5 and os.path.getsize(path) > 5 * 700


def test_items_longer_than_a_split_and_other_shapes(spark, small_splits, tmp_path):
    long = {"t": "},{" * 1500, "u": [{"v": "\\" * 900}]}
    shapes = {
        "long": (json.dumps([{"a": 1}, long, {"b": 2}]), [{"a": 1}, long, {"b": 2}]),
        "empty": ("", []), "none": ("[]", []), "blank": (" \n ", []), "scalars": ('[1, "x", null, {"a": 1}, [2, 3], {}]', [{"a": 1}, [2, 3], {}]),
        "several": ('[{"a": 1}]\n[{"b": 2}, {"c": 3}]\n', [{"a": 1}, {"b": 2}, {"c": 3}]),
        "objects": ('{"a": [1, {"x": 2}]}\n{"b": "}"}\n', [{"a": [1, {"x": 2}]}, {"b": "}"}]),
        "one": ('{"a": {"b": 1}}', [{"a": {"b": 1}}]), "last": ('[{"a": "é"}]\n\n', [{"a": "é"}]),
    }
    for name, (text, want) in shapes.items():
        path = str(tmp_path / f"{name}.json")
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        assert in_order(array_items(spark, path)) == want, name


def test_cuts_at_every_start():
    """A split may begin anywhere behind a brace."""
    text = json.dumps([{"a": "x},{y", "b": [1, {"c": "\\\\"}]}, {"d": "}"}, {}]).encode() + b"}"
    whole = [b for _, _, b in cut_items(iter([text]), Start(False, 0, 1))]
    for cut in [i + 1 for i, c in enumerate(text) if c == 125]:
        change, even, _ = naive_marks(text[:cut])
        depth = sum(c for c, e in zip(change, even, strict=True) if e)
        inside = naive_marks(text[:cut])[2]
        first = list(cut_items(iter([text[:cut]]), Start(False, 0, 1)))
        rest = list(cut_items(iter([text[cut:]]), Start(inside, depth, 1)))
        joined = []
        for begins, _, item in first + rest:
            joined = joined + [item] if begins else [*joined[:-1], joined[-1] + item]
        assert joined == whole


def test_dumps_of_many_splits_keep_their_order(spark, small_splits, tmp_path):
    for name, lo in (("z", 0), ("a", 100)):
        with open(tmp_path / f"{name}.json", "w", encoding="utf-8") as f:
            json.dump([{"k": i, f"only-{name}": "é}", "n": {"x": [i]}} for i in range(lo, lo + 90)], f, ensure_ascii=False)
    items = read_dumps(spark, [str(tmp_path / "z.json"), str(tmp_path / "a.json")])
    rows = items.orderBy("_file", "_pos").collect()
    assert [r["k"] for r in rows] == [str(i) for i in [*range(90), *range(100, 190)]]
    assert rows[0]["only-z"] == "é}" and rows[0]["only-a"] is None and rows[0]["n"] == '{"x":[0]}'


def test_saved_listings_keep_their_types(spark, small_splits, tmp_path):
    with open(tmp_path / "s.json", "w", encoding="utf-8") as f:
        json.dump([{"titre": "a\nb", "prix": 1.5, "n": i} for i in range(60)], f, indent=4)
    out = read_saved_listings(spark, str(tmp_path / "s.json"), "s")
    assert dict(out.dtypes) == {"n": "bigint", "prix": "double", "titre": "string", "source": "string"}
    assert sorted(r.n for r in out.collect()) == list(range(60)) and out.first().titre == "a\nb"


def test_row_numbers_follow_files_and_rows(spark, small_splits, tmp_path):
    """Several files of several splits: Spark deals the largest first, the numbers follow names and places."""
    folder = tmp_path / "sheet"
    os.makedirs(folder)
    want = []
    for k, n in enumerate([30, 400, 1, 0, 150]):
        links = [f"https://s/{k}/{i}" for i in range(n)]
        (folder / f"part-{k}.csv").write_text("\n".join(["lien,x", *(f"{link},1" for link in links)]) + "\n", encoding="utf-8")
        want += links
    links = read_sheet_links(spark, str(folder))
    got = sorted((r.row_id, r.lien) for r in links.collect())
    assert got == list(enumerate(want))
    assert links.columns == ["lien", "row_id"]
    half = with_row_numbers(spark.read.option("header", True).csv(str(folder)).where(F.col("lien").endswith("5")), ["lien"])
    assert [r.lien for r in half.orderBy("row_id").collect()] == [x for x in want if x.endswith("5")]
