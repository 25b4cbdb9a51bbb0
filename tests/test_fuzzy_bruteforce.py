"""The similarity ratio: hand-derived vectors, the length bound, and the SQL of the oracle."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from carlot.functions.similarity import compatible_lengths, ratio, ratio_py
from carlot.operators.resolve import resolve_makes, resolve_models
from carlot.plans.resolve_queries import sql_ratio
from carlot.sources.catalog import catalog_from_dict

VECTORS = [("abcd", "bcde", 0.75), ("abc", "abc", 1.0), ("abc", "xyz", 0.0), ("golf", "gol", 6 / 7),
           ("ab cd", "cd ab", 0.4), ("tide", "diet", 0.25), ("diet", "tide", 0.5)]


@pytest.mark.parametrize(("a", "b", "expected"), VECTORS)
def test_vectors(spark, a, b, expected):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(ratio("a", "b")).first()[0]
    assert got == pytest.approx(expected)


def test_sql_of_the_oracle():
    rng = random.Random(4)
    text = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 14)))
    pairs = sorted({(text(), text()) for _ in range(400)})
    con = duckdb.connect()
    con.execute("CREATE TABLE p (a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?)", pairs)
    got = con.execute(f"WITH RECURSIVE {sql_ratio('r', 'SELECT a, b FROM p')} SELECT a, b, ratio FROM r").fetchall()
    assert len(got) == len(pairs)
    assert all(x == pytest.approx(ratio_py(a, b)) for a, b, x in got)


@pytest.mark.parametrize("cutoff", [0.6, 0.8])
def test_no_length_that_reaches_the_cutoff_is_left_out(spark, cutoff):
    rows = spark.range(1, 40).select("id", compatible_lengths(F.col("id").cast("int"), cutoff, range(1, 200)).alias("m")).collect()
    for r in rows:
        assert set(r["m"]) == {m for m in range(1, 200) if 2 * min(r["id"], m) / (r["id"] + m) >= cutoff}


def test_stage_order(spark):
    """Exact before similar before contained; short and numeric names are never similar."""
    cat = catalog_from_dict(spark, {"Renault": ["Clio", "Megane", "Grand Scenic"], "Peugeot": ["208", "2008"]})
    makes = {r["raw_make"]: (r["make"], r["make_stage"]) for r in resolve_makes(
        spark.createDataFrame([("renault",), ("Renaut",), ("Peugeot France SA",), ("Zzz",)], "raw_make string"), cat).collect()}
    assert makes == {"renault": ("Renault", "exact"), "Renaut": ("Renault", "fuzzy"),
                     "Peugeot France SA": ("Peugeot", "contains"), "Zzz": ("Zzz", None)}
    pairs = [("Renault", "MEGANE"), ("Renault", "Meganne"), ("Renault", "Scenic"), ("Peugeot", "207"), ("Peugeot", "208 gti line")]
    models = {r["raw_model"]: (r["model"], r["model_stage"]) for r in resolve_models(
        spark.createDataFrame(pairs, "raw_make string, raw_model string"), cat).collect()}
    assert models == {"MEGANE": ("Megane", "exact"), "Meganne": ("Megane", "fuzzy"), "Scenic": ("Grand Scenic", "fuzzy"),
                      "207": ("207", None), "208 gti line": ("208", "contains")}
