"""Dump ingest: title → (brand, model) with the fixed brand tables, field roles, K13."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from carlot.operators.ingest import (best_roles, brand_model_from_title, brand_tables, detect_roles,
                                     field_role_scores, import_dump, read_dumps)

TITLES = [("Vends Clio 4", "Renault", "Clio"), ("Range Rover Sport", "Land Rover", "Sport"),
          ("DS3 chic", "DS", "3"), ("Minibus", "Mini", "bus"), ("Tracteur X", None, "Tracteur"),
          ("Mercedes-Benz Classe A", "Mercedes", "Classe"), ("  belle 308 GT line", "Peugeot", "308"),
          ("CitroÃ«n C3", "Citroën", "C3"), ("", None, None)]


def test_brand_from_title_vectors(spark):
    b, w = brand_tables(spark)
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(TITLES)], "i int, t string")
    got = {r.i: (r.marque, r.modele) for r in brand_model_from_title(df, "t", b, w).collect()}
    assert [got[i] for i in range(len(TITLES))] == [(m, md) for _, m, md in TITLES]


ITEMS = [
    {"text-body-1": "Vends Clio 4", "text-body-2a": "2019", "text-body-2b": "45 000 km", "text-body-2c": "Diesel",
     "text-callout": "12 500 €", "absolute href": "https://d.example/1", "absolute src": "i1"},
    {"text-body-1": "Peugeot 208", "text-body-2a": "2021", "text-body-2b": "10 km", "text-body-2c": "Essence",
     "text-callout": "", "text-success": "18 990 €", "absolute href": "https://d.example/2", "absolute src": "i2"},
    {"text-body-1": "Tracteur X", "text-body-2a": "2015", "text-body-2b": "1 km", "text-body-2c": "Diesel",
     "text-callout": "5 000 €", "absolute href": "https://d.example/3"},
    {"text-body-1": "Golf 7", "text-body-2a": "2016", "text-body-2b": "0 km", "text-body-2c": "Diesel",
     "text-callout": "9 000 €", "absolute href": "https://d.example/4"},
    {"text-body-1": "Golf 8", "text-body-2a": "", "text-body-2b": "20 000 km", "text-callout": "20 000 €",
     "absolute href": "https://d.example/5"},
    {"text-body-1": "Polo", "text-body-2a": "2018", "text-body-2b": "30 000 km", "text-callout": "8 000 €",
     "absolute href": "https://d.example/1"},
]


def test_import_dump(spark):
    d = tempfile.mkdtemp(prefix="carlot-dump-")
    path = os.path.join(d, "a.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(ITEMS, f, ensure_ascii=False)
    items = read_dumps(spark, [path])
    assert detect_roles(items) == {"annee": "text-body-2a", "km": "text-body-2b", "carburant": "text-body-2c"}
    store = spark.createDataFrame([("https://d.example/2", "old")], "lien_annonce string, titre string")
    b, w = brand_tables(spark)
    new_store, inserted = import_dump(store, items, b, w, seen_at=F.lit("2024-01-31").cast("timestamp_ntz"))
    rows = sorted((r.lien_annonce, r.marque, r.modele, r.prix, r.kilometrage, r.date_voiture, r.carburant)
                  for r in inserted.collect())
    # item 3 has no brand, item 4 a 0 km mileage, item 5 no year, item 6 repeats link 1, item 2 is stored
    assert rows == [("https://d.example/1", "Renault", "Clio", 12500, 45000, "2019", "Diesel")]
    assert new_store.count() == 2


def test_files_keep_the_order_in_which_they_are_given(spark, tmp_path):
    item = dict(ITEMS[0])
    for name, title in (("z", "Vends Clio 4"), ("a", "Vends Megane")):
        (tmp_path / f"{name}.json").write_text(json.dumps([item | {"text-body-1": title}]), encoding="utf-8")
    b, w = brand_tables(spark)
    store = spark.createDataFrame([], "lien_annonce string, titre string")
    items = read_dumps(spark, [str(tmp_path / "z.json"), str(tmp_path / "a.json")])
    _, inserted = import_dump(store, items, b, w)
    assert [r.modele for r in inserted.collect()] == ["Clio"]


def test_role_detection_aborts(spark):
    df = spark.createDataFrame([("abc", "x")], "`text-body-2a` string, `text-body-2b` string")
    with pytest.raises(ValueError):
        detect_roles(df)
    picks = {r.role: r.field for r in best_roles(field_role_scores(df)).collect()}
    assert picks == {}
