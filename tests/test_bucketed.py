"""Stores in buckets, catalogues built in steps, and small repairs of scans and reports."""

import os

import pytest
from pyspark.sql import functions as F

from carlot.operators.catalog_ops import build_in_steps, complete_steps, read_steps
from carlot.operators.extract import jsonld_items
from carlot.operators.lifecycle import classify_probe
from carlot.operators.store import patch, upsert
from carlot.sources.bucketed import BucketedStore
from carlot.sources.sinks import holds_line_breaks, read_csv, write_csv


def files(path):
    """(place, time of change) of the data files by bucket."""
    out = {}
    for base, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.basename(base), set()).add((n, os.stat(os.path.join(base, n)).st_mtime_ns))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_small_batch_rewrites_what_it_touches(spark, tmp_path):
    store = BucketedStore(str(tmp_path / "s"), "lien_annonce", 20)
    old = spark.range(500).select(F.col("id").cast("string").alias("lien_annonce"), F.col("id").cast("double").alias("prix"))
    store.create(old)
    before = files(store.path)
    assert len(before) == 20 and rows_of(store.read(spark)) == rows_of(old)
    batch = spark.createDataFrame([(1, "7", 1.0), (2, "7", 2.0), (3, "new", 3.0), (4, "8", 8.0)], "o int, lien_annonce string, prix double")
    touched = store.touched(batch)
    assert 1 <= len(touched) <= 3
    want = rows_of(upsert(old, batch, batch_order=["o"]).select("lien_annonce", "prix"))
    counters = store.upsert(batch, ["o"])
    assert {k: v for k, v in counters.items() if k != "kept"} == {"sent": 4, "inserted": 1, "updated": 1, "unchanged": 1}
    after = files(store.path)
    assert {b for b in before if before[b] != after[b]} == {f"bucket={b}" for b in touched}
    assert rows_of(store.read(spark)) == want
    # again: the same table, nothing inserted
    assert store.upsert(batch, ["o"])["inserted"] == 0 and rows_of(store.read(spark)) == want
    updates = spark.createDataFrame([("9", 99.0), ("none", 1.0)], "lien_annonce string, prix double")
    now = spark.createDataFrame(store.read(spark).collect(), old.schema)
    assert store.patch(updates, ["prix"])["updated"] == 1
    assert rows_of(store.read(spark)) == rows_of(patch(now, updates, "lien_annonce", ["prix"]))
    assert store.upsert(batch.limit(0), ["o"]) == {"sent": 0, "inserted": 0, "updated": 0, "unchanged": 0, "kept": 0}
    assert rows_of(store.read(spark)) == rows_of(patch(now, updates, "lien_annonce", ["prix"]))


def test_only_touched_buckets_are_read(spark, tmp_path):
    store = BucketedStore(str(tmp_path / "s"), "k", 16)
    store.create(spark.range(100).select(F.col("id").cast("string").alias("k"), "id"))
    plan = store.part(spark, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:80]
    assert {b for b in store.touched(store.part(spark, [3]))} == {3}


def test_a_broken_build_is_taken_up_again(spark, tmp_path):
    path, schema = str(tmp_path / "catalog"), "model string, make string"
    makes = spark.createDataFrame([(f"make {i}",) for i in range(30)], "make string")
    seen = []

    def build(some, fail_at=None):
        if fail_at is not None and len(seen) == fail_at:
            raise ConnectionError
        names = sorted(r.make for r in some.collect())
        seen.append(names)
        return some.select(F.concat(F.lit("model of "), "make").alias("model"), "make")

    with pytest.raises(ConnectionError):
        build_in_steps(makes, lambda some: build(some, 3), path, schema, steps=6)
    done = [m for names in seen for m in names]
    assert sorted(r.make for r in read_steps(spark, path, schema).collect()) == sorted(done) and 0 < len(done) < 30
    # an unfinished folder isn't read
    makes.select(F.lit("junk").alias("model"), "make").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(
        "make").parquet(path + "/step=x")
    seen.clear()
    assert build_in_steps(makes, build, path, schema, steps=6) == 30 - len(done)
    assert sorted(m for names in seen for m in names) == sorted({f"make {i}" for i in range(30)} - set(done))
    assert rows_of(read_steps(spark, path, schema)) == sorted((f"model of make {i}", f"make {i}") for i in range(30))
    assert build_in_steps(makes, build, path, schema, steps=6) == 0
    assert len(complete_steps(spark, path)) == len(os.listdir(path)) - 1
    assert read_steps(spark, str(tmp_path / "none"), schema).count() == 0


def test_an_http_error_without_a_status_has_a_reason(spark):
    df = spark.createDataFrame([(None, "http"), (404, "http"), (503, None)], "status int, error string")
    c = classify_probe(F.lit("https://a"), F.lit("autoscout24"), F.col("status"), F.lit("https://a"), F.lit(""), F.col("error"))
    assert [tuple(r[0]) for r in df.select(c).collect()] == [(False, "http_inconnu_ambigu"), (True, "http_404"), (False, "http_503_ambigu")]


def test_csv_files_are_cut_where_no_value_has_a_line_break(spark, tmp_path):
    plain = spark.createDataFrame([(i, f"a;b\" {i}", None if i % 3 else "") for i in range(400)], "i int, s string, t string")
    broken = plain.withColumn("s", F.when(F.col("i") == 7, F.lit("a\nb")).otherwise(F.col("s")))
    assert not holds_line_breaks(plain) and holds_line_breaks(broken) and not holds_line_breaks(plain.select("i"))
    write_csv(plain.coalesce(1), str(tmp_path / "p"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        read = read_csv(spark, str(tmp_path / "p"), plain.schema, line_breaks=False)
        assert read.rdd.getNumPartitions() > 2 and rows_of(read) == rows_of(plain)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_long_block_ends_at_its_first_unsound_item(spark):
    import json
    items = [{"name": f"n{i}"} for i in range(3000)]
    rows = [(1, json.dumps(items)), (2, json.dumps([*items[:5], 7, *items])), (3, json.dumps([7, *items])), (4, json.dumps([{}, *items[:2]])),
            (5, json.dumps([*items[:3], {"name": "x", "offers": 3}, *items]))]
    got = jsonld_items(spark.createDataFrame(rows, "i int, block string"), "block", keep=["i"])
    assert {r.i: r.n for r in got.groupBy("i").agg(F.count("*").alias("n")).collect()} == {1: 3000, 2: 5, 4: 2, 5: 3}
    assert [r.titre for r in got.where("i = 1").orderBy("item_pos").limit(2).collect()] == ["n0", "n1"]
