"""Store, sheet and versioned-table scans and sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from carlot.operators.lifecycle import sheet_prune
from carlot.sources.sinks import latest_version, write_csv, write_version
from carlot.sources.store import count_where, read_sheet_links, read_store


def test_store_scan_projection_and_predicate(spark):
    d = tempfile.mkdtemp(prefix="carlot-store-")
    rows = [(1, "l1", "autoscout24", None), (2, "l2", "aramisauto", "N/A"), (3, "l3", "autoscout24", "Golf 7")]
    df = spark.createDataFrame(rows, "id long, lien_annonce string, source string, generation string")
    v = write_version(df, os.path.join(d, "store"))
    got = read_store(spark, v, ["id", "generation"], F.col("generation").isNull(), limit=10000)
    assert [tuple(r) for r in got.collect()] == [(1, None)]
    assert count_where(read_store(spark, v), F.col("source") == "autoscout24").first().n == 2
    assert latest_version(spark, os.path.join(d, "store")).count() == 3


def test_sheet_scan_and_prune(spark):
    d = tempfile.mkdtemp(prefix="carlot-sheet-")
    sheet = spark.createDataFrame([("https://a/1",), ("https://a/2",), ("notes",), ("https://a/3",)], "lien string")
    write_csv(sheet.coalesce(1), os.path.join(d, "sheet"))
    links = read_sheet_links(spark, os.path.join(d, "sheet"))
    assert links.count() == 4
    probes = spark.createDataFrame([("https://a/1", 404, None, None), ("https://a/2", 200, "ok", None),
                                    ("https://a/3", 200, "Plus disponible", None)],
                                   "lien string, status int, html string, error string").withColumn("probed_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    kept = sorted((r.lien, r.statut) for r in sheet_prune(links, probes).collect())
    assert kept == [("https://a/2", "ACTIF"), ("notes", None)]


def test_scratch_folders_go_when_their_readers_are_written(spark):
    import pytest

    from carlot.session import Scratch, drop_scratch, shared_scratch_dir

    def made(name):
        path = shared_scratch_dir(spark, name)
        spark.range(3).write.parquet(path)
        return path

    there = lambda path: os.path.exists(path.removeprefix("file:"))
    outside = made("outside")
    with Scratch(spark) as s:
        a, b = made("a"), made("b")
        s.keep(b)
    assert (there(outside), there(a), there(b)) == (True, False, True)
    with pytest.raises(RuntimeError), Scratch(spark):
        c = made("c")
        raise RuntimeError
    assert there(c)
    drop_scratch(spark, [b, c, outside])
    assert not there(b) and not there(c) and not there(outside)


def test_a_local_session_without_a_folder_uses_its_warehouse(spark, monkeypatch):
    from carlot import session

    set_to = []

    class Context:
        master = "local[2]"

        def getCheckpointDir(self):
            return set_to[-1] if set_to else None

        def setCheckpointDir(self, path):
            set_to.append(path)

    class Session:
        sparkContext, conf = Context(), {"spark.sql.warehouse.dir": "file:/w/"}

    assert session.checkpoint_root(Session()) == "file:/w/carlot-scratch"
    Session.sparkContext.master = "spark://x"
    set_to.clear()
    import pytest
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
