"""Plan shapes the design relies on (checked on the physical plan text)."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_resolution_has_no_nested_loop_or_cartesian(spark):
    for name in ("model_resolve_fuzzy", "make_resolve", "brand_from_title"):
        p = plan(spark, name)
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name
        assert "BroadcastHashJoin" in p, name


def test_gate_report_limits_per_group_before_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "gate_report")


def test_stale_batch_is_a_top_n(spark):
    assert "TakeOrderedAndProject" in plan(spark, "stale_topn")


def test_dedup_aggregates_partially_before_the_shuffle(spark):
    p = plan(spark, "dedup_first")
    head = p.split("\n\n")[0]
    # final aggregate above the exchange, partial aggregate below it
    assert head.count("Aggregate") >= 2 and "Exchange" in head


def test_scan_reads_only_needed_columns(spark):
    p = plan(spark, "stale_topn")
    schemas = [l for l in p.splitlines() if l.strip().startswith("ReadSchema")]
    assert schemas
    # events.props and events.value are not needed for the stale batch: pruned at the scan
    assert all("props" not in s and "value" not in s for s in schemas), schemas


def test_titles_are_looked_up_without_an_exchange(spark):
    import re

    from pyspark.sql import functions as F

    from carlot.operators.ingest import brand_model_from_title, brand_tables
    brands, words = brand_tables(spark)
    titles = spark.range(100).select(F.concat(F.lit("Vends Clio "), F.col("id").cast("string")).alias("t"))
    df = brand_model_from_title(titles, "t", brands, words)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert not re.search(r"(?<!Broadcast)Exchange", text.replace("BroadcastExchange", "Broadcast"))


def test_generation_lookup_reads_orders_for_the_rows_only(spark):
    assert plan(spark, "generation_lookup").count("orders.parquet]") <= 2


def test_model_less_rows_skip_the_join_back(spark):
    from carlot.operators.resolve import resolve_listings
    from carlot.plans.resolve_queries import part_catalog
    rows = spark.createDataFrame([(1, None, None), (2, "x", ""), (3, "ECONOMY", None)], "id int, marque string, modele string")
    out = resolve_listings(rows, part_catalog(spark, SF)).select("id", "modele_unifie", "stage").orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, None, None), (2, "", None), (3, None, None)]
