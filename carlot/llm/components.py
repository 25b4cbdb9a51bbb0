"""Connected components of a distributed edge list (alternating large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import dropped, written


def attached(rows: DataFrame, values: DataFrame, key: str, spread_by: str | Column) -> DataFrame:
    """``rows`` with the columns of ``values`` (one row a key), joined on ``key`` though any key may
    hold a third of all rows: each key's rows are cut into chunks by the hash of ``spread_by``, the
    values go to the chunks that there are, and rows meet them by (key, chunk). No task needs all rows
    of a key."""
    chunks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.withColumn("chunk__", F.pmod(F.xxhash64(spread_by), F.lit(chunks)))
    there = cut.select(key, "chunk__").distinct().join(values, key)
    return cut.join(there, [key, "chunk__"]).drop("chunk__")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of the edges (columns ``u`` and ``v``, longs).

    ``component`` is the least node reachable. Each round links neighbours to the least one
    (first the larger neighbours of every node, then the smaller ones), which keeps the
    components and shrinks the graph to stars in a logarithmic number of rounds. A round is
    two aggregations with map-side minimum and two joins; a node with many neighbours (the centre
    of a star) meets its minimum in chunks of them. Its result is written to the shared folder, and
    the one before is deleted."""
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))  # among u and its neighbours
        large = attached(both, least, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), name)
        dropped(edges)
        # small star: every node's smaller neighbours and the node itself go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = attached(large, least, "u", "v").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = written(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), name)
        dropped(large)
        # stars: no node with two smaller neighbours, and no node that is both a leaf and a centre
        forked = small.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        if forked.isEmpty() and small.select("v").distinct().join(small.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return small.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        edges = small
