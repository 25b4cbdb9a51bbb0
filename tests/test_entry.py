"""Driver contract: entry() and every registered query run on the smallest tables."""

import pytest

import __spark_entry__ as E


def test_entry(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"make_resolved", "modele_unifie", "generation", "n"}
    assert df.count() > 0


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    df.write.format("noop").mode("overwrite").save()
