"""Every query with SQL must give the same whole result in both engines."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tests.oracle import compare

SQL = entry.oracle_sql()
QUERIES = entry.queries()
# jobs that fit many models; run by tests/oracle.py instead
SLOW = {"m16_m17_train_then_score", "v01_ablation_of_blocks", "v04_pruning_study", "v08_profiling_report",
        "m04_m05_m07_m08_learner_registry", "m10_random_search", "t07_svd_of_tfidf"}


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, con):
    assert compare(spark, con, SF, name, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(name, spark, con):
    assert compare(spark, con, SF, name, QUERIES[name], None).startswith("rows-only")


def test_entry(spark):
    assert entry.entry(spark).count() == 5
