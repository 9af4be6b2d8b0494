"""Every registered query against its DuckDB oracle on the smallest test tables (same compare as the driver:
row count, column names, order-insensitive values), plus type families."""

import pytest

import __spark_entry__ as entry
import oracles
from goldleaf.plans.registry import all_queries
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_warehouse_query_has_an_oracle():
    assert set(oracles.oracle_queries()) == set(all_queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert res["ok"], res
    assert not res["type_diff"], res["type_diff"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["month_label", "year", "month", "revenue"]
    assert df.count() > 0


ANSI_OFF = NAMES  # every query, also under the non-ANSI semantics the reference ran with


@pytest.mark.parametrize("name", ANSI_OFF)
def test_matches_oracle_with_ansi_off(spark, con, name):
    """Spark 3.5-style non-ANSI semantics must give the same results (casts, overflow, comparisons)."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert res["ok"], res
