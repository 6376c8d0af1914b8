"""Every registered query against its DuckDB oracle at sf0.001 (exact values)."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["category_name", "mean_co2_emission_g", "total_co2_emission_g", "transactions"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    import __spark_entry__ as entry
    from ledgerstar.checks.oracle import ORACLE_SQL
    from ledgerstar.checks.queries import QUERIES

    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(__import__("ledgerstar.checks.queries", fromlist=["QUERIES"]).QUERIES))
def test_query_matches_oracle(spark, name):
    from oracle_check import compare

    assert compare(spark, SF001, [name])[name] == ("OK",)
