"""Driver contract: entry smoke, and every query against its DuckDB twin."""

import pytest

import __spark_entry__ as se
from oracle_check import compare

from conftest import SF_CHECK, SF_SMALL


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "tag", "n", "rank"]


def test_every_query_has_an_oracle():
    assert set(se.queries()) - set(se.LLM_QUERIES) == set(se.oracle_sql()) - set(se.LLM_ORACLE)


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_matches_oracle(spark, name):
    """At sf0.01; the corpus queries, which have tests of their own, at sf0.001."""
    sf_dir = SF_SMALL if name in se.LLM_QUERIES else SF_CHECK
    res = compare(spark, name, se.queries()[name], se.oracle_sql().get(name), sf_dir)
    assert res["status"] in ("match", "rows-only"), res
