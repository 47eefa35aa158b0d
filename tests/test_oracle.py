"""Every registered query against its DuckDB oracle SQL on the driver's tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from odometrix.plans.driver_tables import QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tools.check_oracle import compare


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["breakdown_count", "brand_type"]
    assert df.count() > 0


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_queries_match_oracle(spark, sf_dir):
    results = compare(spark, sf_dir, set(QUERIES))
    bad = [r for r in results if not r.ok]
    assert not bad, bad
    assert all(r.rows > 0 for r in results if r.name != "repairs_vs_usage_keep_zero")
