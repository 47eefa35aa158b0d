"""The queries that SQL can express, against DuckDB on the driver's tables."""

from odometrix.llm.registry import ORACLE_SQL
from tests.conftest import SF_ORACLE
from tools.check_oracle import compare


def test_queries_match_oracle(spark):
    results = compare(spark, SF_ORACLE, set(ORACLE_SQL))
    assert len(results) == len(ORACLE_SQL) and all(r.ok and r.rows > 0 for r in results), results
