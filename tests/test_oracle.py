"""Every registered query against its DuckDB oracle (the driver's check).

Runs at $DAYBOOK_TEST_SF_DIR (default sf0.001, quick); the driver runs sf0.01."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    info = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert info["match"], info


def test_stage_audit_counts_rows(spark, sf_dir):
    df = QUERIES["stage_audit_counts"](spark, sf_dir)
    got = [(r.MESSAGE, r.ROW_COUNT) for r in df.collect()]
    assert [m for m, _ in got] == ["Start of revenue", "spine", "actuals", "plan", "data", "insert",
                                   "Procedure Completed Successfully"]
    counts = dict(got)
    assert counts["spine"] == counts["actuals"] and counts["data"] == counts["insert"] > 0
