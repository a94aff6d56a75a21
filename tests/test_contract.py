"""Output contracts and the driver entry points."""

from daybook.functions.measures import revenue_output_columns
from daybook.plans.ops_goals import OPS_OUTPUT_COLUMNS


def test_revenue_width():
    cols = revenue_output_columns()
    assert len(cols) == 202 and len(set(cols)) == 202  # + load stamp = 203
    assert cols[:3] == ["CENTER", "PERIOD", "DATES"] and cols[-1] == "EXTRACT_DATE_ID"


def test_ops_width():
    assert len(OPS_OUTPUT_COLUMNS) == 89 and len(set(OPS_OUTPUT_COLUMNS)) == 89  # + load stamp = 90


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == revenue_output_columns()
    assert df.count() > 0


def test_every_job_query_has_oracle():
    import __spark_entry__ as e
    from daybook.catalog import registered
    assert set(registered()) <= set(e.oracle_sql()) <= set(e.queries())
