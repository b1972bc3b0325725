"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import pytest

from tests.conftest import SMALL


def test_all_registered_queries_match_oracle(spark):
    from tools.compare_oracle import compare
    res = compare(spark, SMALL)
    bad = {k: v for k, v in res.items() if v.get("status") not in ("match", "rows-only")}
    assert not bad, bad
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["date", "payment_type", "daily_revenue", "trip_count", "rank"]
    assert df.count() > 0


def test_sample_is_exact_size(spark):
    import __spark_entry__ as E
    row = E.queries()["t5_sample_exact"](spark, SMALL).first()
    assert tuple(row) == (1500, 1500, 1500)  # sf0.001 orders has 1,500 rows < 3,000
