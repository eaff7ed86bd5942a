"""Every registered query matches its DuckDB oracle (rows-only ones just run)."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        ok, msg = compare(df, con, ORACLES[name])
        assert ok, msg
    else:
        assert df.count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["data_center", "job_name", "end_time"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
