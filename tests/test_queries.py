"""Every registered query against its SQL twin."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402
from oracle_harness import compare  # noqa: E402

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    rows, _, problem, _ = compare(spark, duck, sf_dir, name, QUERIES[name], ORACLES.get(name))
    assert problem is None, problem
    assert rows > 0


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns[:1] == ["cohort_date"]
    assert df.limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
