"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tests.oracle import connect, spark_rows, sql_rows
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    sql_columns, expected = sql_rows(connect(sf_dir), ORACLES[name])
    assert columns == sql_columns
    assert rows == expected
    assert rows


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
