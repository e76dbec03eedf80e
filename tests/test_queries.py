"""Every registered query against its DuckDB counterpart on the whole small tables."""

import re

import pytest

import __spark_entry__ as entry_module
import checker
from conftest import SMALL

ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return checker.connect(SMALL)


def test_every_query_has_sql():
    # the training-data operators, where installed, may lack SQL; their own tests hold them
    own = {n for n in entry_module.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(ORACLES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tables, name):
    checker.compare(spark, SMALL, entry_module.queries()[name], ORACLES[name], tables)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["device_id", "count", "avg_hr", "avg_spo2"]
    assert df.count() > 0
