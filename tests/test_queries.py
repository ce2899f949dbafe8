"""Every registered query against its SQL on DuckDB, over the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from check import compare, duck
from tagwright.plans.registry import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(spark, con, name):
    ok, text = compare(spark, con, name, SF_DIR)
    assert ok, text


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(driver.queries())
    assert set(REGISTRY) <= set(driver.oracle_sql())


def test_entry_is_the_label_rows(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["verified_contract_id", "source_code_verified", "is_contract"]
    assert df.count() > 3_000
