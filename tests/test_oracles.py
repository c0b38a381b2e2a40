"""Every registered query against its oracle, on the smallest driver data."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import compare

import __spark_entry__ as contract
from stockloom.plans.catalogue import QUERIES
from stockloom.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql()) and set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, db, name):
    good, note = compare.compare(spark, db, SF_DIR, name)
    assert good, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0
