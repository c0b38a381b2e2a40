"""The registered queries with SQL, against it."""

import compare
import pytest
from conftest import SF_DIR

from stockloom.llm.oracles import ORACLES
from stockloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF_DIR)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, name):
    good, note = compare.compare(spark, db, SF_DIR, name)
    assert good, note
