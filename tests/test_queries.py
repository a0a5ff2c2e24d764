"""Every query against its SQL twin, on the smallest tables."""

import pytest
from check import compare, duck

from catalog import load

ENTRIES = load()
@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, con, folder, name):
    assert compare(spark, con, ENTRIES[name], folder) is None
