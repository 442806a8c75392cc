"""Every registered query against its SQL, on the smallest test tables.

``python -m tests.oracle --sf 0.01`` runs the same comparison on larger ones.
"""

import os

import pytest

from tests.oracle import ROOT, compare, connect
from tradeloom.catalog import REGISTRY

FOLDER = str(ROOT / f"sf{os.environ.get('CHECK_SF', '0.001')}")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    difference, _, _, _ = compare(spark, con, name, FOLDER)
    assert difference is None
