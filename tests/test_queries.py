"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from compare import connect, differences

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_agrees_with_its_sql(spark, connection, name):
    query = entry.queries()[name]
    if name not in ORACLES:
        assert query(spark, SF_DIR).count() > 0
        return
    assert differences(spark, connection, query, ORACLES[name], SF_DIR) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "metodo_enriquecimento" in frame.columns
