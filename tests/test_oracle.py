"""Every registered query equals its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from check_oracle import compare, connect
from fleetlens.oracle import ORACLES
from fleetlens.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["sea_area", "grid_x", "grid_y", "density"]
    assert result.count() > 0
