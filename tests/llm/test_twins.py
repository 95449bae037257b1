"""The training-data queries that SQL can express equal their twins."""

from __future__ import annotations

import pytest

from check_oracle import compare, connect
from fleetlens.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_twin(spark, con, name):
    assert compare(spark, con, name, SF) is None
