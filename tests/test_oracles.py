"""Every registered query of the library against its DuckDB oracle on the smallest tables."""

import pytest

from barmill.jobs.registry import ORACLES, QUERIES
from tests.comparison import same


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, name):
    same(spark, QUERIES[name], ORACLES[name])
