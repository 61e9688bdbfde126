"""Oracle tests of the iterative estimators: after all others, so that none hides behind them."""

import pytest

from test_entry import ITERATIVE, check, duck  # noqa: F401 - the fixture


@pytest.mark.parametrize("name", ITERATIVE)
def test_iterative_query_matches_oracle_sf0001(spark, duck, name):  # noqa: F811
    check(spark, duck, name)
