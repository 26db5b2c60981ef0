"""Each operator's SQL gives the query's rows."""

import pytest

from tests.compare import assert_same
from tests.conftest import SF_SMALL

from quire.llm.oracles import ORACLES
from quire.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_SMALL).toPandas(), duck(SF_SMALL).sql(ORACLES[name]).df(), name)
