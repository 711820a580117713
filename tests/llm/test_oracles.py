import pytest

from shelfmark.llm.oracles import ORACLES
from shelfmark.llm.queries import QUERIES
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, QUERIES[name], ORACLES[name], "/root/testdata/sf0.01") == []
