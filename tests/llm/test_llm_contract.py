import os

import pytest

from strandloom.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    from test_contract import compare

    if name in queries.ORACLE:
        compare(spark, queries.QUERIES[name], queries.ORACLE[name])
    else:
        assert queries.QUERIES[name](spark, DATA).count() > 0
