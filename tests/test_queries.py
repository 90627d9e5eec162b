import os

import pytest
from oracle import SMALL, compare

from docmill.plans import catalog

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    if name in catalog.SQL:
        compare(spark, catalog.QUERIES[name], catalog.SQL[name])
    else:
        assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_flagship(spark):
    rows = catalog.flagship(spark, SMALL).collect()
    assert rows and sum(r.chunks for r in rows) == sum(r.embeddings for r in rows)


def test_entry_points():
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
