import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import SMALL, compare  # noqa: E402

from docmill.llm import catalog  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
COLUMNS = {
    "p1_found": {"model": "bigint", "chunk_id_a": "bigint", "chunk_id_b": "bigint"}, "p3_found": {"item_kind": "string", "item_id": "bigint", "run_start": "bigint"}, "p4_found": {"source_id": "bigint", "line_no": "bigint"},
    "p5_found": {"chunk_id_a": "bigint", "chunk_id_b": "bigint"}, "p6_ids": {"doc_id": "bigint", "ids": "array<int>"}, "p8_found": {"doc_id": "bigint", "start_char": "bigint", "end_char": "bigint"},
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    if name in catalog.SQL:
        compare(spark, catalog.QUERIES[name], catalog.SQL[name])
    df = catalog.QUERIES[name](spark, SMALL)
    if name in COLUMNS:
        assert dict(df.dtypes) == COLUMNS[name]
    assert df.count() > 0
