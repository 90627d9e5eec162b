"""Queries run their operator on all columns and tables, not on a stand-in."""

import os

import pytest
from oracle import SMALL

from pyspark.sql import functions as F

from docmill import schemas
from docmill.errors import StoreError
from docmill.plans import catalog, retrieval_queries
from docmill.store import Store

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_dump_roundtrip_covers_every_table(spark, monkeypatch):
    dumped, dump, commit = [], Store.dump, Store.commit
    monkeypatch.setattr(Store, "dump", lambda self, target: dumped.append(dump(self, target)) or dumped[-1])
    assert catalog.QUERIES["dump_roundtrip"](spark, SMALL).count() > 0
    for name, source in (("documents", "documents"), ("chunks", "chunks"), ("embeddings", "chunk_embeddings")):
        assert dumped[0][name] == spark.read.parquet(f"{SMALL}/{source}.parquet").count() > 0

    def restore(self, source):  # loses what the vectors hold
        tables = {n: spark.read.schema(s).parquet(f"{source}/{n}") for n, s in schemas.TABLES.items()}
        commit(self, tables | {"embeddings": tables["embeddings"].withColumn("embedding", F.reverse("embedding"))})

    monkeypatch.setattr(Store, "restore", restore)
    with pytest.raises(StoreError):
        catalog.QUERIES["dump_roundtrip"](spark, SMALL)


def test_upsert_embeddings_carries_vectors(spark, monkeypatch):
    given, upsert = [], retrieval_queries.upsert

    def lossy(target, incoming, **settings):  # the sizes survive, the values do not
        given.append(dict(target.dtypes) | dict(incoming.dtypes))
        out = upsert(target, incoming, **settings)
        return out.withColumn("embedding", F.transform("embedding", lambda x: x + 1)) if "embedding" in out.columns else out

    monkeypatch.setattr(retrieval_queries, "upsert", lossy)
    rows = catalog.QUERIES["upsert_embeddings"](spark, SMALL)
    assert given[0]["embedding"] == "array<float>" and rows.where("n <> 0").isEmpty()
