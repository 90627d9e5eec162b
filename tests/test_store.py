"""Loads touch their buckets only, and of two writers one wins."""

import pytest
from pyspark.sql import functions as F

from docmill.errors import ConflictError
from docmill.load import load
from docmill.operators.embedding import DEFAULT_MODEL
from docmill.store import BUCKETED, Store, bucket_of

INCOMING = "doc_path string, filename string, file_size long, last_modified timestamp, chunks_file_path string, chunks array<struct<text:string,contextual_text:string,metadata:string>>, vectors array<array<float>>, embedded_at timestamp"


def documents(spark, names, chunks=2):
    rows = [(n, n + ".md", 1, None, n + "/chunks.json", [(f"{n} {k}", f"{n} {k}", "{}") for k in range(chunks)], [[float(k), 1.0] for k in range(chunks)], None) for n in names]
    return spark.createDataFrame(rows, INCOMING).withColumn("embedded_at", F.lit("2031-01-01").cast("timestamp"))


def test_a_load_writes_its_buckets_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    names = [f"d{n}" for n in range(60)]
    load(store, documents(spark, names), DEFAULT_MODEL)
    before = store.manifest()
    assert all(len(before["tables"][n]) == 16 for n in BUCKETED) and before["max_ids"] == {"documents": 60, "chunks": 120, "embeddings": 120}
    now = F.lit("2032-01-01").cast("timestamp")
    result = load(store, documents(spark, ["d7", "new"]).withColumn("embedded_at", now), DEFAULT_MODEL, now=now, force=True)
    after = store.manifest()
    mine = {str(r.b) for r in spark.createDataFrame([("d7",), ("new",)], "p string").select(bucket_of("p", 16).alias("b")).collect()}
    for name in BUCKETED:
        changed = {b for b in after["tables"][name] if after["tables"][name][b] != before["tables"][name].get(b)}
        assert changed == mine
    assert result.loaded == 2 and result.deltas["documents_added"] == 1 and result.deltas["chunks_added"] == 2
    ids = {r.path: r.id for r in store.table("documents").collect()}
    assert len(ids) == len(set(ids.values())) == 61 and ids["new"] == 61
    chunks = store.table("chunks").collect()
    assert len({c.id for c in chunks}) == len(chunks) == 122 and store.table("embeddings").count() == 122
    # what is deleted is gone with its vectors, in the bucket alone
    assert store.table("embeddings").join(store.table("chunks").select(F.col("id").alias("chunk_id")), "chunk_id", "left_anti").count() == 0


def test_tables_committed_whole_are_divided(spark, tmp_path):
    a, b = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    load(a, documents(spark, ["x", "y", "z"]), DEFAULT_MODEL)
    a.dump(str(tmp_path / "dump"))
    b.restore(str(tmp_path / "dump"))
    assert list(b.manifest()["tables"]["chunks"]) == ["all"]
    load(b, documents(spark, ["w"]), DEFAULT_MODEL)
    assert "all" not in b.manifest()["tables"]["chunks"]
    assert sorted((r.path, r.id) for r in b.table("documents").collect()) == [("w", 4), ("x", 1), ("y", 2), ("z", 3)]
    assert b.table("chunks").count() == b.table("embeddings").count() == 8


def test_two_writers(spark, tmp_path):
    store, other = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "s"))
    load(store, documents(spark, ["a"]), DEFAULT_MODEL)
    commit = store.commit

    def overtaken(*args, **settings):
        load(other, documents(spark, ["b"]), DEFAULT_MODEL)
        return commit(*args, **settings)

    store.commit = overtaken
    with pytest.raises(ConflictError):
        load(store, documents(spark, ["c"]), DEFAULT_MODEL)
    store.commit = commit
    assert sorted(r.path for r in store.table("documents").collect()) == ["a", "b"]
    load(store, documents(spark, ["c"]), DEFAULT_MODEL)
    assert sorted((r.path, r.id) for r in store.table("documents").collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_failures_stay_where_they_are(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    rows = [
        ("good", "good.md", 1, None, "c", [("a", "a", "{}"), ("b", "b", "{}")], [[1.0] * 384, [2.0] * 384], None),
        ("count", "count.md", 1, None, "c", [("a", "a", "{}"), ("b", "b", "{}")], [[1.0] * 384], None),
        ("text", "text.md", 1, None, "c", [("a", "a", "{}"), (None, "b", "{}"), ("c", "c", None)], [[1.0] * 384] * 3, None),
        ("vector", "vector.md", 1, None, "c", [("a", "a", "{}"), ("b", "b", "{}"), ("c", "c", "{}")], [[1.0] * 384, None, [1.0]], None),
    ]
    incoming = spark.createDataFrame(rows, INCOMING).withColumn("embedded_at", F.lit("2031-01-01").cast("timestamp"))
    result = load(store, incoming, DEFAULT_MODEL, strict_dimensions=True)
    assert sorted((r.doc_path, r.chunk_index, r.error) for r in result.errors.where("chunk_index is not null").collect()) == [("text", 1, "a chunk has no text"), ("vector", 1, "a chunk has no vector"), ("vector", 2, "a vector has other dimensions")]
    assert [(r.doc_path, r.error) for r in result.errors.where("chunk_index is null").collect()] == [("count", "chunks and vectors differ: 2 and 1")] and result.loaded == 3
    held = store.table("chunks").join(store.table("documents").select(F.col("id").alias("document_id"), "path"), "document_id").join(store.table("embeddings").select(F.col("chunk_id").alias("id"), F.size("embedding").alias("n")), "id", "left")
    assert sorted((r.path, r.chunk_index, r.n) for r in held.collect()) == [("good", 0, 384), ("good", 1, 384), ("text", 0, 384), ("text", 2, 384), ("vector", 0, 384), ("vector", 1, None), ("vector", 2, None)]
    assert store.table("schema_changes").where("id = 2").first().notes == "Loaded 3 files with model hashing-384 (4 errors)"
