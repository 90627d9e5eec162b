import numpy as np
from pyspark.sql import functions as F

from docmill import schemas
from docmill.functions import textsearch as ts
from docmill.functions import vectors as vx
from docmill.operators import index as ix
from docmill.store import Store


def filled(spark, tmp_path, n=4000, dim=24):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(40, dim))
    x = (centre[rng.integers(40, size=n)] + 0.5 * rng.normal(size=(n, dim))).astype(np.float32)
    store = Store(spark, str(tmp_path / "s"))
    store.initialize()
    words = ["turbine", "battery", "checksum", "ledger", "portal"]
    text = [" ".join(rng.choice(words, 6)) for _ in range(n)]
    chunks = spark.createDataFrame([(i, 1, i, text[i]) for i in range(n)], "id long, document_id long, chunk_index int, text string")
    chunks = chunks.withColumn("contextual_text", F.col("text")).withColumn("metadata", F.lit("{}")).withColumn("text_search_vector", ts.search_vector("text")).withColumn("created_at", F.current_timestamp())
    bad = [(n, 1, [0.0] * dim), (n + 1, 1, [1.0]), (n + 2, 1, None), (n + 3, 1, [float("nan")] * dim)]
    vectors = spark.createDataFrame([(i, 1, x[i].tolist()) for i in range(n)] + bad, "chunk_id long, model long, embedding array<float>").withColumn("id", F.col("chunk_id")).withColumn("created_at", F.current_timestamp())
    models = spark.createDataFrame([(1, "m", dim, "p", None, None), (2, "none", 3, "p", None, None)], schemas.MODELS)
    store.commit({"chunks": chunks, "embeddings": vectors, "models": models})
    return store, x


def test_recall_and_equal_word_scores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ix, "LIST_SIZE", 60)
    store, x = filled(spark, tmp_path)
    index = ix.SearchIndex(store)
    made = index.build()
    assert made["vectors"].keys() == {"1"} and made["vectors"]["1"]["count"] == 4000 and made["vectors"]["1"]["lists"] > 40
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for i in range(0, 4000, 400):
        want = set(np.argsort(-(unit @ unit[i]), kind="stable")[:10].tolist())
        got = {r.chunk_id for r in vx.top_k(index.near(made, 1, x[i].tolist()), x[i].tolist(), 10, key="chunk_id").collect()}
        hits, total = hits + len(want & got), total + 10
    assert hits / total >= 0.9
    chunks = store.table("chunks").withColumnRenamed("id", "chunk_id")
    terms = sorted(ts.lexemes_of("turbines ledger"))
    rows = lambda df: sorted((r.chunk_id, round(r.score, 9)) for r in df.collect())
    assert rows(index.words(made, terms)) == rows(ts.bm25_vectors(chunks, terms, key="chunk_id", vector="text_search_vector")) != []
    plan = index.words(made, terms)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "part#" in plan.split("PartitionFilters")[1][:200]
