"""Search indexes kept beside the store, so that a question reads what it needs and not the corpus.

* Words: the postings (term, chunk, frequency, size of the chunk) of the stored text-search vectors, in folders by a hash
  of the term and in term order within a file, so a question prunes folders and row groups by its terms.
* Vectors: an inverted file for each model. Centroids are fitted on a bounded sample (``SAMPLE`` vectors), every vector
  lies in the folder of its nearest centroid, and a question reads the ``probes`` nearest folders.

An index belongs to one snapshot of the store; after a later commit it does not count until it is built again, and
searches scan the stored columns instead. Vectors of other dimensions than their model's, or of length zero, are not in
the index; chunks without words have no postings but count in the statistics.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions import textsearch as ts
from docmill.pointer import Pointer

#: Folders of postings; vectors that centroids are fitted on; vectors of a list; most lists of a model.
TERM_FOLDERS, SAMPLE, LIST_SIZE, MOST_LISTS = 64, 50_000, 2_000, 4_096
PROBES = 16


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def centroids(sample: np.ndarray, count: int, *, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Spherical k-means; fewer centroids than asked for if some lose all their vectors."""
    rng = np.random.default_rng(seed)
    centre = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(sample[i : i + 8192] @ centre.T).argmax(1) for i in range(0, len(sample), 8192)])
        order = np.argsort(near, kind="stable")
        _, at = np.unique(near[order], return_index=True)
        centre = _unit(np.add.reduceat(sample[order], at, axis=0))
    return centre.astype(np.float32)


class SearchIndex:
    def __init__(self, store):
        self.store, self.spark = store, store.spark
        self.pointer = Pointer(store.spark, f"{store.root}/index", "INDEX.json")

    def current(self) -> dict | None:
        """What describes the index, if it belongs to the store's present snapshot."""
        text = self.pointer.read()
        found = json.loads(text) if text else None
        return found if found and found["tables"] == self._tables() else None

    def _tables(self) -> dict:
        tables = self.store.manifest()["tables"]
        return {n: tables[n] for n in ("chunks", "embeddings")}

    def build(self) -> dict:
        number, text = self.pointer.latest()
        before = json.loads(text) if text else None
        folder = f"{self.store.root}/index/{uuid.uuid4().hex}"
        made = {"tables": self._tables(), "folder": folder, **self._words(f"{folder}/words"), "vectors": self._vectors(folder)}
        self.pointer.swap(json.dumps(made), number)
        if before:
            self.pointer.delete(before["folder"])
        return made

    def _words(self, folder: str) -> dict:
        rows = self.store.table("chunks").select(F.col("id").alias("chunk_id"), F.col("text_search_vector").alias("v")).where(F.size("v") > 0).withColumn("size", ts.vector_size("v"))
        posts = rows.select("chunk_id", "size", F.explode("v").alias("p")).select(F.col("p.lexeme").alias("term"), "chunk_id", F.size("p.positions").alias("tf"), "size")
        posts = posts.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(TERM_FOLDERS)).cast("int"))
        # a folder's postings are spread by chunk as well, so a frequent term is no single task
        posts = posts.repartition("part", F.pmod(F.xxhash64("chunk_id"), F.lit(8))).sortWithinPartitions("part", "term", "chunk_id")
        posts.write.partitionBy("part").parquet(folder)
        stats = rows.agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
        return {"documents": stats.n, "mean": stats.mean or 1.0}

    def _vectors(self, folder: str) -> dict:
        out = {}
        for m in self.store.table("models").select("id", "dimensions").collect():  # a row for each model
            rows = self.store.table("embeddings").where((F.col("model") == m.id) & (F.size("embedding") == m.dimensions) & F.exists("embedding", lambda v: v != 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)))
            n = rows.count()
            if not n:
                continue
            share = min(1.0, SAMPLE / n)
            sample = rows.where(F.pmod(F.xxhash64("chunk_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("chunk_id", "embedding").toArrow()
            order = np.argsort(sample.column("chunk_id").to_numpy(), kind="stable")
            x = _unit(np.stack(sample.column("embedding").to_numpy()).astype(np.float32))[order]
            centre = centroids(x, max(1, min(MOST_LISTS, -(-n // LIST_SIZE), len(x))))
            shared = self.spark.sparkContext.broadcast(centre)
            dim = m.dimensions

            def assign(batches: Iterator[pa.RecordBatch], shared=shared, dim=dim) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    lists = batch.column("embedding")
                    y = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)
                    near = (_unit(y) @ shared.value.T).argmax(1) if len(y) else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays([batch.column("chunk_id"), lists, pa.array(near.astype(np.int32))], ["chunk_id", "embedding", "list"])

            placed = rows.select("chunk_id", "embedding").mapInArrow(assign, "chunk_id long, embedding array<float>, list int")
            placed.repartition("list").write.partitionBy("list").parquet(f"{folder}/vectors-{m.id}")
            self.spark.createDataFrame([(bytearray(centre.tobytes()),)], "centre binary").coalesce(1).write.parquet(f"{folder}/centroids-{m.id}")
            out[str(m.id)] = {"count": n, "lists": len(centre)}
        return out

    def words(self, made: dict, terms: list[str]) -> DataFrame:
        """(chunk_id, score): BM25 from the postings of the terms alone."""
        posts = self.spark.read.schema("term string, chunk_id long, tf int, size int, part int").parquet(f"{made['folder']}/words")
        parts = [r.p for r in self.spark.createDataFrame([(t,) for t in terms], "t string").select(F.pmod(F.xxhash64("t"), F.lit(TERM_FOLDERS)).cast("int").alias("p")).distinct().collect()]
        hits = posts.where(F.col("part").isin(parts) & F.col("term").isin(terms))
        return ts.bm25(hits, terms, key="chunk_id", documents=made["documents"], mean_size=made["mean"])

    def near(self, made: dict, model: int, vector: list[float], probes: int = PROBES) -> DataFrame:
        """(chunk_id, embedding) of the lists nearest to a vector."""
        blob = self.spark.read.parquet(f"{made['folder']}/centroids-{model}").first()[0]
        x = np.array(vector, np.float32)
        centre = np.frombuffer(bytes(blob), np.float32).reshape(-1, len(x))
        lists = [int(n) for n in np.argsort(-(centre @ x), kind="stable")[:probes]]
        rows = self.spark.read.schema("chunk_id long, embedding array<float>, list int").parquet(f"{made['folder']}/vectors-{model}")
        return rows.where(F.col("list").isin(lists)).select("chunk_id", "embedding")
