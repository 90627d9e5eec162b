"""Loading chunk sets and embedding sets into the store: three upserts, one commit.

A failure stays where it is: a document whose numbers of chunks and vectors differ is not loaded, a chunk without text is
left out with its vector, a chunk whose vector is missing (or, if asked, has other dimensions) is loaded without it. Each
is an error row, and everything else of the batch and of the document is loaded. Without ``force`` a document is skipped if its vectors under the model are at least as
new as the incoming ones; with it, its chunks and all their vectors are deleted first. ``prune`` also removes chunks
behind the new last one on an ordinary load.

A load reads and writes only the buckets of the store that its documents fall into, and each of them once: what the
upserts give is written where the commit will name it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions import text as tx
from docmill.functions.textsearch import search_vector
from docmill.operators.embedding import model_info
from docmill.operators.staleness import load_skip
from docmill.operators.upsert import delete_documents, insert_missing, upsert
from docmill.session import Scratch, written
from docmill.store import BUCKETED, Store, bucket_of, with_change, with_metadata


@dataclass
class LoadResult:
    loaded: int
    skipped: int
    errors: DataFrame
    deltas: dict[str, int]


def checked(incoming: DataFrame) -> DataFrame:
    """Adds ``error``: unequal numbers of chunks and vectors. ``incoming`` has the vectors of a document as an array, or
    their number as ``n_vectors``."""
    n = F.size("vectors") if "vectors" in incoming.columns else F.col("n_vectors")
    differ = F.concat(F.lit("chunks and vectors differ: "), F.size("chunks").cast("string"), F.lit(" and "), n.cast("string"))
    return incoming.withColumn("error", F.when(F.size("chunks") != n, differ))


def piece_error(dimensions: int | None = None) -> Column:
    """What is wrong with a chunk (text, contextual_text) and its vector (embedding): null if nothing is."""
    e = F.when(F.col("text").isNull() | F.col("contextual_text").isNull(), F.lit("a chunk has no text")).when(F.col("embedding").isNull(), F.lit("a chunk has no vector"))
    return e.when(F.size("embedding") != dimensions, F.lit("a vector has other dimensions")) if dimensions else e


def _counted(incoming: DataFrame, vectors: DataFrame) -> DataFrame:
    """``incoming`` with the number of its documents' vectors; counted by partial aggregation, not gathered."""
    held = vectors.groupBy("doc_path").agg(F.count("*").cast("int").alias("n_vectors"))
    return incoming.join(held, "doc_path", "left").withColumn("n_vectors", F.coalesce("n_vectors", F.lit(0)))


def load(store: Store, incoming: DataFrame, model: str, *, vectors: DataFrame | None = None, force: bool = False, prune: bool = False, strict_dimensions: bool = False, title: str | None = None, description: str | None = None, user: str | None = None, note: str | None = None, now: Column | None = None) -> LoadResult:
    """``incoming``: doc_path, filename, file_size, last_modified, chunks_file_path, chunks, embedded_at, and the vectors as an
    array ``vectors`` unless they are given as rows (doc_path, chunk_index, embedding)."""
    if vectors is None:
        vectors = incoming.select("doc_path", F.posexplode("vectors").alias("chunk_index", "embedding"))
        incoming = incoming.drop("vectors")
    given_vectors = vectors
    _, dimensions, _ = model_info(model)
    store.initialize(user=user)
    buckets_of_store = store.bucketed()
    number, _ = store.pointer.latest()
    top = store.manifest()["max_ids"]
    now = now if now is not None else F.lit(store.spark.sql("select current_timestamp() t").first().t)
    models_before = store.table("models")
    new_model = models_before.where(F.col("name") == model).isEmpty()
    entry = store.spark.range(1).select(F.lit(model).alias("name"), F.lit(dimensions).alias("dimensions"), F.lit("docmill").alias("provider"), F.lit(None).cast("string").alias("description"))
    scratch = Scratch()
    models = scratch.written(insert_missing(models_before, entry, keys=["name"], now=now), "models")
    model_id = models.where(F.col("name") == model).first().id
    rows = checked(_counted(incoming, given_vectors)).withColumn("_bucket", bucket_of("doc_path", buckets_of_store))
    refused = rows.where(F.col("error").isNotNull()).select("doc_path", F.lit(None).cast("int").alias("chunk_index"), "error")
    good = rows.where(F.col("error").isNull())
    buckets = sorted(r[0] for r in good.select("_bucket").distinct().collect())  # at most as many as the store has
    docs, chunks, vectors = (store.table(n, buckets, marked=True) for n in BUCKETED)
    if not force:
        state = load_skip(docs, chunks, vectors, good.select(F.col("doc_path").alias("path"), "embedded_at"), model_id)
        good = good.join(state.where(~F.col("skip")).select(F.col("path").alias("doc_path")), "doc_path", "left_semi")
    good = scratch.written(good, "incoming")
    given = incoming.count()
    loaded, failed = good.count(), refused.count()
    buckets = sorted(r[0] for r in good.select("_bucket").distinct().collect())
    docs, chunks, vectors = (store.table(n, buckets, marked=True) for n in BUCKETED)
    before = {n: df.count() for n, df in zip(BUCKETED, (docs, chunks, vectors))}
    facts = good.select(F.col("doc_path").alias("path"), "filename", tx.content_type("filename").alias("content_type"), "file_size", "last_modified", "chunks_file_path", "_bucket")
    staged = {}
    staged["documents"], docs = store.stage("documents", upsert(docs, facts, keys=["path"], updated=["filename", "file_size", "last_modified", "chunks_file_path", "updated_at"], now=now, start=top.get("documents", 0)))
    ids = docs.select(F.col("id").alias("document_id"), "path").join(good.select(F.col("doc_path").alias("path")), "path", "left_semi")
    if force:
        chunks, vectors = delete_documents(chunks, vectors, ids.select(F.col("document_id").alias("id")))
    pieces = good.select("doc_path", "_bucket", F.posexplode("chunks").alias("chunk_index", "c")).join(ids.withColumnRenamed("path", "doc_path"), "doc_path").join(given_vectors, ["doc_path", "chunk_index"])
    pieces = pieces.select("doc_path", "document_id", "chunk_index", "c.text", "c.contextual_text", F.coalesce("c.metadata", F.lit("{}")).alias("metadata"), "embedding", "_bucket")
    pieces = scratch.written(pieces.withColumn("error", piece_error(dimensions if strict_dimensions else None)), "pieces")
    errors = written(refused.unionByName(pieces.where("error is not null").select("doc_path", "chunk_index", "error")), "errors")
    wrong = errors.count()
    if prune:
        last = pieces.groupBy("document_id").agg(F.max("chunk_index").alias("last"))
        tail = chunks.join(last, "document_id").where("chunk_index > last").select("id")
        vectors = vectors.join(tail.withColumnRenamed("id", "chunk_id"), "chunk_id", "left_anti").select(*vectors.columns)
        chunks = chunks.join(tail, "id", "left_anti").select(*chunks.columns)
    texts = pieces.where(F.col("text").isNotNull() & F.col("contextual_text").isNotNull())
    new_chunks = texts.drop("embedding", "error", "doc_path").withColumn("text_search_vector", search_vector("contextual_text"))
    staged["chunks"], chunks = store.stage("chunks", upsert(chunks, new_chunks, keys=["document_id", "chunk_index"], updated=["text", "contextual_text", "metadata", "text_search_vector"], now=now, start=top.get("chunks", 0)))
    key = pieces.where("error is null").select("document_id", "chunk_index", "embedding", "_bucket").join(chunks.select(F.col("id").alias("chunk_id"), "document_id", "chunk_index"), ["document_id", "chunk_index"])
    new_vectors = key.select("chunk_id", F.lit(model_id).cast("long").alias("model"), "embedding", "_bucket")
    staged["embeddings"], vectors = store.stage("embeddings", upsert(vectors, new_vectors, keys=["chunk_id", "model"], updated=["embedding", "created_at"], now=now, start=top.get("embeddings", 0)))
    facts_of = {n: df.agg(F.count("*").alias("n"), F.max("id").alias("top")).first() for n, df in zip(BUCKETED, (docs, chunks, vectors))}
    deltas = {}
    for name, fact in facts_of.items():
        change = fact.n - before[name]
        deltas[f"{name}_added"], deltas[f"{name}_deleted"] = max(change, 0), max(-change, 0)
    tables = {"models": models} if new_model else {}
    tables["schema_metadata"] = with_metadata(store, now, title=title, description=description, embedding_models_count=models.count())
    text = note or f"Loaded {given - failed} files with model {model}" + (f" ({wrong} errors)" if wrong else "")
    if given - failed:
        tables["schema_changes"] = with_change(store, now, user=user, deltas=deltas, models=[model] if new_model and deltas["embeddings_added"] else None, notes=text)
    store.commit(tables, staged=staged, buckets=buckets, max_ids={n: f.top or 0 for n, f in facts_of.items()}, after=number)
    scratch.clear()
    return LoadResult(loaded, given - failed - loaded, errors, deltas)
