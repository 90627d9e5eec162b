"""Hybrid search over the store: vectors and BM25 fused by reciprocal rank, then the stored retrieval settings.

With an index (:mod:`docmill.operators.index`) of the present snapshot a question reads the postings of its words and the
vector lists near to it; without one it scans the stored text-search vectors and the embeddings, exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docmill.functions import textsearch as ts
from docmill.functions import vectors as vx
from docmill.functions.text import estimate_tokens
from docmill.operators.embedding import DEFAULT_MODEL, model_info, provider_of
from docmill.operators.index import PROBES, SearchIndex

#: Ranks of each list that enter the fusion.
DEPTH = 100


def _ranked(rows: DataFrame, score: str) -> DataFrame:
    """Ranks of an already limited list (at most ``DEPTH`` rows)."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(score), "chunk_id")))


#: Scores are compared at so many decimals, so that ranks do not hang on the order of additions.
DECIMALS = 9


def hybrid(words: DataFrame, vectors: DataFrame, vector: list[float], *, depth: int = DEPTH, threshold: float | None = None) -> DataFrame:
    """(chunk_id, rrf_score, similarity, bm25): two top-``depth`` lists, fused. ``words``: (chunk_id, score), ``vectors``:
    (chunk_id, embedding). Each list is cut by TakeOrdered before it is ranked, so no task holds more than ``depth`` rows."""
    near = vx.top_k(vectors, vector, depth, key="chunk_id", at_least=threshold, decimals=DECIMALS).select("chunk_id", "similarity")
    found = words.withColumn("score", F.round("score", DECIMALS)).orderBy(F.desc("score"), "chunk_id").limit(depth)
    a, b = _ranked(near, "similarity"), _ranked(found, "score")
    fused = ts.reciprocal_rank_fusion(a, b, key="chunk_id").select("chunk_id", "rrf_score")
    return fused.join(a.select("chunk_id", "similarity"), "chunk_id", "left").join(b.select("chunk_id", F.col("score").alias("bm25")), "chunk_id", "left")


def fused_questions(lists: list[DataFrame]) -> DataFrame:
    """The lists of a question's refinements as one: scores add up, the best similarity and BM25 score are shown."""
    rows = lists[0]
    for more in lists[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("chunk_id").agg(F.sum("rrf_score").alias("rrf_score"), F.max("similarity").alias("similarity"), F.max("bm25").alias("bm25"))


def within_budget(ranked: DataFrame, *, max_chunks: int | None = None, max_tokens: int | None = None, order: str = "rrf_score", text: str = "text") -> DataFrame:
    """The best rows while their estimated tokens stay within the budget; ``ranked`` is a short list."""
    if max_chunks:
        ranked = ranked.orderBy(F.desc(order), "chunk_id").limit(max_chunks)
    if not max_tokens:
        return ranked
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc(order), "chunk_id").rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("tokens", F.sum(estimate_tokens(text)).over(w)).where(F.col("tokens") <= max_tokens)


def overlap_reranker(query: str) -> Callable[[DataFrame], DataFrame]:
    """A deterministic stand-in for a cross-encoder: the share of the query's lexemes in the text."""
    wanted = sorted(ts.lexemes_of(query))

    def rerank(rows: DataFrame) -> DataFrame:
        found = F.transform(ts.search_vector("text"), lambda x: x["lexeme"])
        share = F.size(F.array_intersect(found, F.array(*map(F.lit, wanted)))) / max(1, len(wanted)) if wanted else F.lit(0.0)
        return rows.withColumn("rrf_score", F.col("rrf_score") + share)

    return rerank


def refined(query: str, count: int, refine: Callable[[str, int], list[str]] | None = None) -> list[str]:
    """The query and its refinements; without a provider the query alone."""
    return [query, *(refine(query, count) if refine and count else [])][: count + 1]


def search(store, query: str, *, model: str = DEFAULT_MODEL, encode=None, rerank: Callable[[DataFrame], DataFrame] | None = None, refine: Callable[[str, int], list[str]] | None = None, probes: int = PROBES) -> DataFrame:
    """Passages for a question: document_path, chunk_index, text, similarity, bm25, rrf_score, by the stored settings.

    ``refine`` (question, count -> questions) is asked if the settings enable refinement; ``probes``: lists of the vector
    index that are read.
    """
    settings = store.table("rag_settings").first()
    get = lambda name: getattr(settings, name) if settings is not None else None
    _, dimensions, _ = model_info(model)
    encode = encode or provider_of(model)(dimensions)
    count = (get("refinement_questions_count") or 0) if get("enable_refinement") else 0
    questions = refined(query, count, refine)
    row = store.table("models").where(F.col("name") == model).first()
    model_id = row.id if row else -1
    chunks = store.table("chunks")
    index = SearchIndex(store)
    made = index.current()
    lists = []
    for question, vector in zip(questions, encode(questions)):  # a handful
        vector, terms = [float(x) for x in vector], sorted(ts.lexemes_of(question)) or [""]
        if made is not None and str(model_id) in made["vectors"]:
            words, vectors = index.words(made, terms), index.near(made, model_id, vector, probes)
        else:
            words = ts.bm25_vectors(chunks.withColumnRenamed("id", "chunk_id"), terms, key="chunk_id", vector="text_search_vector")
            vectors = store.table("embeddings").where(F.col("model") == model_id)
        lists.append(hybrid(words, vectors, vector, threshold=get("similarity_threshold")))
    found = fused_questions(lists) if len(lists) > 1 else lists[0]
    rows = chunks.select(F.col("id").alias("chunk_id"), "document_id", "chunk_index", "text").join(F.broadcast(found), "chunk_id")  # some hundreds of rows
    rows = store.table("documents").select(F.col("id").alias("document_id"), F.col("path").alias("document_path")).join(F.broadcast(rows), "document_id")
    if rerank is not None and (settings is None or get("enable_reranking") is not False):
        rows = rerank(rows)
    out = within_budget(rows, max_chunks=get("max_chunks") or 10, max_tokens=get("max_tokens_in_context"))
    return out.select("document_path", "chunk_index", "text", "similarity", "bm25", "rrf_score").orderBy(F.desc("rrf_score"), "document_path", "chunk_index")
