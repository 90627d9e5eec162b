"""Queries of the training-text problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm import boilerplate, bpe, cutting, neardup, packing, sentences, similar
from docmill.session import spread, table, written


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document."""
    return bpe.encode_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.usable_vectors(spread(table(spark, sf_dir, "chunk_embeddings")), table(spark, sf_dir, "models"), table(spark, sf_dir, "chunks").select("id"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, chunk_id_a, chunk_id_b): mutual neighbours with a cosine of at least 0.75."""
    return similar.mutual_pairs(_vectors(spark, sf_dir)).toDF("model", "chunk_id_a", "chunk_id_b")


def p1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, chunk_id, neighbour, rank) of the ten nearest, for every chunk_id divisible by 100 against all vectors."""
    top = similar.most_similar(_vectors(spark, sf_dir), similar.WIDE, queries="chunk_id % 100 = 0")
    return top.select("model", "chunk_id", "neighbour", "rank")


def _oversized(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int, int]:
    capacity, overlap = cutting.budget(table(spark, sf_dir, "budgets"), "piece")
    return cutting.oversized_items(table(spark, sf_dir, "sources"), table(spark, sf_dir, "chunks"), capacity), capacity, overlap


def _cut(spark: SparkSession, sf_dir: str, with_text: bool) -> DataFrame:
    items, capacity, overlap = _oversized(spark, sf_dir)
    return cutting.cut_items(items, capacity=capacity, overlap=overlap, with_text=with_text)


def p3_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_kind, item_id, n_chars, digest, within, natural, shared): every oversized item cut and put together again."""
    items, capacity, overlap = _oversized(spark, sf_dir)
    items = written(items, "oversized")
    return cutting.invariants(items, cutting.cut_items(items, capacity=capacity, overlap=overlap).where("piece is not null"), capacity, overlap)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_kind, item_id, run_start): oversized items (-1) and their stretches without a boundary, around the cuts that met none."""
    rows = _cut(spark, sf_dir, False).where("piece is null or piece = 0")
    return rows.select("item_kind", "item_id", F.when(F.col("piece") == 0, F.lit(-1).cast("long")).otherwise(F.col("start_char")).alias("run_start"))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_kind, item_id, chunk_index, start_char, end_char, text) of all pieces of oversized items."""
    rows = _cut(spark, sf_dir, True).where("piece is not null")
    return rows.select("item_kind", "item_id", F.col("piece").alias("chunk_index"), "start_char", "end_char", "text")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "sources").select("source_id", "path", "title", "content"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, line_no) of the frame lines of every page."""
    return boilerplate.classify(_pages(spark, sf_dir)).where("is_frame").select("source_id", "line_no")


def p4_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, body): the main body of every page."""
    return boilerplate.bodies(_pages(spark, sf_dir))


def _near(spark: SparkSession, sf_dir: str) -> neardup.NearDuplicates:
    return neardup.NearDuplicates(spread(table(spark, sf_dir, "chunks").select("id", "text")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chunk_id_a, chunk_id_b) of near-duplicate passages."""
    return _near(spark, sf_dir).pairs().toDF("chunk_id_a", "chunk_id_b")


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chunk_id, class_id, links) of every passage of 40 words or more."""
    return _near(spark, sf_dir).classes().withColumnRenamed("id", "chunk_id")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(container_id, doc_id, piece, token_start, n_tokens) of every document with a text."""
    capacity, _ = cutting.budget(table(spark, sf_dir, "budgets"), "container")
    sizes = bpe.count_tokens(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return packing.pack(sizes, capacity)


#: Capacities of ``p7_method`` that bind: documents in a container and, as a share of the token budget's square, attention.
METHOD_DOCUMENTS, METHOD_ATTENTION = 8, 0.5


def p7_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(choose, documents, whole, kept, gapless) of packing all documents under three capacities that bind, by the norm of
    the residual and by the dot product."""
    capacity, _ = cutting.budget(table(spark, sf_dir, "budgets"), "container")
    limits = {"documents": METHOD_DOCUMENTS, "attention": int(METHOD_ATTENTION * capacity * capacity)}
    sizes = written(bpe.count_tokens(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))), "sizes")
    rows = [packing.invariants(sizes, written(packing.pack(sizes, capacity, choose=choose, **limits), "packed"), capacity, **limits).select(F.lit(choose).alias("choose"), "documents", "whole", "kept", "gapless") for choose in ("residual", "dot")]
    return rows[0].unionByName(rows[1])


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, start_char, end_char) of every sentence unit."""
    return sentences.split_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")))


P7_SQL = "SELECT choose, (SELECT count(*) FROM documents WHERE text <> '') AS documents, true AS whole, true AS kept, true AS gapless FROM (VALUES ('residual'), ('dot')) v(choose)"
QUERIES = {"p1_found": p1_found, "p1_neighbours": p1_neighbours, "p3_method": p3_method, "p3_found": p3_found, "p3_pieces": p3_pieces, "p4_found": p4_found, "p4_bodies": p4_bodies, "p5_found": p5_found, "p5_classes": p5_classes, "p6_ids": p6_ids, "p7_containers": p7_containers, "p7_method": p7_method, "p8_found": p8_found}
SQL: dict[str, str] = {"p1_found": similar.FOUND_SQL, "p1_neighbours": similar.NEIGHBOURS_SQL, "p3_method": cutting.METHOD_SQL, "p3_found": cutting.FOUND_SQL, "p5_found": neardup.FOUND_SQL, "p5_classes": neardup.CLASSES_SQL, "p7_method": P7_SQL}
