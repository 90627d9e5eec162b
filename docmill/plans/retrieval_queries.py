"""Queries on stages, store operations and retrieval over the test tables, each over its whole tables.

Scenarios are deterministic: where a query needs an older state of the store, documents whose id is divisible by 10
are not yet in it and those whose id is divisible by 7 have changed since.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill import status
from docmill.functions import text as tx
from docmill.functions import textsearch as ts
from docmill.functions import vectors as vx
from docmill.functions.hashing import content_hash
from docmill.load import checked, load, piece_error
from docmill.operators import staleness as st
from docmill.operators.chunking import chunk_documents
from docmill.operators.embedding import DEFAULT_MODEL, embed
from docmill.operators.ordered import previous_row
from docmill.operators.providers import SUMMARY_RESERVE, messages, usable_tokens
from docmill.operators.upsert import delete_documents, insert_missing, upsert
from docmill.schemas import EMBEDDING_MODELS, MAX_TOKENS, TABLES
from docmill.session import new_folder, spread, table, written
from docmill.sources.discovery import collisions, leaf_folders
from docmill.sources.extract import extract, page_text

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _now():
    return F.lit("2032-01-01 00:00:00").cast("timestamp")

SPACE = r"[\t\n\v\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


# -- paths, names, types


@query("content_paths", r"SELECT doc_id, regexp_replace(path || coalesce(regexp_extract(filename, '\.[^./]+$'), ''), '([^/])\.[^./]*$', '\1') AS content_path FROM documents")
def content_paths(spark, d):
    return _docs(spark, d).select("doc_id", tx.content_path(F.concat("path", F.coalesce(F.regexp_extract("filename", r"\.[^./]+$", 0), F.lit("")))).alias("content_path"))


@query("path_collisions", r"SELECT content_path, count(*) AS files FROM (SELECT regexp_replace(filename, '([^/])\.[^./]*$', '\1') AS content_path FROM documents) GROUP BY content_path HAVING count(*) > 1")
def path_collisions(spark, d):
    return collisions(_docs(spark, d), column="filename")


@query("content_types", r"SELECT t AS content_type, count(*) AS n FROM (SELECT CASE lower(regexp_extract(filename, '[^/.][^/]*(\.[^./]+)$', 1)) WHEN '.json' THEN 'application/json' WHEN '.txt' THEN 'text/plain' WHEN '.md' THEN 'text/markdown' WHEN '.html' THEN 'text/html' WHEN '.pdf' THEN 'application/pdf' ELSE 'application/octet-stream' END AS t FROM documents) GROUP BY t")
def content_types(spark, d):
    return _docs(spark, d).groupBy(tx.content_type("filename").alias("content_type")).agg(F.count("*").alias("n"))


@query("ingestible_files", r"SELECT doc_id FROM documents WHERE lower(regexp_extract(filename, '[^/.][^/]*(\.[^./]+)$', 1)) IN ('.html', '.htm', '.pdf', '.docx', '.pptx', '.xlsx', '.md', '.csv')")
def ingestible_files(spark, d):
    return _docs(spark, d).where(tx.is_ingestible("filename")).select("doc_id")


@query("display_paths", "SELECT doc_id, regexp_replace(path || '/source.json', '/source\\.json$', '') AS shown FROM documents")
def display_paths(spark, d):
    return _docs(spark, d).select("doc_id", tx.display_path(F.concat("path", F.lit("/source.json"))).alias("shown"))


@query("matching_paths", r"SELECT DISTINCT path FROM documents WHERE regexp_matches(path, '^(?:[^/]+/)*2027/[^/]*folder[^/]*$')")
def matching_paths(spark, d):
    return _docs(spark, d).where(F.col("path").rlike(tx.glob_regex("**/2027/*folder*"))).select("path").distinct()


@query("leaf_folders", r"""
WITH f AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM documents), g AS (SELECT folder FROM f WHERE folder <> '')
SELECT folder FROM g WHERE NOT EXISTS (SELECT 1 FROM g h WHERE starts_with(h.folder, g.folder || '/'))""")
def leaf_folders_query(spark, d):
    return leaf_folders(_docs(spark, d))


# -- hashes and metadata


@query("source_hash")
def source_hash(spark, d):
    return _docs(spark, d).select("doc_id", content_hash("text").alias("source_hash"))


#: Published values of XXH64 with seed 0.
_XXH64 = {"": "ef46db3751d8e999", "a": "d24ec4f1a98c6e5b", "abc": "44bc2cf5ad770999", "Nobody inspects the spammish repetition": "fbcea83c8a378bf1"}


@query("hash_vectors", "SELECT * FROM (VALUES " + ", ".join(f"('{k}', 'xxh64:{v}')" for k, v in _XXH64.items()) + ") v(body, hash)")
def hash_vectors(spark, d):
    """The published hash on texts whose value is known."""
    return spark.createDataFrame([(k,) for k in _XXH64], "body string").select("body", content_hash("body").alias("hash"))


@query("meta_fields", r"""SELECT doc_id, '1.0' AS version, filename AS name, file_size, title, language FROM documents LEFT JOIN (SELECT doc_id AS m, max(content.title) AS title, max(content.language) AS language FROM meta GROUP BY doc_id) ON m = doc_id""")
def meta_fields(spark, d):
    from docmill.pipeline import meta_json

    titles = table(spark, d, "meta").groupBy("doc_id").agg(F.max("content.title").alias("title"), F.max("content.language").alias("language"))
    rows = _docs(spark, d).join(titles, "doc_id", "left")
    made = meta_json(ingested_at=tx.iso_utc("created_at"), source_hash=F.lit(None).cast("string"), original_path=F.col("filename"), size=F.col("file_size"), modified=tx.iso_utc("last_modified"), mime=F.col("content_type"), title=F.col("title"), language=F.col("language"))
    j = rows.select("doc_id", made.alias("m"))
    get = lambda p: F.get_json_object("m", p)
    return j.select("doc_id", get("$.metadata_version").alias("version"), get("$.filesystem.original_path").alias("name"), get("$.filesystem.size_bytes").cast("bigint").alias("file_size"), get("$.content.title").alias("title"), get("$.content.language").alias("language"))


@query("iso_times", "SELECT doc_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS created, strftime(updated_at, '%Y-%m-%d %H:%M') AS updated FROM documents")
def iso_times(spark, d):
    return _docs(spark, d).select("doc_id", tx.iso_utc("created_at").alias("created"), tx.shown_time("updated_at").alias("updated"))


# -- staleness

_HASHES = "SELECT doc_id, max(processing.source_hash) AS hash, max(filesystem.mtime) AS mtime FROM meta GROUP BY doc_id"


def _hashes(spark, d):
    return table(spark, d, "meta").groupBy("doc_id").agg(F.max("processing.source_hash").alias("hash"), F.max("filesystem.mtime").alias("mtime"))


@query("needs_update", f"""
WITH h AS ({_HASHES}), v AS (SELECT d.doc_id, d.path, h.hash, h.mtime, h.doc_id IS NOT NULL AS has_meta, lag(h.hash) OVER w AS old_hash, lag(h.mtime) OVER w AS old_time, lag(d.doc_id) OVER w AS old_id
  FROM documents d LEFT JOIN h ON h.doc_id = d.doc_id WINDOW w AS (PARTITION BY d.path ORDER BY d.doc_id))
SELECT doc_id, CASE WHEN old_id IS NULL THEN true WHEN mtime IS NULL AND hash IS NULL THEN false WHEN NOT has_meta THEN true WHEN mtime IS NOT NULL AND (old_time IS NULL OR old_time <> mtime) THEN true WHEN hash IS NOT NULL AND (old_hash IS NULL OR old_hash <> hash) THEN true ELSE false END AS needs FROM v""")
def needs_update(spark, d):
    rows = _docs(spark, d).select("doc_id", "path").join(_hashes(spark, d).withColumn("has", F.lit(True)), "doc_id", "left")
    rows = previous_row(rows, key="path", order="doc_id", columns=["doc_id", "hash", "mtime"])
    p = F.col("previous")
    return rows.select("doc_id", st.needs_update(exists=p.isNotNull(), has_meta=F.col("has").isNotNull(), given_time=F.col("mtime"), stored_time=p["mtime"], given_hash=F.col("hash"), stored_hash=p["hash"]).alias("needs"))


@query("ingest_stale", "SELECT doc_id FROM documents WHERE updated_at IS NULL OR last_modified IS NULL OR last_modified > updated_at")
def ingest_stale(spark, d):
    return _docs(spark, d).where(st.ingestion_stale("last_modified", "updated_at")).select("doc_id")


@query("chunks_stale", f"""
WITH h AS ({_HASHES}), c AS (SELECT DISTINCT document_id FROM chunks WHERE document_id % 10 <> 0)
SELECT d.doc_id FROM documents d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN c ON c.document_id = d.doc_id
WHERE c.document_id IS NULL OR h.hash IS DISTINCT FROM (CASE WHEN d.doc_id % 7 = 0 THEN 'old' ELSE h.hash END)""")
def chunks_stale(spark, d):
    have = table(spark, d, "chunks").where("document_id % 10 <> 0").select(F.col("document_id").alias("doc_id")).distinct()
    current = _docs(spark, d).select("doc_id").join(_hashes(spark, d).select("doc_id", "hash"), "doc_id", "left")
    stored = current.join(have, "doc_id").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.lit("old")).otherwise(F.col("hash")).alias("hash"))
    return st.work_list(current, stored, ["doc_id"], ["hash"]).select("doc_id")


@query("embeddings_stale", """SELECT c.id AS chunk_id, m.id AS model FROM (SELECT DISTINCT id FROM chunks) c, models m
LEFT JOIN (SELECT chunk_id, model, max(len(embedding)) AS dims FROM chunk_embeddings GROUP BY chunk_id, model) e ON e.chunk_id = c.id AND e.model = m.id
WHERE m.id = 1 AND (e.chunk_id IS NULL OR e.dims IS DISTINCT FROM m.dimensions)""")
def embeddings_stale(spark, d):
    have = table(spark, d, "chunk_embeddings").where("model = 1").groupBy("chunk_id").agg(F.max(F.when(F.col("embedding").isNotNull(), F.size("embedding"))).alias("dims"))
    want = table(spark, d, "models").where("id = 1").first().dimensions
    current = table(spark, d, "chunks").select(F.col("id").alias("chunk_id")).distinct().withColumn("dims", F.lit(want).cast("int"))
    return st.work_list(current, have, ["chunk_id"], ["dims"]).select("chunk_id", F.lit(1).cast("bigint").alias("model"))


@query("load_skip", """
WITH l AS (SELECT d.path, max(e.created_at) AS loaded FROM documents d JOIN (SELECT DISTINCT id, document_id FROM chunks) c ON c.document_id = d.doc_id JOIN chunk_embeddings e ON e.chunk_id = c.id WHERE e.model = 1 GROUP BY d.path),
i AS (SELECT path, max(updated_at) AS at FROM documents GROUP BY path)
SELECT i.path, coalesce(l.loaded >= i.at, false) AS skip FROM i LEFT JOIN l ON l.path = i.path""")
def load_skip(spark, d):
    docs = _docs(spark, d).select(F.col("doc_id").alias("id"), "path", "updated_at")
    incoming = docs.groupBy("path").agg(F.max("updated_at").alias("embedded_at"))
    return st.load_skip(docs, table(spark, d, "chunks").select("id", "document_id").distinct(), table(spark, d, "chunk_embeddings"), incoming, 1).select("path", "skip")


@query("retry_work_list", f"""
WITH h AS ({_HASHES}), c AS (SELECT DISTINCT document_id FROM chunks)
SELECT d.doc_id FROM documents d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN c ON c.document_id = d.doc_id
WHERE c.document_id IS NULL OR d.doc_id % 10 = 0 OR d.doc_id % 9 = 0 OR h.hash IS DISTINCT FROM (CASE WHEN d.doc_id % 7 = 0 THEN 'old' ELSE h.hash END)""")
def retry_work_list(spark, d):
    """What a stage makes again: missing, changed, and whatever failed last time, also beside a good older row."""
    have = table(spark, d, "chunks").select(F.col("document_id").alias("doc_id")).distinct()
    current = _docs(spark, d).select("doc_id").join(_hashes(spark, d).select("doc_id", "hash"), "doc_id", "left")
    stored = current.join(have, "doc_id").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.lit("old")).otherwise(F.col("hash")).alias("hash"), F.when(F.col("doc_id") % 10 == 0, F.lit("TimeoutError")).alias("error"))
    older = stored.where("doc_id % 9 = 0").select("doc_id", F.lit("older").alias("hash"), F.lit(None).cast("string").alias("error"))
    failed = stored.where("doc_id % 9 = 0").select("doc_id", "hash", F.lit("ValueError").alias("error"))
    stored = stored.where("doc_id % 9 <> 0").unionByName(older).unionByName(failed)
    return st.work_list(current, stored, ["doc_id"], ["hash"], failed=F.col("error").isNotNull()).select("doc_id")


# -- texts


@query("token_estimates", "SELECT doc_id, CAST(floor(length(text) / 3.0) AS INT) AS tokens FROM documents")
def token_estimates(spark, d):
    return _docs(spark, d).select("doc_id", tx.estimate_tokens("text").alias("tokens"))


@query("needs_summary", "SELECT doc_id FROM documents WHERE floor(length(text) / 3.0) > 5734")
def needs_summary(spark, d):
    return _docs(spark, d).where(tx.estimate_tokens("text") > usable_tokens(8192)).select("doc_id")


def _packing_sql(limit: int, columns: str, where: str = "") -> str:
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(text, '{SPACE}+'), lambda x: x <> '') AS ws FROM documents {where}),
r AS (
  SELECT doc_id, ws, 1 AS n, 0 AS chunk, 0 AS size, false AS fresh FROM w WHERE len(ws) > 0
  UNION ALL
  SELECT doc_id, ws, n + 1, CASE WHEN size > 0 AND size + length(ws[n]) + 1 > {limit} THEN chunk + 1 ELSE chunk END,
    CASE WHEN size > 0 AND size + length(ws[n]) + 1 > {limit} THEN length(ws[n]) + 1 ELSE size + length(ws[n]) + 1 END, true FROM r WHERE n <= len(ws)
), s AS (SELECT doc_id, chunk, max(size) - 1 AS n_chars, count(*) AS n_words, md5(string_agg(ws[n - 1], ' ' ORDER BY n)) AS digest FROM r WHERE fresh GROUP BY doc_id, chunk)
SELECT {columns} FROM s"""


@query("greedy_chunks", _packing_sql(1350, "doc_id, CAST(chunk AS INT) AS chunk_index, CAST(n_chars AS INT) AS n_chars, CAST(n_words AS INT) AS n_words, digest"))
def greedy_chunks(spark, d):
    rows = spread(_docs(spark, d).select("doc_id", "text")).select("doc_id", F.posexplode(tx.greedy_chunks("text", MAX_TOKENS)).alias("chunk_index", "t"))
    return rows.select("doc_id", "chunk_index", F.char_length("t").alias("n_chars"), F.size(F.split("t", " ")).alias("n_words"), F.md5("t").alias("digest"))


@query("summary_parts", _packing_sql(15402, "doc_id, CAST(chunk AS INT) AS part, digest", "WHERE floor(length(text) / 3.0) > 5734"))
def summary_parts(spark, d):
    most = usable_tokens(8192)
    big = _docs(spark, d).where(tx.estimate_tokens("text") > most)
    return big.select("doc_id", F.posexplode(tx.greedy_chunks("text", most - SUMMARY_RESERVE)).alias("part", "t")).select("doc_id", "part", F.md5("t").alias("digest"))


@query("nbsp_normalized", "SELECT id, replace(text, chr(160), ' ') AS text FROM chunks WHERE contains(text, chr(160))")
def nbsp_normalized(spark, d):
    return table(spark, d, "chunks").where(F.col("text").contains("\u00a0")).select("id", tx.replace_nbsp("text").alias("text"))


@query("contextual_text", r"SELECT c.id, c.created_at::VARCHAR AS made, concat_ws(chr(10) || chr(10), m.title, c.text) AS contextual FROM (SELECT id, document_id, text, strftime(created_at, '%Y-%m-%d %H:%M') AS created_at FROM chunks) c LEFT JOIN (SELECT doc_id, max(content.title) AS title FROM meta GROUP BY doc_id) m ON m.doc_id = c.document_id")
def contextual_text(spark, d):
    titles = table(spark, d, "meta").groupBy(F.col("doc_id").alias("document_id")).agg(F.max("content.title").alias("title"))
    rows = table(spark, d, "chunks").join(titles, "document_id", "left")
    return rows.select("id", tx.shown_time("created_at").alias("made"), tx.contextual_text("title", "text").alias("contextual"))


_TURNS = messages("", "")  # what every request has besides document and passage
_FIXED = [len(t["content"]) for t in _TURNS]


@query("context_messages", f"""WITH c AS (SELECT id, min(document_id) AS document_id, arg_min(text, document_id) AS text FROM chunks WHERE text IS NOT NULL GROUP BY id)
SELECT c.id, 'system,user,assistant,user' AS roles, {_FIXED[1]} + length(coalesce(d.text, '')) AS document, {_FIXED[3]} + length(c.text) AS passage FROM c LEFT JOIN documents d ON d.doc_id = c.document_id""")
def context_messages(spark, d):
    """The turns that are sent for every passage with its document, made by the provider's own function."""
    one = table(spark, d, "chunks").where("text is not null").groupBy("id").agg(F.min("document_id").alias("document_id"), F.min_by("text", "document_id").alias("text"))
    rows = one.join(_docs(spark, d).select(F.col("doc_id").alias("document_id"), F.col("text").alias("document")), "document_id", "left")

    @F.pandas_udf("struct<roles:string,document:bigint,passage:bigint>")
    def turns(document: pd.Series, passage: pd.Series) -> pd.DataFrame:
        made = [messages(x or "", y) for x, y in zip(document, passage)]
        return pd.DataFrame({"roles": [",".join(t["role"] for t in m) for m in made], "document": [len(m[1]["content"]) for m in made], "passage": [len(m[3]["content"]) for m in made]})

    return rows.select("id", turns("document", "text").alias("t")).select("id", "t.roles", "t.document", "t.passage")


@query("text_previews", "SELECT doc_id, CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END AS preview FROM documents")
def text_previews(spark, d):
    return _docs(spark, d).select("doc_id", tx.preview("text").alias("preview"))


@query("page_headings", r"SELECT source_id, regexp_extract(content, '<h1>([^<]*)</h1>', 1) AS heading FROM sources WHERE contains(content, '<h1>')")
def page_headings(spark, d):
    return table(spark, d, "sources").where(F.col("content").contains("<h1>")).select("source_id", F.regexp_extract("content", "<h1>([^<]*)</h1>", 1).alias("heading"))


@query("page_text", r"SELECT source_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(content, '(?is)<(?:script|style)\b.*?</(?:script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\n\v\f\r]+', ' ', 'g'), ' ')) AS digest FROM sources")
def page_text_query(spark, d):
    return table(spark, d, "sources").select("source_id", F.md5(page_text("content")).alias("digest"))


def _parsed(spark, d):
    kind = F.when(F.col("content").contains("</"), F.lit("page.html")).otherwise(F.lit("page.md"))
    return extract(spread(table(spark, d, "sources").select(F.col("source_id"), kind.alias("name"), F.encode("content", "utf-8").alias("content"))), name="name")


@query("page_blocks")
def page_blocks(spark, d):
    return _parsed(spark, d).select("source_id", "title", F.size("blocks").alias("blocks"), "error")


@query("structural_chunks")
def structural_chunks(spark, d):
    made = chunk_documents(_parsed(spark, d).where("error is null").select("source_id", "blocks"))
    return made.select("source_id", F.posexplode("chunks").alias("chunk_index", "c")).select("source_id", "chunk_index", "c.text", "c.contextual_text")


# -- vectors


@query("hash_embeddings")
def hash_embeddings(spark, d):
    return table(spark, d, "chunks").groupBy("id").agg(F.min("text").alias("text")).select("id", embed("text").alias("embedding"))


@query("l2_norms", "SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm, label FROM embeddings")
def l2_norms(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(vx.norm("embedding"), 6).alias("norm"), "label")


@query("normalized", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: abs((x::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])))::FLOAT::DOUBLE))), 4) AS l1 FROM embeddings")
def normalized(spark, d):
    v = vx.normalized("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(v, F.lit(0.0), lambda s, x: s + F.abs(x)), 4).alias("l1"))


@query("dimension_check", "SELECT e.id, len(e.embedding) AS found, m.dimensions AS expected FROM chunk_embeddings e JOIN models m ON m.id = e.model WHERE e.embedding IS NOT NULL AND len(e.embedding) <> m.dimensions")
def dimension_check(spark, d):
    rows = table(spark, d, "chunk_embeddings").join(table(spark, d, "models").select(F.col("id").alias("model"), "dimensions"), "model")
    return rows.where(F.col("embedding").isNotNull() & (F.size("embedding") != F.col("dimensions"))).select("id", F.size("embedding").cast("bigint").alias("found"), F.col("dimensions").alias("expected"))


@query("count_check", """WITH c AS (SELECT DISTINCT document_id, id FROM chunks WHERE document_id IS NOT NULL), n AS (SELECT document_id, count(*) AS chunks FROM c GROUP BY document_id),
e AS (SELECT document_id, count(DISTINCT chunk_id) AS vectors FROM c JOIN chunk_embeddings e ON e.chunk_id = c.id WHERE e.model = 1 GROUP BY document_id)
SELECT CAST(n.document_id AS VARCHAR) AS doc_path, 'chunks and vectors differ: ' || n.chunks || ' and ' || coalesce(e.vectors, 0) AS error FROM n LEFT JOIN e ON e.document_id = n.document_id WHERE n.chunks <> coalesce(e.vectors, 0)""")
def count_check(spark, d):
    """The check that a load makes of every document."""
    rows = table(spark, d, "chunks").where("document_id is not null").groupBy("document_id", "id").agg(F.min("text").alias("text"))
    have = table(spark, d, "chunk_embeddings").where("model = 1").groupBy(F.col("chunk_id").alias("id")).agg(F.lit(True).alias("has"))
    sets = rows.join(have, "id", "left").groupBy(F.col("document_id").cast("string").alias("doc_path")).agg(F.collect_list("id").alias("chunks"), F.count("has").cast("int").alias("n_vectors"))
    return checked(sets).where(F.col("error").isNotNull()).select("doc_path", "error")


@query("piece_errors", """WITH e AS (SELECT chunk_id, arg_max({v: embedding}, id).v AS v FROM chunk_embeddings WHERE model = 1 GROUP BY chunk_id), c AS (SELECT id, min(text) AS t, min(contextual_text) AS x FROM chunks GROUP BY id)
SELECT id, CASE WHEN t IS NULL OR x IS NULL THEN 'a chunk has no text' WHEN v IS NULL THEN 'a chunk has no vector' ELSE 'a vector has other dimensions' END AS error FROM c LEFT JOIN e ON e.chunk_id = c.id
WHERE t IS NULL OR x IS NULL OR v IS NULL OR len(v) <> (SELECT dimensions FROM models WHERE id = 1)""")
def piece_errors(spark, d):
    """What a load leaves out of a document: chunks without text, vectors that are missing or of other dimensions."""
    dims = table(spark, d, "models").where("id = 1").first().dimensions
    vectors = table(spark, d, "chunk_embeddings").where("model = 1").groupBy("chunk_id").agg(F.max_by(F.struct("embedding"), "id").alias("s")).select(F.col("chunk_id").alias("id"), "s.embedding")
    rows = table(spark, d, "chunks").groupBy("id").agg(F.min("text").alias("text"), F.min("contextual_text").alias("contextual_text")).join(vectors, "id", "left")
    return rows.withColumn("error", piece_error(dims)).where(F.col("error").isNotNull()).select("id", "error")


def _query_vector(spark, d) -> list[float]:
    return [float(x) for x in table(spark, d, "embeddings").orderBy("vec_id").select("embedding").first()[0]]


_COSINE = "list_dot_product(e.embedding::DOUBLE[], q.v) / (sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(q.v, q.v)))"
_QUERY = "q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings ORDER BY vec_id LIMIT 1)"


@query("vector_topk", f"WITH {_QUERY} SELECT vec_id, round({_COSINE}, 6) AS similarity FROM embeddings e, q ORDER BY {_COSINE} DESC, vec_id LIMIT 10")
def vector_topk(spark, d):
    return vx.top_k(table(spark, d, "embeddings"), _query_vector(spark, d), 10, key="vec_id").select("vec_id", F.round("similarity", 6).alias("similarity"))


@query("vector_threshold", f"WITH {_QUERY} SELECT label, count(*) AS n FROM embeddings e, q WHERE {_COSINE} >= 0.3 GROUP BY label")
def vector_threshold(spark, d):
    literal = F.array(*[F.lit(x) for x in _query_vector(spark, d)])
    return table(spark, d, "embeddings").where(vx.cosine("embedding", literal) >= 0.3).groupBy("label").agg(F.count("*").alias("n"))


# -- store operations


def _target(spark, d) -> DataFrame:
    docs = _docs(spark, d)
    first = docs.groupBy("path").agg(F.min("doc_id").alias("doc_id"))
    return docs.join(first, ["path", "doc_id"], "left_semi").where("doc_id % 10 <> 0").select(F.col("doc_id").alias("id"), "path", "filename", "content_type", "file_size", "last_modified", "chunks_file_path", "created_at", "updated_at")


_TARGET = "t AS (SELECT d.* FROM documents d JOIN (SELECT path, min(doc_id) AS doc_id FROM documents GROUP BY path) f ON f.doc_id = d.doc_id WHERE d.doc_id % 10 <> 0)"
_LATEST = "n AS (SELECT d.* FROM documents d JOIN (SELECT path, max(doc_id) AS doc_id FROM documents GROUP BY path) f ON f.doc_id = d.doc_id)"


@query("upsert_documents", f"""WITH {_TARGET}, {_LATEST} SELECT n.path, n.filename, coalesce(t.content_type, n.content_type) AS content_type, n.file_size, t.path IS NULL AS inserted,
coalesce(strftime(t.created_at, '%Y-%m-%d %H:%M'), '2032-01-01 00:00') AS created, '2032-01-01 00:00' AS updated, CASE WHEN t.path IS NOT NULL THEN t.doc_id END AS kept_id FROM n LEFT JOIN t ON t.path = n.path""")
def upsert_documents(spark, d):
    docs, old = _docs(spark, d), _target(spark, d)
    newest = docs.join(docs.groupBy("path").agg(F.max("doc_id").alias("doc_id")), ["path", "doc_id"], "left_semi")
    incoming = newest.select("path", "filename", "content_type", "file_size", "last_modified", "chunks_file_path")
    out = upsert(old, incoming, keys=["path"], updated=["filename", "file_size", "last_modified", "chunks_file_path", "updated_at"], now=_now())
    top = old.agg(F.max("id")).first()[0] or 0
    inserted = F.col("id") > top
    return out.select("path", "filename", "content_type", "file_size", inserted.alias("inserted"), tx.shown_time("created_at").alias("created"), tx.shown_time("updated_at").alias("updated"), F.when(~inserted, F.col("id")).alias("kept_id"))


def _chunk_rows(spark, d) -> DataFrame:
    rows = table(spark, d, "chunks")
    return rows.groupBy("document_id", "chunk_index").agg(F.min("id").alias("id"), F.min_by("text", "id").alias("text"))


@query("upsert_chunks", """WITH c AS (SELECT document_id, chunk_index, min(id) AS id, arg_min(text, id) AS text FROM chunks GROUP BY document_id, chunk_index)
SELECT document_id, chunk_index, CASE WHEN id % 7 = 0 OR id % 10 = 0 THEN text || '!' ELSE text END AS text FROM c""")
def upsert_chunks(spark, d):
    rows = _chunk_rows(spark, d)
    target = rows.where("id % 10 <> 0").select("id", "document_id", "chunk_index", "text", _now().alias("created_at"))
    incoming = rows.where("id % 10 = 0 or id % 7 = 0").select("document_id", "chunk_index", F.concat("text", F.lit("!")).alias("text"))
    return upsert(target, incoming, keys=["document_id", "chunk_index"], updated=["text"], now=_now()).select("document_id", "chunk_index", "text")


@query("upsert_embeddings", """WITH e AS (SELECT chunk_id, model, max(coalesce(len(embedding), 0)) AS n FROM chunk_embeddings GROUP BY chunk_id, model)
SELECT chunk_id, model, CASE WHEN chunk_id % 7 = 0 OR chunk_id % 10 = 0 THEN -n ELSE n END AS n FROM e""")
def upsert_embeddings(spark, d):
    """Vectors replaced by their negatives; the size (negative where replaced) is given only where the upserted vector is
    the one expected, else null."""
    n = F.coalesce(F.when(F.col("embedding").isNotNull(), F.size("embedding")), F.lit(0))
    rows = table(spark, d, "chunk_embeddings").groupBy("chunk_id", "model").agg(F.max_by("embedding", F.struct(n, "id")).alias("embedding"), F.min("id").alias("id"))
    replaced = F.expr("chunk_id % 10 = 0 or chunk_id % 7 = 0")
    negative = F.transform("embedding", lambda x: -x)
    target = rows.where("chunk_id % 10 <> 0").select("id", "chunk_id", "model", "embedding")
    out = upsert(target, rows.where(replaced).select("chunk_id", "model", negative.alias("embedding")), keys=["chunk_id", "model"], updated=["embedding"], now=_now())
    expected = rows.select("chunk_id", "model", F.xxhash64(F.when(replaced, negative).otherwise(F.col("embedding"))).alias("expected"))
    size = F.coalesce(F.when(F.col("embedding").isNotNull(), F.size("embedding")), F.lit(0)).cast("bigint")
    kept = F.xxhash64("embedding") == F.col("expected")
    return out.join(expected, ["chunk_id", "model"]).select("chunk_id", "model", F.when(kept, F.when(replaced, -size).otherwise(size)).alias("n"))


@query("cascade_delete", """SELECT count(*) AS chunks, (SELECT count(*) FROM chunk_embeddings e WHERE e.chunk_id NOT IN (SELECT id FROM chunks WHERE document_id % 7 = 0)) AS embeddings FROM chunks WHERE document_id IS NULL OR document_id % 7 <> 0""")
def cascade_delete(spark, d):
    ids = table(spark, d, "chunks").where("document_id % 7 = 0").select(F.col("document_id").alias("id")).distinct()
    chunks, vectors = delete_documents(table(spark, d, "chunks"), table(spark, d, "chunk_embeddings"), ids)
    return status.counts_row({"chunks": chunks, "embeddings": vectors})


_REGISTRY = ", ".join(f"('{n}', {dims})" for n, (_, dims, _) in EMBEDDING_MODELS.items())


@query("models_insert", f"SELECT name, dimensions FROM models UNION ALL SELECT * FROM (VALUES {_REGISTRY}) r(name, dimensions) WHERE name NOT IN (SELECT name FROM models)")
def models_insert(spark, d):
    registry = spark.createDataFrame([(n, v[1]) for n, v in EMBEDDING_MODELS.items()], "name string, dimensions int")
    again = table(spark, d, "models").select("name", F.lit(1).alias("dimensions"))  # known names: nothing of them may change
    incoming = registry.join(again, "name", "left_anti").unionByName(again)
    return insert_missing(table(spark, d, "models"), incoming, keys=["name"], now=_now()).select("name", "dimensions")


_LOADED = """c AS (SELECT document_id, chunk_index, arg_min(text, id) AS text FROM chunks WHERE text IS NOT NULL AND document_id IS NOT NULL AND chunk_index IS NOT NULL GROUP BY document_id, chunk_index),
n AS (SELECT document_id, count(*) AS n, md5(string_agg(text, chr(10) ORDER BY chunk_index)) AS digest FROM c GROUP BY document_id),
p AS (SELECT path, max(doc_id) AS doc_id FROM documents WHERE path IS NOT NULL AND doc_id IN (SELECT document_id FROM n) GROUP BY path), i AS (SELECT p.path, p.doc_id, n.n, n.digest FROM p JOIN n ON n.document_id = p.doc_id)"""


def _incoming(spark, d) -> DataFrame:
    """Chunk and vector sets of the newest chunked delivery of every path, ready to be loaded."""
    rows = table(spark, d, "chunks").where("text is not null and document_id is not null and chunk_index is not null").groupBy("document_id", "chunk_index").agg(F.min_by("text", "id").alias("text"))
    rows = rows.withColumn("v", embed("text"))
    piece = F.struct("chunk_index", F.struct("text", F.col("text").alias("contextual_text"), F.lit("{}").alias("metadata")).alias("c"), F.coalesce("v", F.array(F.lit(0.0).cast("float"))).alias("v"))
    sets = rows.groupBy("document_id").agg(F.array_sort(F.collect_list(piece)).alias("z"))
    docs = _docs(spark, d).where("path is not null").select("path", "doc_id", "filename", "file_size", "last_modified", "chunks_file_path")
    newest = docs.join(sets, docs["doc_id"] == sets["document_id"]).groupBy("path").agg(F.max_by(F.struct("doc_id", "filename", "file_size", "last_modified", "chunks_file_path", "z"), "doc_id").alias("r"))
    rows = newest.select(F.col("path").alias("doc_path"), "r.*")
    return rows.select("doc_path", "doc_id", "filename", "file_size", "last_modified", "chunks_file_path", F.transform("z", lambda x: x["c"]).alias("chunks"), F.transform("z", lambda x: x["v"]).alias("vectors"), F.lit("2031-06-01").cast("timestamp").alias("embedded_at"))


def _loaded_twice(spark, d):
    """A store that got all paths but those of every tenth document (the ones of every eleventh in error), and then all paths again
    with what is new for every seventh."""
    from docmill.store import Store

    store = Store(spark, new_folder(spark, "store"))
    incoming = written(_incoming(spark, d), "incoming")
    broken = incoming.withColumn("vectors", F.when(F.col("doc_id") % 11 == 0, F.slice("vectors", 1, F.size("vectors") - 1)).otherwise(F.col("vectors")))
    load(store, broken.where("doc_id % 10 <> 0").drop("doc_id"), DEFAULT_MODEL, now=F.lit("2031-07-01").cast("timestamp"))
    newer = broken.withColumn("embedded_at", F.when(F.col("doc_id") % 7 == 0, F.lit("2031-08-01").cast("timestamp")).otherwise(F.col("embedded_at")))
    newer = newer.withColumn("chunks", F.when(F.col("doc_id") % 7 == 0, F.transform("chunks", lambda c: c.withField("text", F.concat(c["text"], F.lit("!"))))).otherwise(F.col("chunks")))
    return store, load(store, newer.drop("doc_id"), DEFAULT_MODEL, now=F.lit("2031-09-01").cast("timestamp"))


@query("load_store", f"""WITH {_LOADED}, t AS (SELECT c.document_id, md5(string_agg(c.text || '!', chr(10) ORDER BY c.chunk_index)) AS digest FROM c GROUP BY c.document_id)
SELECT i.path, i.n AS chunks, i.n AS vectors, CASE WHEN i.doc_id % 7 = 0 THEN t.digest ELSE i.digest END AS digest, CASE WHEN i.doc_id % 7 = 0 OR i.doc_id % 10 = 0 THEN '2031-09-01' ELSE '2031-07-01' END AS updated
FROM i JOIN t ON t.document_id = i.doc_id WHERE i.doc_id % 11 <> 0""")
def load_store(spark, d):
    """Two loads of all documents end to end: what the store holds of every path."""
    store, _ = _loaded_twice(spark, d)
    chunks = store.table("chunks").join(store.table("embeddings").select(F.col("chunk_id").alias("id"), F.lit(1).alias("has")), "id", "left")
    held = chunks.groupBy(F.col("document_id").alias("id")).agg(F.count("*").alias("chunks"), F.count("has").alias("vectors"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "text"))), lambda x: x["text"]), "\n")).alias("digest"))
    return store.table("documents").join(held, "id").select("path", "chunks", "vectors", "digest", F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))


@query("change_deltas", f"""WITH {_LOADED}, x AS (SELECT * FROM i WHERE doc_id % 10 = 0 AND doc_id % 11 <> 0), g AS (SELECT count(*) AS given FROM i), w AS (SELECT count(*) AS bad FROM i WHERE doc_id % 11 = 0)
SELECT 3 AS id, (SELECT count(*) FROM x) AS documents_added, 0 AS documents_deleted, (SELECT coalesce(sum(n), 0) FROM x) AS chunks_added, 0 AS chunks_deleted, (SELECT coalesce(sum(n), 0) FROM x) AS embeddings_added, 0 AS embeddings_deleted,
'Loaded ' || (given - bad) || ' files with model hashing-384' || CASE WHEN bad > 0 THEN ' (' || bad || ' errors)' ELSE '' END AS notes FROM g, w""")
def change_deltas(spark, d):
    """The change row that a load writes."""
    store, _ = _loaded_twice(spark, d)
    return store.table("schema_changes").where("id = 3").select("id", *[c for c in store.table("schema_changes").columns if c.endswith(("_added", "_deleted")) and c != "embedding_models_added"], "notes")


@query("status_report", f"""WITH {_LOADED}, x AS (SELECT * FROM i WHERE doc_id % 11 <> 0)
SELECT 'documents' AS fact, CAST(count(*) AS VARCHAR) AS value FROM x UNION ALL SELECT 'chunks', CAST(sum(n) AS VARCHAR) FROM x UNION ALL SELECT 'embeddings', CAST(sum(n) AS VARCHAR) FROM x UNION ALL SELECT 'models', '1'
UNION ALL SELECT 'hashing-384', CAST(sum(n) AS VARCHAR) FROM x UNION ALL SELECT 'change', '1' UNION ALL SELECT 'change', '2' UNION ALL SELECT 'change', '3'
UNION ALL SELECT 'recent', path FROM (SELECT path FROM x ORDER BY (doc_id % 7 = 0 OR doc_id % 10 = 0) DESC, path LIMIT 5)""")
def status_report(spark, d):
    """What the status of a loaded store says."""
    store, _ = _loaded_twice(spark, d)
    found = status.status(store)
    rows = found["totals"].select(F.explode(F.array(*[F.struct(F.lit(n).alias("fact"), F.col(n).cast("string").alias("value")) for n in ("documents", "chunks", "embeddings", "models")])).alias("x")).select("x.*")
    rows = rows.unionByName(found["models"].select(F.col("name").alias("fact"), F.col("embeddings").cast("string").alias("value")))
    rows = rows.unionByName(found["changes"].select(F.lit("change").alias("fact"), F.col("id").cast("string").alias("value")))
    return rows.unionByName(found["documents"].select(F.lit("recent").alias("fact"), F.col("path").alias("value")))


@query("stats_totals", "SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM chunks) AS chunks, (SELECT count(*) FROM chunk_embeddings) AS embeddings, (SELECT count(*) FROM models) AS models")
def stats_totals(spark, d):
    return status.totals(_docs(spark, d), table(spark, d, "chunks"), table(spark, d, "chunk_embeddings"), table(spark, d, "models"))


@query("stats_by_model", "SELECT m.name, m.dimensions, m.provider, count(e.id) AS embeddings FROM models m LEFT JOIN chunk_embeddings e ON e.model = m.id GROUP BY m.id, m.name, m.dimensions, m.provider")
def stats_by_model(spark, d):
    return status.by_model(table(spark, d, "models"), table(spark, d, "chunk_embeddings"))


@query("manifest", "SELECT DISTINCT path FROM documents WHERE path IS NOT NULL ORDER BY path")
def manifest(spark, d):
    return status.manifest(_docs(spark, d))


@query("recent_documents", "SELECT path, doc_id FROM (SELECT path, max(doc_id) AS doc_id, arg_max({u: updated_at}, doc_id).u AS updated_at FROM documents WHERE path IS NOT NULL GROUP BY path) ORDER BY updated_at DESC NULLS LAST, path LIMIT 5")
def recent_documents(spark, d):
    rows = _docs(spark, d).where("path is not null").groupBy("path").agg(F.max("doc_id").alias("doc_id"), F.max_by(F.struct("updated_at"), "doc_id").alias("s"))
    return status.recent_documents(rows.select("path", "doc_id", F.col("s.updated_at").alias("updated_at"))).select("path", "doc_id")


@query("run_log", """SELECT run_id, chr(10) || 'Update #' || run_id || ':' || chr(10) || '  Timestamp      : ' || coalesce(strftime(min(started_at), '%Y-%m-%d %H:%M'), 'Unknown') || chr(10) || '  Tool           : loader'
|| CASE WHEN run_id % 3 > 0 THEN chr(10) || '  Documents added: ' || run_id % 3 ELSE '' END || CASE WHEN run_id % 2 > 0 THEN chr(10) || '  Embeds deleted : ' || run_id % 2 ELSE '' END
|| CASE WHEN bool_or(status = 'completed') THEN chr(10) || '  Models added   : a, b' || chr(10) || '  Notes          : completed' ELSE '' END AS line FROM load_runs GROUP BY run_id""")
def run_log(spark, d):
    """Runs as rows of the change log, shown as the status shows them."""
    rows = table(spark, d, "load_runs").groupBy("run_id").agg(F.min("started_at").alias("changed_at"), F.max(F.col("status") == "completed").alias("ok"))
    none = F.lit(0)
    log = rows.select(
        F.col("run_id").alias("id"), "changed_at", F.lit("loader").alias("changed_by_tool"), F.lit("").alias("changed_by_version"), F.lit(None).cast("string").alias("changed_by_user"), (F.col("run_id") % 3).alias("documents_added"), none.alias("documents_deleted"),
        none.alias("chunks_added"), none.alias("chunks_deleted"), none.alias("embeddings_added"), (F.col("run_id") % 2).alias("embeddings_deleted"), F.when(F.col("ok"), F.array(F.lit("a"), F.lit("b"))).alias("embedding_models_added"), F.when(F.col("ok"), "completed").alias("notes"),
    )
    return log.select(F.col("id").alias("run_id"), status.change_text().alias("line"))


def _stages(spark, d):
    h = _hashes(spark, d)
    sources = _docs(spark, d).select(F.col("doc_id").cast("string").alias("doc_path"), "doc_id").join(h, "doc_id", "left").select("doc_path", F.col("hash").alias("source_hash"), "doc_id")
    counts = table(spark, d, "chunks").groupBy(F.col("document_id").alias("doc_id")).agg(F.countDistinct("id").cast("int").alias("chunk_count"))
    chunked = sources.join(counts, "doc_id").select("doc_path", F.when(F.col("doc_id") % 7 == 0, "old").otherwise(F.col("source_hash")).alias("source_hash"), F.col("doc_path").alias("chunks_hash"), "chunk_count")
    ids = table(spark, d, "chunks").select(F.col("id").alias("chunk_id"), "document_id").distinct()
    embedded = table(spark, d, "chunk_embeddings").where("model = 1").join(ids, "chunk_id").select(F.col("document_id").cast("string").alias("doc_path")).distinct().join(sources.select("doc_path"), "doc_path", "left_semi")
    embedded = embedded.select("doc_path", F.lit("m").alias("model"), F.when(F.col("doc_path").cast("bigint") % 9 == 0, "old").otherwise(F.col("doc_path")).alias("chunks_hash"))
    meta = table(spark, d, "meta").groupBy("doc_id").agg(F.max("metadata_version").alias("metadata_version")).select(F.col("doc_id").cast("string").alias("doc_path"), "metadata_version").join(sources.select("doc_path"), "doc_path", "left_semi")
    return sources.drop("doc_id"), chunked, embedded, meta


_AUDIT = f"""
h AS ({_HASHES}), s AS (SELECT d.doc_id, h.hash FROM documents d LEFT JOIN h ON h.doc_id = d.doc_id),
c AS (SELECT document_id AS doc_id, count(DISTINCT id) AS n FROM chunks WHERE document_id IN (SELECT doc_id FROM documents) GROUP BY document_id),
e AS (SELECT DISTINCT document_id AS doc_id FROM chunks WHERE document_id IN (SELECT doc_id FROM documents) AND id IN (SELECT chunk_id FROM chunk_embeddings WHERE model = 1)),
m AS (SELECT doc_id, max(metadata_version) AS v FROM meta WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY doc_id),
a AS (SELECT s.doc_id, s.hash, c.doc_id IS NOT NULL AS has_c, e.doc_id IS NOT NULL AS has_e, m.doc_id IS NOT NULL AS has_m, m.v FROM s LEFT JOIN c ON c.doc_id = s.doc_id LEFT JOIN e ON e.doc_id = s.doc_id LEFT JOIN m ON m.doc_id = s.doc_id),
k AS (
  SELECT doc_id, CASE WHEN NOT has_c THEN 'missing chunks' WHEN (CASE WHEN doc_id % 7 = 0 THEN 'old' ELSE hash END) IS DISTINCT FROM hash THEN 'stale chunks' END AS kind FROM a
  UNION ALL SELECT doc_id, CASE WHEN has_c AND NOT has_e THEN 'missing embeddings' WHEN has_c AND has_e AND doc_id % 9 = 0 THEN 'stale embeddings' END FROM a
  UNION ALL SELECT doc_id, CASE WHEN NOT has_m THEN 'missing metadata' WHEN v IS NULL THEN 'invalid metadata' WHEN v <> '1.0' THEN 'metadata version' END FROM a)
"""


@query("audit_messages", f"WITH {_AUDIT} SELECT CAST(doc_id AS VARCHAR) AS doc_path, kind FROM k WHERE kind IS NOT NULL")
def audit_messages(spark, d):
    return status.audit_messages(*_stages(spark, d), model="m")


@query("audit_summary", f"WITH {_AUDIT} SELECT (SELECT count(*) FROM s) AS sources, (SELECT count(*) FROM c) AS chunks, (SELECT count(*) FROM e) AS embeddings, (SELECT count(*) FROM m) AS metadata, count(*) FILTER (kind = 'missing chunks') AS missing_chunks, count(*) FILTER (kind = 'stale chunks') AS stale_chunks, count(*) FILTER (kind = 'stale embeddings') AS stale_embeddings, false AS passed FROM k")
def audit_summary(spark, d):
    stages = _stages(spark, d)
    row = status.audit_summary(*stages, status.audit_messages(*stages, model="m"), model="m")
    return row.select("sources", "chunks", "embeddings", "metadata", "missing_chunks", "stale_chunks", "stale_embeddings", "passed")


@query("audit_passed", "SELECT count(*) AS sources, count(*) FILTER (doc_id % 5 <> 0) AS chunks, count(*) FILTER (doc_id % 5 = 0) AS zero_chunks, count(*) FILTER (doc_id % 5 <> 0) AS embeddings, count(*) AS metadata, 2 AS unknown_file, 0 AS orphan_folder, true AS passed FROM documents")
def audit_passed(spark, d):
    """Stages that agree: the audit passes, whatever unknown files lie about."""
    sources = _docs(spark, d).select(F.col("doc_id").cast("string").alias("doc_path"), F.col("path").alias("source_hash"), "doc_id")
    chunked = sources.select("doc_path", "source_hash", F.col("doc_path").alias("chunks_hash"), F.when(F.col("doc_id") % 5 == 0, 0).otherwise(3).alias("chunk_count"))
    embedded = chunked.where("chunk_count > 0").select("doc_path", F.lit("m").alias("model"), "chunks_hash")
    meta = sources.select("doc_path", F.lit("1.0").alias("metadata_version"))
    others = spark.createDataFrame([("1", "notes.txt"), ("2", "x.tmp")], "doc_path string, file string")
    stages = sources.drop("doc_id"), chunked, embedded, meta
    messages_ = status.audit_messages(*stages, model="m", others=others, folders=sources.select(F.col("doc_path").alias("folder")))
    row = status.audit_summary(*stages, messages_, model="m")
    return row.select("sources", "chunks", "zero_chunks", "embeddings", "metadata", "unknown_file", "orphan_folder", "passed")


_BOOLS = "('true'), ('F'), ('Yes'), ('n'), ('1'), ('0'), ('None'), (NULL)"


@query("settings_parse", f"SELECT t, CASE WHEN lower(t) IN ('true', 't', 'yes', 'y', '1') THEN true WHEN lower(t) IN ('false', 'f', 'no', 'n', '0') THEN false END AS value, coalesce(lower(t) = 'none', false) AS clear FROM (VALUES {_BOOLS}) v(t)")
def settings_parse(spark, d):
    rows = spark.sql(f"SELECT t FROM VALUES {_BOOLS} AS v(t)")
    return rows.select("t", tx.parse_bool("t").alias("p")).select("t", "p.value", "p.clear")


_SETTINGS = "(1, 5, '10'), (2, 5, 'none'), (3, 5, NULL), (4, NULL, ' 7 '), (5, NULL, NULL)"


@query("settings_merge", f"SELECT id, CASE WHEN lower(t) = 'none' THEN NULL ELSE coalesce(CAST(CASE WHEN lower(t) <> 'none' THEN trim(t) END AS INT), old) END AS value FROM (VALUES {_SETTINGS}) v(id, old, t)")
def settings_merge(spark, d):
    rows = spark.sql(f"SELECT id, old, t FROM VALUES {_SETTINGS} AS v(id, old, t)")
    return rows.select("id", "old", tx.parse_number("t").alias("p")).select("id", status.merged(F.col("old"), F.col("p")).alias("value"))


def _content_sums(store) -> dict[str, tuple]:
    """Of every table the number of rows and the sum of their hashes over all columns."""
    out = {}
    for name in TABLES:
        rows = store.table(name)
        out[name] = tuple(rows.agg(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first())
    return out


@query("dump_roundtrip", "SELECT provider, count(*) AS models, sum(dimensions) AS dimensions FROM models GROUP BY provider")
def dump_roundtrip(spark, d):
    """A store of all test tables, dumped and restored; counts and content sums of every table must agree."""
    from docmill.errors import StoreError
    from docmill.store import Store

    store = Store(spark, new_folder(spark, "store"))
    store.initialize(now=_now())
    documents = _docs(spark, d).withColumn("id", F.col("doc_id"))
    chunks = spread(table(spark, d, "chunks")).withColumn("text_search_vector", ts.search_vector("contextual_text"))
    store.commit({"documents": documents, "chunks": chunks, "embeddings": spread(table(spark, d, "chunk_embeddings")), "models": table(spark, d, "models")})
    bundle = new_folder(spark, "bundle")
    store.dump(bundle)
    other = Store(spark, new_folder(spark, "store"))
    other.restore(bundle)
    if (before := _content_sums(store)) != (after := _content_sums(other)):
        raise StoreError(f"the restored store differs: {before} and {after}")
    return other.table("models").groupBy("provider").agg(F.count("*").alias("models"), F.sum("dimensions").alias("dimensions"))


@query("stream_documents", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def stream_documents(spark, d):
    """Documents read as a stream of files, of which every fifth comes twice, and counted from what the stream delivered."""
    from docmill.streaming.ingest import delivered, stream_documents

    columns = ["doc_id", "source", "updated_at"]
    out = new_folder(spark, "streamed")
    rows = spark.readStream.schema(_docs(spark, d).schema).option("pathGlobFilter", "*.parquet").parquet(_stream_folder(d)).select(*columns)
    twice = rows.withColumn("again", F.explode(F.sequence(F.lit(0), F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0)))).drop("again")
    stream_documents(twice, out, checkpoint=f"{out}/_log").awaitTermination()
    return delivered(spark, out, twice.schema).groupBy("source").agg(F.count("*").alias("n"))


def _stream_folder(d: str) -> str:
    import os

    path = f"{d}/documents.parquet"
    return path if os.path.isdir(path) else f"{d}/documents[.]parquet"


# -- full text and hybrid search

_STOP = ", ".join(f"'{w}'" for w in sorted(ts.STOP_WORDS))
_TERMS = rf"""
t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+')) AS term FROM documents),
i AS (SELECT term, doc_id, count(*) AS tf FROM t WHERE term <> '' AND term NOT IN ({_STOP}) GROUP BY term, doc_id),
z AS (SELECT doc_id, sum(tf) AS size FROM i GROUP BY doc_id), n AS (SELECT count(*) AS docs, avg(size) AS mean FROM z)"""
WORDS = ["turbine", "battery", "checksum"]


@query("document_terms", f"WITH {_TERMS} SELECT term, count(*) AS docs, sum(tf) AS total FROM i GROUP BY term")
def document_terms(spark, d):
    index = ts.inverted_index(spread(_docs(spark, d).select("doc_id", "text")), key="doc_id", text="text")
    return index.groupBy("term").agg(F.count("*").alias("docs"), F.sum("tf").alias("total"))


@query("search_vectors")
def search_vectors(spark, d):
    return _one_text(spark, d).select("id", ts.search_vector("contextual_text").alias("text_search_vector"))


def _one_text(spark, d) -> DataFrame:
    """One contextual text of every chunk id; texts move once, by id."""
    return table(spark, d, "chunks").groupBy("id").agg(F.min("contextual_text").alias("contextual_text"))


@query("fts_match", r"""SELECT id FROM (SELECT id, lower(min(contextual_text)) AS t FROM chunks GROUP BY id)
WHERE regexp_matches(t, '(^|[^\p{L}\p{N}])(battery|batteries)([^\p{L}\p{N}]|$)') AND regexp_matches(t, '(^|[^\p{L}\p{N}])(reject|rejects|rejected|rejecting|rejection|rejections|column|columns)([^\p{L}\p{N}]|$)')""")
def fts_match(spark, d):
    """Texts with every lexeme of one of two questions."""
    v = ts.search_vector("contextual_text")
    rows = _one_text(spark, d).select("id", v.alias("v"))
    return rows.where(ts.matches("v", "batteries rejecting") | ts.matches("v", "battery columns")).select("id")


#: Words and their published stems.
_STEMS = "caresses caress flies fli dying die agreed agre owned own meeting meet hopping hop hoping hope traditional tradit reference refer colonizer colon relational relat happy happi generous generous communism communism knightly knight".split()


@query("lexeme_stems", "SELECT * FROM (VALUES " + ", ".join(f"('the {w}, and {w}', '{s}', 2, 4)" for w, s in zip(_STEMS[::2], _STEMS[1::2])) + ") v(body, lexeme, first, second)")
def lexeme_stems(spark, d):
    """Text-search vectors of texts whose lexemes and positions are known; stop words count as positions."""
    rows = spark.createDataFrame([(f"the {w}, and {w}",) for w in _STEMS[::2]], "body string")
    return rows.select("body", F.explode(ts.search_vector("body")).alias("x")).select("body", "x.lexeme", F.col("x.positions")[0].alias("first"), F.col("x.positions")[1].alias("second"))


_BM25 = f"""WITH {_TERMS}, f AS (SELECT term, count(*) AS df FROM i WHERE term IN ('turbine', 'battery', 'checksum') GROUP BY term),
s AS (SELECT i.doc_id, sum(ln(1 + (n.docs - f.df + 0.5) / (f.df + 0.5)) * i.tf * 2.2 / (i.tf + 1.2 * (0.25 + 0.75 * z.size / n.mean))) AS score FROM i JOIN f ON f.term = i.term JOIN z ON z.doc_id = i.doc_id, n GROUP BY i.doc_id)"""


@query("bm25", _BM25 + " SELECT doc_id, round(score, 6) AS score FROM s")
def bm25(spark, d):
    return ts.bm25_scan(spread(_docs(spark, d).select("doc_id", "text")), WORDS, key="doc_id", text="text").select("doc_id", F.round("score", 6).alias("score"))


@query("hybrid_rrf", _BM25.replace("WITH", f"WITH {_QUERY},", 1) + f""",
a AS (SELECT doc_id AS key, row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS r FROM s QUALIFY r <= 50),
b AS (SELECT vec_id AS key, row_number() OVER (ORDER BY round({_COSINE}, 6) DESC, vec_id) AS r FROM embeddings e, q QUALIFY r <= 50)
SELECT coalesce(a.key, b.key) AS key, round(coalesce(1.0 / (60 + a.r), 0) + coalesce(1.0 / (60 + b.r), 0), 6) AS rrf_score FROM a FULL JOIN b ON a.key = b.key""")
def hybrid_rrf(spark, d):
    """Two top-50 lists fused: BM25 over documents, cosine over vectors (ids stand for each other in the test data)."""

    def ranked(rows: DataFrame, key: str, score: str) -> DataFrame:
        top = rows.select(F.col(key).alias("key"), F.round(score, 6).alias("score")).orderBy(F.desc("score"), "key").limit(50)
        return top.groupBy().agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "key"))).alias("l")).select(F.posexplode("l").alias("n", "x")).select("x.key", (F.col("n") + 1).alias("rank"))

    words = ranked(ts.bm25_scan(spread(_docs(spark, d).select("doc_id", "text")), WORDS, key="doc_id", text="text"), "doc_id", "score")
    vectors = ranked(vx.top_k(table(spark, d, "embeddings"), _query_vector(spark, d), 60, key="vec_id"), "vec_id", "similarity")
    return ts.reciprocal_rank_fusion(words, vectors, key="key").select("key", F.round("rrf_score", 6).alias("rrf_score"))


#: The question of ``search_passages``: its lexemes and the forms that the test texts have of them.
_QUESTION = "turbines, battery and checksums"
_FORMS = {"turbin": ["turbine", "turbines"], "batteri": ["battery", "batteries"], "checksum": ["checksum", "checksums"]}
_IN = " ".join(f"WHEN word IN ({', '.join(repr(w) for w in words)}) THEN '{lexeme}'" for lexeme, words in _FORMS.items())


@query("search_passages", rf"""WITH m AS (SELECT dimensions AS dims FROM models WHERE id = 1),
c AS (SELECT id, min(document_id) AS document_id, min(chunk_index) AS chunk_index, min(text) AS text, min(contextual_text) AS t FROM chunks WHERE text IS NOT NULL GROUP BY id),
v AS (SELECT chunk_id, embedding::DOUBLE[] AS v FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY created_at DESC, id DESC) AS n FROM chunk_embeddings, m WHERE model = 1 AND len(embedding) = dims AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0) WHERE n = 1),
q AS (SELECT v AS q FROM v ORDER BY chunk_id LIMIT 1), s AS (SELECT chunk_id, round(list_cosine_similarity(v, q), 9) AS similarity FROM v, q),
a AS (SELECT chunk_id, similarity, row_number() OVER (ORDER BY similarity DESC, chunk_id) AS r FROM s WHERE similarity >= 0.1 QUALIFY r <= 100),
w AS (SELECT id, unnest(regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+')) AS word FROM c WHERE t IS NOT NULL),
z AS (SELECT id, count(*) AS size FROM w WHERE word NOT IN ({_STOP}) GROUP BY id), n AS (SELECT count(*) AS docs, avg(size) AS mean FROM z),
i AS (SELECT id, lexeme, count(*) AS tf FROM (SELECT id, CASE {_IN} END AS lexeme FROM w) WHERE lexeme IS NOT NULL GROUP BY id, lexeme), f AS (SELECT lexeme, count(*) AS df FROM i GROUP BY lexeme),
b AS (SELECT i.id AS chunk_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 9) AS bm25 FROM i JOIN f ON f.lexeme = i.lexeme JOIN z ON z.id = i.id, n GROUP BY i.id),
br AS (SELECT chunk_id, bm25, row_number() OVER (ORDER BY bm25 DESC, chunk_id) AS r FROM b QUALIFY r <= 100),
u AS (SELECT coalesce(a.chunk_id, br.chunk_id) AS id, coalesce(1.0 / (60 + a.r), 0) + coalesce(1.0 / (60 + br.r), 0) AS score, similarity, bm25 FROM a FULL JOIN br ON a.chunk_id = br.chunk_id),
j AS (SELECT u.*, c.chunk_index, c.text, d.path FROM u JOIN c ON c.id = u.id JOIN documents d ON d.doc_id = c.document_id),
k AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS n FROM j QUALIFY n <= 25), l AS (SELECT *, sum(floor(length(text) / 3.0)) OVER (ORDER BY score DESC, id) AS tokens FROM k)
SELECT path AS document_path, chunk_index, round(similarity, 6) AS similarity, round(bm25, 6) AS bm25, round(score, 6) AS rrf_score FROM l WHERE tokens <= 6000""")
def search_passages(spark, d):
    """A question put to a store of all chunks and vectors, under stored settings."""
    from docmill.operators.retrieval import search
    from docmill.store import Store

    store = Store(spark, new_folder(spark, "store"))
    store.initialize(now=_now())
    dims = table(spark, d, "models").where("id = 1").first().dimensions
    chunks = table(spark, d, "chunks").where("text is not null").groupBy("id").agg(*[F.min(c).alias(c) for c in ("document_id", "chunk_index", "text", "contextual_text")])
    usable = (F.size("embedding") == dims) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)) & F.exists("embedding", lambda v: v != 0)
    vectors = table(spark, d, "chunk_embeddings").where("model = 1").where(usable).groupBy("chunk_id", "model").agg(F.max_by("embedding", F.struct("created_at", "id")).alias("embedding"), F.max("id").alias("id"))
    model = spark.range(1).select(F.lit(1).alias("id"), F.lit(DEFAULT_MODEL).alias("name"), F.lit(dims).alias("dimensions"), F.lit("table").alias("provider"), F.lit(None).alias("description"), _now().alias("created_at"))
    store.commit({
        "documents": _docs(spark, d).withColumn("id", F.col("doc_id")), "models": model, "embeddings": vectors.withColumn("created_at", _now()),
        "chunks": chunks.withColumn("metadata", F.lit("{}")).withColumn("text_search_vector", ts.search_vector("contextual_text")).withColumn("created_at", _now()),
    })
    status.configure(store, max_chunks="25", max_tokens_in_context="6000", similarity_threshold="0.1")
    first = store.table("embeddings").orderBy("chunk_id").select("embedding").first()[0]
    found = search(store, _QUESTION, encode=lambda questions: [first for _ in questions])
    return found.select("document_path", "chunk_index", *[F.round(c, 6).alias(c) for c in ("similarity", "bm25", "rrf_score")])


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """By language: documents, greedy chunks, mean token estimate, and how many chunks got a vector."""
    docs = _docs(spark, d).select(F.coalesce(F.lower(F.substring_index("lang", "-", 1)), F.lit("und")).alias("lang"), "doc_id", "text")
    chunks = docs.select("lang", "doc_id", F.explode_outer(tx.greedy_chunks("text", MAX_TOKENS)).alias("chunk"))
    rows = chunks.select("lang", "doc_id", tx.estimate_tokens("chunk").alias("tokens"), "chunk", F.size(embed("chunk")).alias("dims"))
    return rows.groupBy("lang").agg(F.countDistinct("doc_id").alias("documents"), F.count("chunk").alias("chunks"), F.round(F.avg("tokens"), 2).alias("mean_tokens"), F.count_if(F.col("dims") > 0).alias("embeddings")).orderBy("lang")
