"""The stages from files to the store: each is a table in the content folder, made again only where it is stale.

Stage tables (``ingested``, ``chunked``, ``embedded``) are versions behind a pointer, like the store: a stage writes
kept and new rows into the next version and swaps. The JSON content tree of other tools can be exported and read.

What fails becomes an error row beside the last good row of the same document, which stays in force; every run tries it
again until it succeeds. A stage that has nothing new to say, errors included, writes nothing.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill import schemas
from docmill.errors import ContentError
from docmill.functions import text as tx
from docmill.functions.hashing import content_hash
from docmill.load import LoadResult, load
from docmill.operators.chunking import ChunkParameters, chunk_documents, chunks_hash
from docmill.operators.embedding import DEFAULT_MODEL, embed_chunks, model_info
from docmill.operators.staleness import work_list
from docmill.pointer import Pointer
from docmill.session import written
from docmill.sources.discovery import find_files, in_memory, matching
from docmill.sources.extract import PARSER_VERSION, extract
from docmill.store import Store

INGESTED = "doc_path string, filename string, file_size long, last_modified timestamp, source_hash string, title string, blocks array<struct<kind:string,level:int,text:string,page:int>>, meta string, error string"
CHUNKED = "doc_path string, filename string, file_size long, last_modified timestamp, source_hash string, parameters string, chunks array<struct<text:string,contextual_text:string,metadata:string>>, chunk_count int, chunks_hash string, chunks_file_path string, enrichment string, failed_contexts int, error string"
EMBEDDED = "doc_path string, model string, dimensions int, chunk_index int, vector array<float>, chunks_hash string, embedded_at timestamp"
#: Error of a source whose path another one of the same stem has.
_TAKEN = "ContentError: its path belongs to "
_README = "# Content folder\n\nStage tables of docmill; they are made again from the sources where they are stale.\n"


@dataclass
class StageResult:
    made: int
    kept: int
    errors: int


class Content:
    """The content folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointer(self, stage: str) -> Pointer:
        return Pointer(self.spark, f"{self.root}/{stage}")

    def read(self, stage: str, schema: str) -> DataFrame:
        folder = self._pointer(stage).read()
        if folder is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{stage}/{folder}")

    def replace(self, stage: str, rows: DataFrame) -> None:
        """The next version of a stage; if another run has made one since, this one does not count."""
        pointer = self._pointer(stage)
        number, _ = pointer.latest()
        folder = f"v{number + 1}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.root}/{stage}/{folder}")
        pointer.swap(folder, number)
        for f in pointer.fs.listStatus(pointer.path(pointer.folder)):  # the version before stays for its readers
            name = f.getPath().getName()
            if (m := re.match(r"v(\d+)-", name)) and int(m[1]) < number:
                pointer.delete(f"{pointer.folder}/{name}")

    def ensure_readme(self) -> None:
        """Written once, never overwritten; on local folders only."""
        if "://" not in self.root:
            os.makedirs(self.root, exist_ok=True)
            path = os.path.join(self.root, "README.md")
            if not os.path.exists(path):
                with open(path, "w") as f:
                    f.write(_README)


def meta_json(*, ingested_at: Column, source_hash: Column, original_path: Column, size: Column, modified: Column, mime: Column, title: Column, language: Column | None = None, source: Column | None = None, parser: Column | None = None) -> Column:
    """Sparse metadata as JSON: sections without a value are left out."""
    content = F.when(title.isNotNull() | (language.isNotNull() if language is not None else F.lit(False)), F.struct(title.alias("title"), (language if language is not None else F.lit(None).cast("string")).alias("language")))
    parts = [
        F.lit(schemas.METADATA_SCHEMA_VERSION).alias("metadata_version"), F.struct(ingested_at.alias("ingested_at"), source_hash.alias("source_hash"), *([parser.alias("parser_version")] if parser is not None else [])).alias("processing"),
        F.when(original_path.isNotNull(), F.struct(original_path.alias("original_path"), size.alias("size_bytes"), modified.alias("mtime"), mime.alias("detected_mime"))).alias("filesystem"), content.alias("content"),
    ]
    if source is not None:
        parts.append(F.when(F.size(source) > 0, source).alias("source"))
    return F.to_json(F.struct(*parts))


def _merge(content: Content, stage: str, old: DataFrame, new: DataFrame, keys: list[str], lost: DataFrame | None = None) -> None:
    """Stores ``new``: a good row replaces all rows of its keys, an error only an older error. Rows of ``lost`` (keys) go."""
    kept = old.join(new.where("error is null").select(*keys).distinct(), keys, "left_anti")
    failed = new.where("error is not null").select(*keys).distinct()
    kept = kept.where("error is null").unionByName(kept.where("error is not null").join(failed, keys, "left_anti"))
    if lost is not None:
        kept = kept.join(lost.distinct(), keys, "left_anti")
    content.replace(stage, kept.select(*old.columns).unionByName(new.select(*old.columns)))


def _news(rows: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """The rows without the errors that are stored as they are."""
    same = [*keys, "source_hash", "error"]
    known = old.where("error is not null").select(*[F.col(c).alias(f"_{c}") for c in same])
    return rows.join(known, [rows[c].eqNullSafe(known[f"_{c}"]) for c in same], "left_anti")


def ingest(spark: SparkSession, source: str, content: Content, *, metadata: dict[str, str] | None = None, force: bool = False, dry_run: bool = False, now: Column | None = None) -> StageResult | DataFrame:
    """Parses new or changed source files. ``dry_run`` returns the work list. ``metadata``: of the user, kept with each."""
    return ingest_frame(content, find_files(spark, source), complete=os.path.isdir(source) or "://" in source, metadata=metadata, force=force, dry_run=dry_run, now=now)


def ingest_from_content(content: Content, body: str | bytes, path: str, stream_name: str, *, metadata: dict[str, str] | None = None, encoding: str = "utf-8", now: Column | None = None) -> StageResult:
    """One document from memory: ``path`` is where it lies, ``stream_name`` ends in the suffix that names its format."""
    data = body.encode(encoding) if isinstance(body, str) else bytes(body)
    ending = os.path.splitext(stream_name)[1]
    if not ending:
        raise ContentError(f"the stream name has no suffix: {stream_name}")
    items = content.spark.createDataFrame([(path.rstrip("/") + ending, bytearray(data))], "name string, content binary")
    return ingest_frame(content, in_memory(items, name="name", content="content"), metadata=metadata, now=now)


def _judged(files: DataFrame, old: DataFrame, complete: bool) -> tuple[DataFrame, DataFrame]:
    """The files with ``held``, null for the one source that has its path and an error for the others; and the stored
    sources that lose their path to one of them."""
    first = files.groupBy("doc_path").agg(F.min(F.struct("name", "path", "modified", "source_hash")).alias("first"))
    stored = old.where(F.col("error").isNull() | ~F.col("error").startswith(_TAKEN))
    first = first.join(stored.select("doc_path", F.col("filename").alias("stored") if not complete else F.lit(None).cast("string").alias("stored")).distinct(), "doc_path", "left")
    first = written(first.withColumn("holder", F.least("first.name", "stored")), "paths")
    rows = files.join(first, "doc_path")
    same = (F.col("name") == F.col("first.name")) & (F.col("source_hash") == F.col("first.source_hash"))
    rows = rows.withColumn("held", F.when(~same | (F.col("holder") != F.col("name")), F.concat(F.lit(_TAKEN), "holder")))
    exact = F.col("path").eqNullSafe(F.col("first.path")) & F.col("modified").eqNullSafe(F.col("first.modified"))
    rows = rows.where(F.col("held").isNotNull() | exact).select(*files.columns, "held")
    lost = stored.join(first.where("stored <> holder").select("doc_path", "holder"), "doc_path")
    given = files.select("doc_path", F.col("name").alias("filename")).distinct()
    return rows, lost.join(given, ["doc_path", "filename"], "left_anti")


def ingest_frame(content: Content, files: DataFrame, *, complete: bool = False, metadata: dict[str, str] | None = None, force: bool = False, dry_run: bool = False, now: Column | None = None) -> StageResult | DataFrame:
    """The same for rows of (path, relative, modified, size, content).

    Sources of one stem share a path. It belongs to the first of them by name (then by path, time and hash); each other
    one is an error row. ``complete``: the files are all there are; without it a stored source counts among them.
    """
    content.ensure_readme()
    now = now if now is not None else F.current_timestamp()
    hashed = files.withColumn("source_hash", content_hash("content")).withColumn("doc_path", tx.content_path("relative")).withColumn("name", F.regexp_extract("relative", r"([^/]+)$", 1))
    old = content.read("ingested", INGESTED)
    judged, lost = _judged(hashed.select("doc_path", "name", "source_hash", "path", "modified", "size", "content"), old, complete)
    keys = ["doc_path", "name", "source_hash", "held"]
    held = F.when(F.col("error").startswith(_TAKEN), F.col("error")).alias("held")
    parse_failed = F.col("error").isNotNull() & ~F.col("error").startswith(_TAKEN)
    stored = old.where(~parse_failed).select("doc_path", F.col("filename").alias("name"), "source_hash", held).distinct()
    todo = work_list(judged, stored, keys, [], force=force)
    if dry_run:
        return todo.where("held is null").select("doc_path", "path", "size")
    parsed = extract(todo.where("held is null").drop("held"), name="name")
    taken = todo.where("held is not null").drop("content").withColumn("title", F.lit(None).cast("string")).withColumn("blocks", F.lit(None).cast(parsed.schema["blocks"].dataType)).withColumnRenamed("held", "error")
    parsed = parsed.unionByName(taken)
    meta = meta_json(ingested_at=tx.iso_utc(now), source_hash=F.col("source_hash"), original_path=F.col("path"), size=F.col("size"), modified=tx.iso_utc("modified"), mime=tx.guessed_type("name"), title=F.col("title"), parser=F.lit(PARSER_VERSION), source=F.create_map(*[F.lit(x).cast("string") for pair in metadata.items() for x in pair]) if metadata else None)
    rows = parsed.select("doc_path", F.col("name").alias("filename"), F.col("size").alias("file_size"), F.col("modified").alias("last_modified"), "source_hash", "title", "blocks", meta.alias("meta"), "error")
    lost = lost.withColumn("error", F.concat(F.lit(_TAKEN), "holder")).withColumn("title", F.lit(None).cast("string")).withColumn("blocks", F.lit(None).cast(rows.schema["blocks"].dataType))
    rows = written(rows.dropDuplicates(["doc_path", "filename", "source_hash"]).unionByName(lost.select(*rows.columns)), "ingested")
    made, errors = rows.count(), rows.where("error is not null").count()
    before = old.count()
    same = ["doc_path", "filename"]
    # what gives its path up: a good row whose source another one of the stem replaces, a name that is no longer there
    gone = rows.where(F.col("error").startswith(_TAKEN)).select(*same)
    if complete:
        names = written(judged.select("doc_path", F.col("name").alias("filename")).distinct(), "names")
        gone = gone.union(old.select(*same).join(names.select("doc_path").distinct(), "doc_path").join(names, same, "left_anti").select(*same))
    gone = written(gone.distinct(), "gone")
    news = _news(rows, old, same)
    if not news.isEmpty() or not old.join(gone, same, "left_semi").join(rows.where("error is not null").select(*same), same, "left_anti").isEmpty():
        _merge(content, "ingested", old, rows, same, gone)
    return StageResult(made - errors, before, errors)


def generate_chunks(content: Content, *, pattern: str | None = None, parameters: ChunkParameters = ChunkParameters(), provider=None, force: bool = False, dry_run: bool = False) -> StageResult | DataFrame:
    """Chunks of ingested documents whose source or parameters changed, what makes the contexts among them."""
    sources = matching(content.read("ingested", INGESTED).where("error is null"), pattern)
    if pattern and sources.isEmpty():
        raise ContentError(f"nothing matches {pattern}")
    record: dict = {}
    if provider is not None:
        record = provider.description() if hasattr(provider, "description") else {"provider": getattr(provider, "__name__", type(provider).__name__)}
        parameters = replace(parameters, contexts=json.dumps(record, sort_keys=True))
    old = content.read("chunked", CHUNKED)
    current = sources.withColumn("parameters", F.lit(parameters.as_json()))
    failed = F.col("error").isNotNull() | (F.col("failed_contexts") > 0)
    todo = work_list(current, old.select("doc_path", "source_hash", "parameters", "error", "failed_contexts"), ["doc_path"], ["source_hash", "parameters"], force=force, failed=failed)
    if dry_run:
        return todo.select("doc_path")
    made = chunk_documents(todo.select("doc_path", "filename", "file_size", "last_modified", "source_hash", "parameters", "blocks"), parameters, provider=provider)
    facts = [F.lit(v).alias(k) for k, v in sorted(record.items())] + [F.when(F.col("summarized"), F.lit(True)).alias("document_summarized")]
    enrichment = F.to_json(F.struct(*facts)) if record else F.lit(None).cast("string")
    rows = made.select("doc_path", "filename", "file_size", "last_modified", "source_hash", "parameters", "chunks", F.size("chunks").alias("chunk_count"), chunks_hash(F.col("chunks")).alias("chunks_hash"), F.concat("doc_path", F.lit("/chunks.json")).alias("chunks_file_path"), enrichment.alias("enrichment"), "failed_contexts", F.col("chunk_error").alias("error"))
    rows = written(rows, "chunked")
    n, errors = rows.count(), rows.where("error is not null").count()
    if n and not _news(rows, old, ["doc_path"]).isEmpty():
        _merge(content, "chunked", old, rows, ["doc_path"])
    return StageResult(n - errors, old.count(), errors)


def generate_embeddings(content: Content, *, model: str = DEFAULT_MODEL, pattern: str | None = None, force: bool = False, dry_run: bool = False, now: Column | None = None) -> StageResult | DataFrame:
    """Vectors of chunk sets that changed; documents without chunks have none."""
    _, dimensions, _ = model_info(model)
    now = now if now is not None else F.current_timestamp()
    sets = matching(content.read("chunked", CHUNKED).where("error is null and chunk_count > 0"), pattern)
    old = content.read("embedded", EMBEDDED)
    current = sets.select("doc_path", "chunks", "chunks_hash", F.lit(model).alias("model"), F.lit(dimensions).alias("dimensions"))
    todo = work_list(current, sets_of(old).select("doc_path", "model", "chunks_hash", "dimensions"), ["doc_path", "model"], ["chunks_hash", "dimensions"], force=force)
    if dry_run:
        return todo.select("doc_path", "model")
    rows = written(embed_chunks(todo, model).withColumn("embedded_at", now), "embedded")
    n = sets_of(rows).count()
    if n:
        content.replace("embedded", old.join(sets_of(rows).select("doc_path", "model"), ["doc_path", "model"], "left_anti").select(*old.columns).unionByName(rows.select(*old.columns)))
    return StageResult(n, sets_of(old).count(), 0)


def sets_of(embedded: DataFrame) -> DataFrame:
    """One row for each document and model that has vectors: that of its first chunk."""
    return embedded.where("chunk_index = 0")


def load_content(content: Content, store: Store, *, model: str = DEFAULT_MODEL, pattern: str | None = None, **settings) -> LoadResult:
    sets = matching(content.read("chunked", CHUNKED).where("error is null"), pattern)
    embedded = content.read("embedded", EMBEDDED).where(F.col("model") == model)
    incoming = sets.join(sets_of(embedded).select("doc_path", "embedded_at"), "doc_path")
    return load(store, incoming, model, vectors=embedded.select("doc_path", "chunk_index", F.col("vector").alias("embedding")), **settings)


def run(spark: SparkSession, source: str, content: Content, store: Store, *, model: str = DEFAULT_MODEL, dump: str | None = None, provider=None, force: bool = False, **facts) -> dict:
    """All stages; stops at the first that fails. ``facts``: title, description, user and note of the load."""
    out: dict = {"ingest": ingest(spark, source, content, force=force), "chunk": generate_chunks(content, provider=provider, force=force), "embed": generate_embeddings(content, model=model, force=force)}
    out["load"] = load_content(content, store, model=model, force=force, **facts)
    if dump:
        out["dump"] = store.dump(dump)
    return out


def export_tree(content: Content, target: str, *, model: str = DEFAULT_MODEL) -> int:
    """The JSON content tree for other tools: one folder per document with source.json, chunks.json, <keyword>.json and
    meta.json, written by the tasks. ``target`` must be a folder all executors share."""
    keyword, dimensions, _ = model_info(model)
    made = datetime.now(UTC).isoformat()
    s = content.read("ingested", INGESTED).where("error is null").select("doc_path", "title", F.to_json("blocks").alias("blocks"), "meta", "source_hash")
    c = content.read("chunked", CHUNKED).where("error is null").select("doc_path", F.to_json("chunks").alias("chunks"), "parameters", "chunks_hash", "enrichment")
    # a file holds all vectors of a document, so here they are gathered
    e = content.read("embedded", EMBEDDED).where(F.col("model") == model).groupBy("doc_path").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "vector"))).alias("v")).select("doc_path", F.to_json(F.transform("v", lambda x: x["vector"])).alias("vectors"))
    rows = s.join(c, "doc_path", "left").join(e, "doc_path", "left")

    def write(batches):
        import pyarrow as pa

        for batch in batches:
            n = 0
            for r in batch.to_pylist():
                folder = os.path.join(target, r["doc_path"])
                os.makedirs(folder, exist_ok=True)
                files = {"source.json": {"name": r["title"], "blocks": json.loads(r["blocks"] or "[]")}, "meta.json": json.loads(r["meta"] or "{}")}
                if r["chunks"]:
                    chunks = json.loads(r["chunks"])
                    processing = {"chunker": schemas.CHUNKER, "parameters": {k: v for k, v in json.loads(r["parameters"]).items() if k not in ("chunker", "contexts")}}
                    if r["enrichment"]:
                        processing["contextual_enrichment"] = json.loads(r["enrichment"])
                    versions = {"database_schema_version": schemas.DB_SCHEMA_VERSION, "chunking_schema_version": schemas.CHUNKING_SCHEMA_VERSION}
                    files["chunks.json"] = {"metadata": {"source_file": f"{r['doc_path']}/source.json", "source_hash": r["source_hash"], **versions, "processing": processing, "created_at": made, "chunk_count": len(chunks)}, "chunks": chunks}
                if r["vectors"]:
                    vectors = json.loads(r["vectors"])
                    files[f"{keyword}.json"] = {"metadata": {"model": model, "dimensions": dimensions, "embedding_schema_version": schemas.EMBEDDING_SCHEMA_VERSION, "chunks_hash": r["chunks_hash"], "count": len(vectors)}, "embeddings": vectors}
                for name, body in files.items():
                    with open(os.path.join(folder, name), "w") as f:
                        json.dump(body, f, ensure_ascii=False)
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def read_tree(spark: SparkSession, root: str, *, model: str = DEFAULT_MODEL) -> DataFrame:
    """Load-ready rows of a JSON content tree: documents that have both chunks.json and the model's file."""
    keyword = model_info(model)[0]
    chunk_kind = "struct<chunks:array<struct<text:string,contextual_text:string,metadata:string>>>"

    def files(name: str) -> DataFrame:
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)
        path = F.regexp_replace(F.regexp_replace(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), r"^file:/*", "/"), rf"/{name}$", "")
        return rows.select(F.substring(path, F.lit(len(os.path.abspath(root)) + 2), F.length(path)).alias("doc_path"), "modificationTime", "length", F.decode("content", "utf-8").alias("body"))

    s = files("source.json").select("doc_path", F.col("length").alias("file_size"), F.col("modificationTime").alias("last_modified"))
    c = files("chunks.json").select("doc_path", F.from_json("body", chunk_kind)["chunks"].alias("chunks"))
    e = files(f"{keyword}.json").select("doc_path", F.from_json("body", "struct<embeddings:array<array<float>>>")["embeddings"].alias("vectors"), F.col("modificationTime").alias("embedded_at"))
    filename = F.regexp_extract("doc_path", r"([^/]+)$", 1)
    return s.join(c, "doc_path").join(e, "doc_path").select("doc_path", filename.alias("filename"), "file_size", "last_modified", F.concat("doc_path", F.lit("/chunks.json")).alias("chunks_file_path"), "chunks", "vectors", "embedded_at")
