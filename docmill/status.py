"""Status, statistics, manifest, audit of stages and the retrieval settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill import schemas
from docmill.errors import ConfigurationError, StoreError
from docmill.functions import text as tx
from docmill.store import Store


def counts_row(frames: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each frame: counted apart, put side by side by a last small aggregate."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("k"), "n") for name, df in frames.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.agg(*[F.max(F.when(F.col("k") == name, F.col("n"))).alias(name) for name in frames])


def totals(documents: DataFrame, chunks: DataFrame, embeddings: DataFrame, models: DataFrame) -> DataFrame:
    """One row: documents, chunks, embeddings, models."""
    return counts_row({"documents": documents, "chunks": chunks, "embeddings": embeddings, "models": models})


def by_model(models: DataFrame, embeddings: DataFrame) -> DataFrame:
    """(name, dimensions, provider, embeddings): every model, also without vectors; counted before the join."""
    counts = embeddings.groupBy(F.col("model").alias("id")).agg(F.count("*").alias("n"))
    return models.join(counts, "id", "left").select("name", "dimensions", "provider", F.coalesce("n", F.lit(0)).alias("embeddings"))


def recent_changes(changes: DataFrame, n: int = 5) -> DataFrame:
    return changes.orderBy(F.desc("id")).limit(n)


def recent_documents(documents: DataFrame, n: int = 5) -> DataFrame:
    return documents.orderBy(F.desc_nulls_last("updated_at"), "path").limit(n)


def manifest(documents: DataFrame) -> DataFrame:
    """Distinct paths in order."""
    return documents.select("path").where(F.col("path").isNotNull()).distinct().orderBy("path")


def write_manifest(store: Store, target: str) -> None:
    manifest(store.table("documents")).coalesce(1).write.mode("overwrite").text(target)


#: Labels of a shown change row: fixed values of the display format.
_CHANGE_LABELS = {
    "changed_at": "Timestamp      ",
    "changed_by_user": "User           ",
    "changed_by_version": "Version        ",
    "changed_by_tool": "Tool           ",
    "documents_added": "Documents added",
    "documents_deleted": "Documents deleted",
    "chunks_added": "Chunks added   ",
    "chunks_deleted": "Chunks deleted ",
    "embeddings_added": "Embeds added   ",
    "embeddings_deleted": "Embeds deleted ",
    "embedding_models_added": "Models added   ",
    "notes": "Notes          ",
}


def change_text() -> Column:
    """A change row as text; facts without a value are left out."""
    lines = [F.concat(F.lit("\nUpdate #"), F.col("id").cast("string"), F.lit(":"))]
    for name, label in _CHANGE_LABELS.items():
        c = F.col(name)
        if name == "changed_at":
            shown, there = F.coalesce(tx.shown_time(c), F.lit("Unknown")), F.lit(True)
        elif name == "embedding_models_added":
            shown, there = F.array_join(c, ", "), F.size(c) > 0
        elif name.endswith(("_added", "_deleted")):
            shown, there = c.cast("string"), c > 0
        else:
            shown, there = c, F.length(c) > 0
        lines.append(F.when(there, F.concat(F.lit(f"  {label}: "), shown)))
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def status(store: Store) -> dict:
    """Frames of the store's state; a missing or incomplete store is an error."""
    if not store.exists():
        raise StoreError(f"no store at {store.root}")
    missing = [t for t in schemas.TABLES if t not in store.manifest()["tables"]]
    if missing:
        raise StoreError(f"tables are missing: {', '.join(missing)}")
    t = {n: store.table(n) for n in schemas.TABLES}
    return {
        "totals": totals(t["documents"], t["chunks"], t["embeddings"], t["models"]), "models": by_model(t["models"], t["embeddings"]), "metadata": t["schema_metadata"],
        "changes": recent_changes(t["schema_changes"]), "documents": recent_documents(t["documents"]), "settings": t["rag_settings"], "bytes": store.size(),
    }


def audit_messages(sources: DataFrame, chunk_sets: DataFrame, embed_sets: DataFrame, meta: DataFrame, *, model: str, others: DataFrame | None = None, folders: DataFrame | None = None) -> DataFrame:
    """(doc_path, kind) of what is missing or stale.

    sources: doc_path, source_hash. chunk_sets: doc_path, source_hash, chunks_hash, chunk_count. embed_sets: doc_path,
    model, chunks_hash. meta: doc_path, metadata_version. others: doc_path, file (unknown files). folders: folder.
    """
    c = chunk_sets.select("doc_path", F.col("source_hash").alias("c_source"), "chunks_hash", "chunk_count", F.lit(True).alias("has_c"))
    e = embed_sets.where(F.col("model") == model).select("doc_path", F.col("chunks_hash").alias("e_hash"), F.lit(True).alias("has_e"))
    m = meta.select("doc_path", "metadata_version", F.lit(True).alias("has_m"))
    j = sources.join(c, "doc_path", "left").join(e, "doc_path", "left").join(m, "doc_path", "left")
    kinds = F.array_compact(F.array(
        F.when(F.col("has_c").isNull(), "missing chunks").when(~F.col("c_source").eqNullSafe(F.col("source_hash")), "stale chunks"),
        F.when(F.col("has_c") & (F.col("chunk_count") > 0) & F.col("has_e").isNull(), "missing embeddings").when(F.col("has_c") & F.col("has_e") & ~F.col("e_hash").eqNullSafe(F.col("chunks_hash")), "stale embeddings"),
        F.when(F.col("has_m").isNull(), "missing metadata").when(F.col("metadata_version").isNull(), "invalid metadata").when(F.col("metadata_version") != schemas.METADATA_SCHEMA_VERSION, "metadata version"),
    ))
    out = j.select("doc_path", F.explode(kinds).alias("kind"))
    if others is not None:
        out = out.unionByName(others.select("doc_path", F.lit("unknown file").alias("kind")))
    if folders is not None:
        out = out.unionByName(folders.join(sources.select(F.col("doc_path").alias("folder")), "folder", "left_anti").select(F.col("folder").alias("doc_path"), F.lit("orphan folder").alias("kind")))
    return out


def audit_summary(sources: DataFrame, chunk_sets: DataFrame, embed_sets: DataFrame, meta: DataFrame, messages: DataFrame, *, model: str) -> DataFrame:
    """One row of counters and the verdict. Unknown files are counted and do not fail."""
    kinds = ("missing chunks", "stale chunks", "missing embeddings", "stale embeddings", "missing metadata", "metadata version", "invalid metadata", "unknown file", "orphan folder")
    counts = [
        sources.agg(F.count("*").alias("sources")), chunk_sets.agg(F.count_if(F.col("chunk_count") > 0).alias("chunks"), F.count_if(F.col("chunk_count") == 0).alias("zero_chunks")),
        embed_sets.agg(F.count_if(F.col("model") == model).alias("embeddings")), meta.agg(F.count("*").alias("metadata")), messages.agg(*[F.count_if(F.col("kind") == k).alias(k.replace(" ", "_")) for k in kinds]),
    ]
    rows = counts[0]  # each frame is read once; a row each is put side by side
    for more in counts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    row = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    passed = (F.col("sources") == F.col("chunks") + F.col("zero_chunks")) & (F.col("sources") == F.col("metadata")) & (F.col("embeddings") == F.col("chunks"))
    for k in ("stale chunks", "stale embeddings", "metadata version", "invalid metadata", "orphan folder"):
        passed = passed & (F.col(k.replace(" ", "_")) == 0)
    return row.withColumn("passed", passed)


_PARSERS = {
    "refinement_prompt": tx.parse_prompt, "enable_refinement": tx.parse_bool, "enable_reranking": tx.parse_bool, "similarity_threshold": lambda c: tx.parse_number(c, "double"),
    "max_chunks": tx.parse_number, "max_tokens_in_context": tx.parse_number, "refinement_questions_count": tx.parse_number,
}


def parsed_settings(texts: DataFrame) -> DataFrame:
    """Setting texts (null: not given) to columns of struct(value, clear)."""
    return texts.select(*[(parse(F.col(c)) if c in texts.columns else F.struct(F.lit(None).alias("value"), F.lit(False).alias("clear"))).alias(c) for c, parse in _PARSERS.items()])


def merged(old: Column, new: Column) -> Column:
    """A cleared field is null, a given one is set, the rest stays."""
    return F.when(new["clear"], F.lit(None)).otherwise(F.coalesce(new["value"], old))


def configure(store: Store, **texts: str | None) -> DataFrame:
    """Parses and stores retrieval settings given as text; returns the row."""
    unknown = set(texts) - set(_PARSERS)
    if unknown or not any(v is not None for v in texts.values()):
        raise ConfigurationError(f"unknown settings: {sorted(unknown)}" if unknown else "no setting is given")
    given = store.spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in texts.items()])
    try:
        row = parsed_settings(given).first()
    except Exception as e:
        raise ConfigurationError(str(e).split("\n")[0][:200]) from None
    old = store.table("rag_settings").first()
    values = {c: None if row[c].clear else row[c].value if row[c].value is not None else (old[c] if old else None) for c in _PARSERS}
    kinds = {f.name: f.dataType for f in schemas.RAG_SETTINGS.fields}
    fresh = store.spark.range(1).select(F.lit(1).alias("id"), *[F.lit(values[c]).cast(kinds[c]).alias(c) for c in _PARSERS], F.current_timestamp().alias("updated_at"))
    store.commit({"rag_settings": fresh})
    return store.table("rag_settings")
