"""Which rows of a stage have to be made again: null-safe comparisons as columns, joined once per stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def differs(a: Column | str, b: Column | str) -> Column:
    """Null-safe inequality."""
    return ~_c(a).eqNullSafe(_c(b))


def ingestion_stale(source_time: Column | str, content_time: Column | str) -> Column:
    """Missing content, an unreadable time, or a source newer than its content."""
    return _c(content_time).isNull() | _c(source_time).isNull() | (_c(source_time) > _c(content_time))


def needs_update(*, exists: Column, has_meta: Column, given_time: Column | None = None, stored_time: Column | None = None, given_hash: Column | None = None, stored_hash: Column | None = None) -> Column:
    """Whether a document has to be ingested again, in this order: no document yes; nothing to compare no; no metadata
    yes; a given time that is not stored or differs yes; a given hash that is not stored or differs yes; else no.
    Times are compared as the strings they are stored as."""
    none = F.lit(None).cast("string")
    gt, st = given_time if given_time is not None else none, stored_time if stored_time is not None else none
    gh, sh = given_hash if given_hash is not None else none, stored_hash if stored_hash is not None else none
    return (
        F.when(~exists, True).when(gt.isNull() & gh.isNull(), False).when(~has_meta, True)
        .when(gt.isNotNull() & (st.isNull() | (st != gt)), True).when(gh.isNotNull() & (sh.isNull() | (sh != gh)), True).otherwise(False)
    )


def chunks_stale(source_hash: Column | str, stored_hash: Column | str, parameters: Column | str, stored_parameters: Column | str, exists: Column) -> Column:
    """No chunks, another source hash, or other chunking parameters."""
    return ~exists | differs(source_hash, stored_hash) | differs(parameters, stored_parameters)


def embeddings_stale(chunks_hash: Column | str, stored_hash: Column | str, model: Column | str, stored_model: Column | str, dimensions: Column | str, stored_dimensions: Column | str, exists: Column) -> Column:
    """No embeddings, or embeddings of other chunks, another model or other dimensions."""
    return ~exists | differs(chunks_hash, stored_hash) | differs(model, stored_model) | differs(dimensions, stored_dimensions)


def work_list(current: DataFrame, stored: DataFrame, keys: list[str], compared: list[str], *, force: bool = False, failed: Column | None = None) -> DataFrame:
    """Rows of ``current`` with no row of the same keys in ``stored`` or with one that differs in ``compared``. Stored rows
    that ``failed`` do not count, so what failed is made again by every run until it succeeds. Keys are unique in what counts."""
    if force:
        return current
    if failed is not None:
        stored = stored.where(~F.coalesce(failed, F.lit(False)))
    old = stored.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_old_{c}") for c in compared], F.lit(True).alias("_there"))
    same = [current[k].eqNullSafe(old[f"_k_{k}"]) for k in keys]
    stale = F.col("_there").isNull()
    for c in compared:
        stale = stale | differs(c, f"_old_{c}")
    return current.join(old, same, "left").where(stale).select(*[current[c] for c in current.columns])


def load_skip(documents: DataFrame, chunks: DataFrame, embeddings: DataFrame, incoming: DataFrame, model_id: int) -> DataFrame:
    """(path, loaded_at, skip) of incoming (path, embedded_at): skipped if the path's newest vector under the model is at
    least as new as the incoming one."""
    loaded = (
        documents.select(F.col("id").alias("document_id"), "path").join(chunks.select("document_id", F.col("id").alias("chunk_id")), "document_id")
        .join(embeddings.where(F.col("model") == model_id).select("chunk_id", "created_at"), "chunk_id").groupBy("path").agg(F.max("created_at").alias("loaded_at"))
    )
    return incoming.join(loaded, "path", "left").select("path", "embedded_at", "loaded_at", F.coalesce(F.col("loaded_at") >= F.col("embedded_at"), F.lit(False)).alias("skip"))
