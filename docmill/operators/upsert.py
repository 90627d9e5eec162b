"""INSERT ... ON CONFLICT and DELETE ... CASCADE as joins: set operations over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docmill.session import written


def with_ids(rows: DataFrame, order: list[str], start: int, *, column: str = "id") -> DataFrame:
    """Numbers rows start + 1, start + 2, ... in the given order, without one task seeing them all: range partitions are
    numbered each for itself and shifted by the sizes of those before (one number per partition on the driver)."""
    ranged = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    kept = written(ranged, "numbered")
    sizes = {r["_part"]: r["count"] for r in kept.groupBy("_part").count().collect()}
    shift, total = {}, start
    for part in sorted(sizes):
        shift[part] = total
        total += sizes[part]
    if not sizes:
        return kept.withColumn(column, F.lit(None).cast("long")).drop("_part")
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in shift.items() for x in pair]), F.col("_part"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return kept.withColumn(column, (offset + place).cast("long")).drop("_part")


def upsert(target: DataFrame, incoming: DataFrame, *, keys: list[str], updated: list[str], now: Column | None = None, id_column: str | None = "id", start: int | None = None) -> DataFrame:
    """``target`` after inserting ``incoming``: on equal keys the ``updated`` columns are replaced, everything else (id,
    created_at) stays; new rows get the next ids in key order. Keys must be unique in ``incoming``. Columns that
    ``incoming`` lacks are null in new rows, created_at and updated_at are ``now``. ``start``: the highest id given so far,
    if ``target`` is only part of a table."""
    stamp = now if now is not None else F.current_timestamp()
    same = [target[k].eqNullSafe(incoming[k]) for k in keys]
    marked = incoming.withColumn("_hit", F.lit(True))
    renamed = marked.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in updated if c in incoming.columns], "_hit")
    joined = target.join(renamed, [target[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys], "left")
    hit = F.col("_hit").isNotNull()
    columns = []
    for c in target.columns:
        if c in updated:
            new = F.col(f"_n_{c}") if c in incoming.columns else stamp
            columns.append(F.when(hit, new).otherwise(target[c]).cast(target.schema[c].dataType).alias(c))
        else:
            columns.append(target[c])
    old = joined.select(*columns)
    fresh = incoming.join(target, same, "left_anti")
    for c in target.columns:
        if c not in fresh.columns and c != id_column:
            fresh = fresh.withColumn(c, stamp if c in ("created_at", "updated_at") else F.lit(None))
    if id_column:
        if start is None:
            start = target.agg(F.max(id_column)).first()[0] or 0
        fresh = with_ids(fresh, keys, start, column=id_column)
    return old.unionByName(fresh.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns]))


def insert_missing(target: DataFrame, incoming: DataFrame, *, keys: list[str], now: Column | None = None) -> DataFrame:
    """ON CONFLICT DO NOTHING."""
    return upsert(target, incoming, keys=keys, updated=[], now=now)


def delete_documents(chunks: DataFrame, embeddings: DataFrame, document_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks of the given documents (id) deleted, with their embeddings of all models."""
    doomed = chunks.join(document_ids.select(F.col("id").alias("document_id")), "document_id", "left_semi").select(F.col("id").alias("chunk_id"))
    kept_chunks = chunks.join(document_ids.select(F.col("id").alias("document_id")), "document_id", "left_anti").select(*chunks.columns)
    return kept_chunks, embeddings.join(doomed, "chunk_id", "left_anti").select(*embeddings.columns)
