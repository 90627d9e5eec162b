"""Files that arrive are ingested by Structured Streaming instead of scanning the folder again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docmill.functions import text as tx
from docmill.pipeline import Content, ingest_frame
from docmill.pointer import Pointer

_BINARY = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, root: str, *, files_per_batch: int = 1000) -> DataFrame:
    """Rows (path, relative, modified, size, content) of new ingestible files."""
    rows = spark.readStream.format("binaryFile").schema(_BINARY).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(root)
    path = F.regexp_replace(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), r"^file:/*", "/")
    base = root.rstrip("/")
    rows = rows.withColumn("path", path).where(tx.is_ingestible("path"))
    return rows.select("path", F.substring("path", F.lit(len(base) + 2), F.length("path")).alias("relative"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content")


def stream_ingest(spark: SparkSession, root: str, content: Content, *, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Ingests what is new; a batch that is run again after a failure changes nothing, since its hashes are known."""
    writer = file_stream(spark, root).writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: ingest_frame(content, df))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_documents(stream: DataFrame, out: str, *, checkpoint: str, keys: tuple[str, ...] = ("doc_id", "updated_at"), available_now: bool = True) -> StreamingQuery:
    """Deliveries of a stream without exact repeats of ``keys``, however late they come, as parquet in ``out/batch=N``.

    Each batch is compared with the keys of all batches before it (null keys are equal), so nothing is dropped for being
    late, as a watermark would. A batch that is run again after a failure replaces its own folder: every delivery is
    there exactly once. Read the result with ``delivered``.
    """

    def keep(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(list(keys))
        before = [f"{out}/batch={k}" for k in _batches(spark, out) if k < n]
        if before:
            seen = spark.read.schema(batch.schema).parquet(*before).select(*[F.col(k).alias(f"_{k}") for k in keys])
            fresh = fresh.join(seen, [fresh[k].eqNullSafe(seen[f"_{k}"]) for k in keys], "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out}/batch={n}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _batches(spark: SparkSession, out: str) -> list[int]:
    files = Pointer(spark, out)
    at = files.path(out)
    if not files.fs.exists(at):
        return []
    names = [f.getPath().getName() for f in files.fs.listStatus(at)]
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def delivered(spark: SparkSession, out: str, schema) -> DataFrame:
    """What a stream of documents has delivered so far."""
    found = [f"{out}/batch={n}" for n in _batches(spark, out)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
