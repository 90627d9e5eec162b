"""Finding source files and stage rows."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.errors import ContentError
from docmill.functions import text as tx


def find_files(spark: SparkSession, root: str, *, with_content: bool = True) -> DataFrame:
    """(path, relative, modified, size, content) of ingestible files below a folder, or of one file whatever its suffix.

    A single file ingests that file alone. Empty files are not listed (the reader leaves them out). A missing path is an
    error.
    """
    if "://" not in root and not os.path.exists(root):
        raise ContentError(f"no such file or folder: {root}")
    single = os.path.isfile(root)
    reader = spark.read.format("binaryFile") if single else spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    base = os.path.dirname(os.path.abspath(root)) if single else os.path.abspath(root)
    rows = reader.load(root).withColumn("path", F.regexp_replace(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), r"^file:/*", "/"))
    rows = rows if single else rows.where(tx.is_ingestible("path"))
    columns = ["path", F.substring("path", F.lit(len(base) + 2), F.length("path")).alias("relative"), F.col("modificationTime").alias("modified"), F.col("length").alias("size")]
    return rows.select(*columns, *(["content"] if with_content else []))


def in_memory(items: DataFrame, *, name: str, content: str, encoding: str = "utf-8") -> DataFrame:
    """Rows (name, content) as if they had been files: strings become bytes."""
    kind = dict(items.dtypes)[content]
    data = F.encode(content, encoding) if kind == "string" else F.col(content)
    return items.select(F.col(name).alias("path"), F.col(name).alias("relative"), F.lit(None).cast("timestamp").alias("modified"), F.length(data).cast("long").alias("size"), data.alias("content"))


def matching(rows: DataFrame, pattern: str | None, *, column: str = "doc_path") -> DataFrame:
    """Rows whose path matches a folder or glob; no pattern keeps all."""
    if not pattern:
        return rows
    return rows.where(F.col(column).rlike(tx.glob_regex(pattern.rstrip("/"))))


def leaf_folders(paths: DataFrame, *, column: str = "path") -> DataFrame:
    """Folders that hold no other folder, from file paths: folders minus the parents of folders."""
    folders = paths.select(F.regexp_extract(column, r"^(.*)/[^/]*$", 1).alias("folder")).where("folder <> ''").distinct()
    parts = F.split("folder", "/")
    parents = folders.where(F.size(parts) > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("folder")).distinct()
    return folders.join(parents, "folder", "left_anti")


def collisions(paths: DataFrame, *, column: str = "path") -> DataFrame:
    """(content_path, files): content paths that several sources share (same stem, other suffix)."""
    return paths.select(tx.content_path(column).alias("content_path")).groupBy("content_path").agg(F.count("*").alias("files")).where("files > 1")
