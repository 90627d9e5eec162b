"""The retrieval store: seven tables as parquet snapshots, the three large ones in buckets of documents.

A bucket holds the documents whose path hashes to it with all their chunks and vectors, so what a load touches is known
from the incoming paths, and only those buckets are read and written; the others keep their folders. A commit names all
folders that count in one small file, which only one of several writers can add (:mod:`docmill.pointer`). Readers see
the old or the new snapshot, never a mixture, and a job that dies leaves the old one in force. Ids go on from the highest
ones ever given, which the manifest keeps.

A table that was committed whole (a restored bundle, for one) has no buckets until ``bucketed`` gives it some.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill import __version__, schemas
from docmill.errors import ConflictError, StoreError
from docmill.pointer import Pointer

TOOL = "docmill"


#: Tables in buckets, and the number of buckets of a new store.
BUCKETED, BUCKETS = ("documents", "chunks", "embeddings"), 16
ALL = "all"


def bucket_of(path: Column | str, buckets: int) -> Column:
    """The bucket of a document's path."""
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.pointer = Pointer(spark, self.root, "MANIFEST.json")

    # -- snapshots
    def manifest(self) -> dict:
        text = self.pointer.read()
        if text is None:
            raise StoreError(f"no store at {self.root}")
        return json.loads(text)

    def exists(self) -> bool:
        return self.pointer.exists()

    def table(self, name: str, buckets: list[int] | None = None, *, marked: bool = False) -> DataFrame:
        """A table, or those of its ``buckets``; ``marked`` adds the bucket as ``_bucket``."""
        if name not in schemas.TABLES:
            raise StoreError(f"no table {name}")
        folders = self.manifest()["tables"].get(name)
        if folders is None:
            raise StoreError(f"the table {name} is missing")
        wanted = [f for k, f in folders.items() if k == ALL or buckets is None or int(k) in set(buckets)]
        if not wanted:
            empty = self.spark.createDataFrame([], schemas.TABLES[name])
            return empty.withColumn("_bucket", F.lit(0)) if marked else empty
        rows = self.spark.read.schema(schemas.TABLES[name]).parquet(*[f"{self.root}/{f}" for f in wanted])
        return rows.withColumn("_bucket", F.regexp_extract("_metadata.file_path", r"_bucket=(\d+)", 1).cast("int")) if marked else rows

    def stage(self, name: str, df: DataFrame) -> tuple[str, DataFrame]:
        """Writes rows with ``_bucket`` into a new folder that no snapshot names yet; returns it and the rows as read back."""
        folder = f"data/{name}-{uuid.uuid4().hex}"
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[name].fields]
        df.select(*columns, "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        schema = T.StructType([*schemas.TABLES[name].fields, T.StructField("_bucket", T.IntegerType())])
        return folder, self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")

    def commit(self, tables: dict[str, DataFrame], *, staged: dict[str, str] | None = None, buckets: list[int] | None = None, max_ids: dict[str, int] | None = None, after: int | None = None) -> int:
        """Makes the given tables, written whole, and the ``staged`` folders of the given buckets current together."""
        number, text = self.pointer.latest()
        if after is not None and after != number:
            raise ConflictError(f"{self.root}: the store has changed since it was read")
        old = json.loads(text) if text else {"version": 0, "tables": {}, "buckets": BUCKETS, "max_ids": {}}
        version = old["version"] + 1
        folders = {name: dict(f) for name, f in old["tables"].items()}
        top = dict(old.get("max_ids", {}))
        for name, df in tables.items():
            folder = f"data/{name}-{uuid.uuid4().hex}"
            columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[name].fields]
            df.select(*columns).write.parquet(f"{self.root}/{folder}")
            folders[name] = {ALL: folder}
            if name in BUCKETED:
                top[name] = max(top.get(name, 0), self.table_max(folder, name))
        for name, folder in (staged or {}).items():
            folders[name].pop(ALL, None)
            for b in buckets:
                folders[name].pop(str(b), None)
            for status in self.pointer.fs.listStatus(self.pointer.path(f"{self.root}/{folder}")):
                part = status.getPath().getName()
                if part.startswith("_bucket="):
                    folders[name][part.removeprefix("_bucket=")] = f"{folder}/{part}"
        for name, n in (max_ids or {}).items():
            top[name] = max(top.get(name, 0), n)
        manifest = {"version": version, "schema_version": schemas.DB_SCHEMA_VERSION, "buckets": old.get("buckets", BUCKETS), "max_ids": top, "tables": folders, "before": old["tables"]}
        self.pointer.swap(json.dumps(manifest), number)
        named = {f for t in (folders, old["tables"]) for fs in t.values() for f in fs.values()}
        for fs in old.get("before", {}).values():  # two snapshots back: no reader of the last one needs it
            for folder in set(fs.values()) - named:
                self.pointer.delete(f"{self.root}/{folder}")
        return version

    def table_max(self, folder: str, name: str) -> int:
        return self.spark.read.schema(schemas.TABLES[name]).parquet(f"{self.root}/{folder}").agg(F.max("id")).first()[0] or 0

    def bucketed(self) -> int:
        """Divides tables that were committed whole into the store's buckets; returns the number of buckets."""
        number, text = self.pointer.latest()
        manifest = json.loads(text)
        n = manifest["buckets"]
        if not any(ALL in manifest["tables"][name] for name in BUCKETED):
            return n
        documents = self.table("documents").withColumn("_bucket", bucket_of("path", n))
        chunks = self.table("chunks").join(documents.select(F.col("id").alias("document_id"), "_bucket"), "document_id", "left").withColumn("_bucket", F.coalesce("_bucket", F.lit(0)))
        vectors = self.table("embeddings").join(chunks.select(F.col("id").alias("chunk_id"), "_bucket"), "chunk_id", "left").withColumn("_bucket", F.coalesce("_bucket", F.lit(0)))
        staged = {name: self.stage(name, rows)[0] for name, rows in zip(BUCKETED, (documents, chunks, vectors))}
        self.commit({}, staged=staged, buckets=list(range(n)), after=number)
        return n

    def initialize(self, *, now=None, user: str | None = None, buckets: int = BUCKETS) -> bool:
        """Creates the tables, the metadata row and the first change row, unless they exist. ``buckets``: as many as let
        one of them fit a few tasks (thousands for very large stores)."""
        if self.exists():
            return False
        now = now if now is not None else F.current_timestamp()
        empty = {n: self.spark.createDataFrame([], s) for n, s in schemas.TABLES.items()}
        one = self.spark.range(1)
        empty["schema_metadata"] = one.select(F.lit(1).alias("id"), F.lit(None).alias("title"), F.lit(None).alias("description"), F.lit(schemas.DB_SCHEMA_VERSION).alias("schema_version"), F.lit(0).alias("embedding_models_count"), now.alias("last_modified_at"))
        empty["schema_changes"] = _change(one, 1, now, user=user, notes="Database initialized")
        self._first(empty, buckets)
        return True

    def _first(self, tables: dict[str, DataFrame], buckets: int) -> None:
        folders = {}
        for name, df in tables.items():
            folders[name] = {}
            if name not in BUCKETED:
                folders[name][ALL] = f"data/{name}-{uuid.uuid4().hex}"
                df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[name].fields]).write.parquet(f"{self.root}/{folders[name][ALL]}")
        self.pointer.swap(json.dumps({"version": 1, "schema_version": schemas.DB_SCHEMA_VERSION, "buckets": buckets, "max_ids": {}, "tables": folders, "before": {}}), 0)

    def drop(self, *, confirm: bool = False) -> None:
        if not confirm:
            raise StoreError("dropping a store needs confirm=True")
        self.pointer.delete(self.root)

    def size(self) -> int:
        return sum(self.pointer.size(f"{self.root}/{f}") for fs in self.manifest()["tables"].values() for f in fs.values())

    # -- dump and restore
    def dump(self, target: str) -> dict[str, int]:
        """A portable bundle: the tables as parquet and a manifest with their row counts."""
        counts = {}
        out = Pointer(self.spark, target, "MANIFEST.json")
        for name in schemas.TABLES:
            df = self.table(name)
            df.write.mode("overwrite").parquet(f"{target}/{name}")
            counts[name] = self.spark.read.parquet(f"{target}/{name}").count()
        out.make_folder()
        out.swap(json.dumps({"schema_version": schemas.DB_SCHEMA_VERSION, "rows": counts}))
        return counts

    def restore(self, source: str) -> dict[str, int]:
        """Replaces the store by a bundle, after checking its tables and row counts."""
        text = Pointer(self.spark, source, "MANIFEST.json").read()
        if text is None:
            raise StoreError(f"no bundle at {source}")
        manifest = json.loads(text)
        tables = {}
        for name, rows in manifest["rows"].items():
            tables[name] = self.spark.read.schema(schemas.TABLES[name]).parquet(f"{source}/{name}")
            if (found := tables[name].count()) != rows:
                raise StoreError(f"{name}: the bundle names {rows} rows and holds {found}")
        if set(tables) != set(schemas.TABLES):
            raise StoreError("the bundle lacks tables")
        self.commit(tables)
        return manifest["rows"]


def _change(one: DataFrame, number: int, now, *, user: str | None = None, deltas: dict[str, int] | None = None, models: list[str] | None = None, notes: str | None = None) -> DataFrame:
    d = deltas or {}
    return one.select(
        F.lit(number).cast("long").alias("id"), now.alias("changed_at"), F.lit(TOOL).alias("changed_by_tool"), F.lit(__version__).alias("changed_by_version"), F.lit(user).cast("string").alias("changed_by_user"),
        *[F.lit(d.get(c, 0)).alias(c) for c in ("documents_added", "documents_deleted", "chunks_added", "chunks_deleted", "embeddings_added", "embeddings_deleted")],
        F.lit(None).cast("array<string>").alias("embedding_models_added") if not models else F.array(*map(F.lit, models)).alias("embedding_models_added"),
        F.lit(schemas.DB_SCHEMA_VERSION).alias("schema_version"), F.lit(notes).cast("string").alias("notes"),
    )


def with_change(store: Store, now, **change) -> DataFrame:
    """The change log with one more row."""
    log = store.table("schema_changes")
    number = (log.agg(F.max("id")).first()[0] or 0) + 1
    return log.unionByName(_change(store.spark.range(1), number, now, **change))


def with_metadata(store: Store, now, **values) -> DataFrame:
    """The metadata row with the given non-null values."""
    row = store.table("schema_metadata")
    columns = [F.coalesce(F.lit(values.get(c)).cast(row.schema[c].dataType), F.col(c)).alias(c) if c in values else (now.alias(c) if c == "last_modified_at" else F.col(c)) for c in row.columns]
    return row.select(*columns)
