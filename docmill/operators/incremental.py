"""Only new or changed records, run by run, with state that survives failures (problem 2).

State is one row per key: the newest version seen and the content hash that was processed last. A commit writes what it
has to say only, its results and its part of the state, into new folders and then one manifest that names all folders
that count (:mod:`docmill.pointer`). A run that dies before that leaves the old manifest in force: nothing is skipped,
nothing is handed out twice. Of two runs at the same time the second to commit fails and its folders do not count.
Beyond a few, parts are merged by size (a part that is not twice as large as the next one is merged with it), so there are
about as many as the logarithm of the state's size and a record is rewritten as often, whatever the number of commits.

One call may catch up on several runs: arrivals are first reduced to the newest row of each (key, run), by a
partial aggregate, so a key that holds a third of all rows shuffles one row per task and run. Then each key has
at most as many rows as runs in the call, and the join with the state and the window per key stay small.

Defined results. A null hash differs from everything. Null keys form one key of their own. A row without a
version time is older than any row with one; ties go to the greater ``row_id``; repeated rows count once. Empty
arrivals commit an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docmill.pointer import Pointer
from docmill.session import new_folder, written

#: A parsed time is year, month, day, hour, minute, second, fraction, offset (ISO 8601, extended or basic).
_ISO = r"^(\d{4})-?(\d{2})-?(\d{2})[Tt ](\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?\s*([Zz]|[+-]\d{2}(?::?\d{2})?)?$"
#: Runs handled between two commits when a backlog is replayed.
RUNS_PER_COMMIT = 16
#: Runs up to which their starts are literals, and folders of results that are not merged.
TREE, PARTS = 256, 8
#: Parts of the state that are not merged.
STATE_PARTS = 4


def readable_time(text: Column) -> Column:
    """ISO 8601 with or without separators, with an offset or in UTC, or whole epoch seconds; else null."""
    t = F.trim(text)
    part = lambda n: F.regexp_extract(t, _ISO, n)
    offset = part(8)
    zone = (
        F.when((offset == "") | (F.upper(offset) == "Z"), F.lit("+00:00"))
        .when(F.length(offset) == 3, F.concat(offset, F.lit(":00")))
        .otherwise(F.concat(F.substring(offset, 1, 3), F.lit(":"), F.right(offset, F.lit(2))))
    )
    second = F.when(part(6) == "", F.lit("00")).otherwise(part(6))
    fraction = F.rpad(F.substring(part(7), 1, 6), 6, "0")
    iso = F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit(" "), part(4), F.lit(":"), part(5), F.lit(":"), second, F.lit("."), fraction, zone)
    epoch = F.when(t.rlike(r"^-?\d{1,11}$"), F.timestamp_seconds(t.try_cast("bigint")))
    return F.when(t.rlike(_ISO), iso.try_cast("timestamp")).otherwise(epoch)


def content_hash(columns: Sequence[str]) -> Column:
    """A 64-bit change key of several columns; nulls and empty strings differ."""
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])


class ChangeState:
    """Versioned key and hash state in a folder."""

    SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("newest", T.StructType([
        T.StructField("version", T.TimestampType()), T.StructField("row_id", T.LongType()), T.StructField("hash", T.StringType())]))])

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.pointer = Pointer(spark, self.root)
        self.pointer.make_folder()

    RESULTS = "run long, key string, row_id long"

    def _manifest(self) -> tuple[int, dict]:
        number, text = self.pointer.latest()
        return number, json.loads(text) if text else {"state": [], "cases": []}

    def current(self) -> int:
        """The number of the last commit; 0 before the first."""
        return self.pointer.latest()[0]

    def _read(self, parts: list, schema) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{folder}" for folder, _ in parts])

    def state(self) -> DataFrame:
        """The committed state: key, newest(version, row_id, hash)."""
        return self._newest(self._manifest()[1]["state"])

    def _newest(self, parts: list) -> DataFrame:
        rows = self._read(parts, self.SCHEMA)
        return rows if len(parts) < 2 else rows.groupBy("key").agg(F.max("newest").alias("newest"))

    def results(self) -> DataFrame:
        """What all committed runs got: run, key, row_id."""
        return self._read(self._manifest()[1]["cases"], self.RESULTS)

    def _added(self, parts: list, kind: str, rows: DataFrame, combine) -> tuple[list, list]:
        """The parts with one more, merged by size, and the folders that leave."""
        def put(frame: DataFrame) -> list:
            folder = f"{kind}/{uuid.uuid4().hex}"
            frame.write.parquet(f"{self.root}/{folder}")
            return [folder, self.spark.read.parquet(f"{self.root}/{folder}").count()]

        parts, gone = [*parts, put(rows)], []
        while len(parts) > STATE_PARTS and parts[-2][1] <= 2 * parts[-1][1]:
            pair, parts = parts[-2:], parts[:-2]
            gone += [folder for folder, _ in pair]
            parts.append(put(combine(pair)))
        return parts, gone

    def process(self, newest: DataFrame) -> DataFrame:
        """One commit. ``newest``: run (order number), key, newest struct, unique by (run, key).

        Joins the arrivals with the state, selects per run what is new or changed, writes results and the state's
        next part, then commits. Returns the results of this commit.
        """
        number, manifest = self._manifest()
        kept = self._newest(manifest["state"])
        before = kept.withColumnRenamed("newest", "kept").withColumnRenamed("key", "state_key")
        joined = newest.join(before, newest["key"].eqNullSafe(before["state_key"]), "left").drop("state_key")
        by_key = Window.partitionBy("key").orderBy("run")
        earlier = F.max("newest").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
        rows = joined.withColumn("previous", F.when(earlier.isNull() | (F.col("kept") > earlier), F.col("kept")).otherwise(earlier))
        arrived = F.col("previous").isNull() | (F.col("newest") > F.col("previous"))
        # comparing structs puts hash last, so a repeated row (same version, row_id) must not count by its hash
        same_row = F.col("newest.version").eqNullSafe(F.col("previous.version")) & F.col("newest.row_id").eqNullSafe(F.col("previous.row_id"))
        differs = F.col("previous").isNull() | F.coalesce(F.col("newest.hash") != F.col("previous.hash"), F.lit(True))
        cases = rows.where(arrived & ~F.coalesce(same_row, F.lit(False)) & differs).select(F.col("run").cast("long").alias("run"), "key", F.col("newest.row_id").alias("row_id"))
        folder = f"cases/{uuid.uuid4().hex}"
        cases.write.parquet(f"{self.root}/{folder}")
        made = self.spark.read.schema(self.RESULTS).parquet(f"{self.root}/{folder}")
        state, left = self._added(manifest["state"], "state", newest.groupBy("key").agg(F.max("newest").alias("newest")), self._newest)
        found = [*manifest["cases"], [folder, made.count()]]
        while len(found) > 1 and found[-2][1] <= 2 * found[-1][1] and len(found) > PARTS:
            merged = f"cases/{uuid.uuid4().hex}"
            self._read(found[-2:], self.RESULTS).write.parquet(f"{self.root}/{merged}")
            left += [f for f, _ in found[-2:] if f != folder]  # this commit's own results stay readable
            found = [*found[:-2], [merged, found[-2][1] + found[-1][1]]]
        self.pointer.swap(json.dumps({"state": state, "cases": found, "left": left}), number)
        for old in manifest.get("left", []):  # what left one commit ago: no reader of the last one needs it
            self.pointer.delete(f"{self.root}/{old}")
        return made


def first_run_at(time: Column, starts: list[tuple[int, object]]) -> Column:
    """The order number of the first run that starts at or after ``time``; null beyond the last.

    ``starts`` (number, time), rising. Few of them become a balanced decision tree of literals, which is generated code;
    more are searched by halving in Arrow batches. Neither needs a join.
    """
    if not starts:
        return F.lit(None).cast("int")

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(starts[lo][0]) if lo < len(starts) else F.lit(None).cast("int")
        mid = (lo + hi) // 2
        return F.when(time <= F.lit(starts[mid][1]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    if len(starts) <= TREE:
        return F.when(time.isNotNull(), tree(0, len(starts)))
    epoch = datetime(1970, 1, 1)
    at = np.array([(t - epoch) // timedelta(microseconds=1) for _, t in starts], np.int64)
    number = np.array([n for n, _ in starts] + [-1], np.int64)

    @F.pandas_udf("int")
    def search(micros: pd.Series) -> pd.Series:
        there = micros.notna().to_numpy()
        found = number[np.searchsorted(at, micros.fillna(0).to_numpy(np.int64), "left")]
        return pd.Series(found).astype("Int32").where((found >= 0) & there, None)

    return search(F.unix_micros(time))


def successful_runs(load_runs: DataFrame, limit: int = 100_000) -> list[tuple[int, object]]:
    """(run_id, started_at) of runs with a ``completed`` row, by start. The list of runs is small by nature; a
    list of over ``limit`` is refused rather than cut."""
    rows = (
        load_runs.groupBy("run_id").agg(F.min("started_at").alias("started_at"), F.max((F.col("status") == "completed").cast("int")).alias("done"))
        .where((F.col("done") == 1) & F.col("started_at").isNotNull()).orderBy("started_at", "run_id").limit(limit + 1).collect()
    )
    if len(rows) > limit:
        raise ValueError(f"over {limit} successful runs")
    return [(r.run_id, r.started_at) for r in rows]


def replay(documents: DataFrame, meta: DataFrame, load_runs: DataFrame, *, root: str | None = None, runs_per_commit: int = RUNS_PER_COMMIT) -> DataFrame:
    """(run_id, doc_id) of what each successful run has to process.

    A document is seen by the first successful run that starts at or after its earliest readable ingested_at;
    only the newest version of a path counts in a run. Documents and meta meet once, by doc_id, on narrow
    columns; what is left (one row per path and run) is written to the shared folder by commit, and each commit
    reads only its own part and the state.
    """
    spark = documents.sparkSession
    runs = successful_runs(load_runs)
    state = ChangeState(spark, root or new_folder(spark, "changes"))
    numbered = [(n, start) for n, (_, start) in enumerate(runs)]
    seen = meta.where(meta["doc_id"].isNotNull()).groupBy("doc_id").agg(F.min(readable_time(F.col("processing.ingested_at"))).alias("ingested"), F.max("processing.source_hash").alias("hash"))
    rows = documents.select("doc_id", "path", F.coalesce("updated_at", "last_modified").alias("version")).join(seen.where(F.col("ingested").isNotNull()), "doc_id")
    newest = F.struct(F.col("version").alias("version"), F.col("doc_id").alias("row_id"), F.col("hash").alias("hash"))
    arrivals = (
        rows.withColumn("run", first_run_at(F.col("ingested"), numbered)).where(F.col("run").isNotNull())
        .groupBy("run", F.col("path").alias("key")).agg(F.max(newest).alias("newest"))
        .withColumn("part", F.floor(F.col("run") / runs_per_commit).cast("int"))
    )
    parts = written(arrivals, "arrivals", partition_by=["part"])
    for part in range(-(-len(runs) // runs_per_commit)):
        state.process(parts.where(F.col("part") == part).select("run", "key", "newest"))
    names = spark.createDataFrame([(n, r) for n, (r, _) in enumerate(runs)], "run long, run_id long")  # as many rows as runs
    return state.results().join(F.broadcast(names), "run").select("run_id", F.col("row_id").alias("doc_id"))


def process_changed(state: ChangeState, rows: DataFrame, *, key: str, row_id: str, version: str, hash_column: str | None = None, hash_of: Sequence[str] = (), run: int = 0) -> DataFrame:
    """One ordinary run: hash the current rows, select what is new or changed against the state, commit."""
    digest = F.col(hash_column).cast("string") if hash_column else content_hash(hash_of).cast("string")
    newest = F.struct(F.col(version).cast("timestamp").alias("version"), F.col(row_id).cast("long").alias("row_id"), digest.alias("hash"))
    arrivals = rows.groupBy(F.lit(run).alias("run"), F.col(key).cast("string").alias("key")).agg(F.max(newest).alias("newest"))
    return state.process(arrivals)
