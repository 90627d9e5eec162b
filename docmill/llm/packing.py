"""Filling fixed-capacity containers by vector best-fit (problem 7).

A container has three capacities: tokens, documents and attention cost (the sum of the squared sizes). The largest item
that fits alone is the lesser of the token capacity and the root of the attention capacity; a larger document is cut.

Sizes are whole token counts up to the capacity, so the whole corpus is described by how many items there are of
each size: at most ``capacity`` numbers, which is all the driver ever sees. The packing is planned on that
histogram: sizes in falling order, each put where it fits best. A container has three residual capacities (tokens,
documents, attention cost, the sum of squared sizes); among those that can take an item under every constraint the
choice is the one with the least weighted norm of what would remain (``residual``), or with the greatest weighted
dot product of item and residual (``dot``). Containers with equal contents are planned together as one run with a
multiplicity, so planning takes time in the number of distinct sizes and contents, not of documents.

The plan says which ranks of each size go to which containers. Items get their ranks in blocks: a block is a
bounded hash share of one size, counted first, so a size that a third of all documents have is ranked by many
tasks. Everything that moves is narrow (id, piece, size).

Defined results: null and empty texts are in no container; a document that fits a container alone is never divided; a
larger one gives full pieces, each a container of its own, and one rest that is packed like a document. Repeated
rows and null ids are items of their own. Container ids run from 0 without gaps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docmill.session import written

#: Items of one size that one task ranks.
RANK_BLOCK = 200_000


def plan(histogram: dict[int, int], capacity: int, *, documents: int | None = None, attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.25, 0.25), choose: str = "residual") -> tuple[np.ndarray, int]:
    """Rows (size, first rank, end rank, first container, items of this size per container) and the number of
    containers."""
    if choose not in ("residual", "dot"):
        raise ValueError(choose)
    documents = documents or capacity
    attention = attention or capacity * capacity
    full = np.array([capacity, documents, attention], np.int64)
    w = np.array(weights)
    if any(s * s > attention or s > capacity or s < 1 for s in histogram):
        raise ValueError("an item alone exceeds a constraint")
    left = np.zeros((256, 3), np.int64)  # residuals of each run of equal containers
    span = np.zeros((256, 2), np.int64)  # its containers
    runs, containers = 0, 0
    rows: list[tuple[int, int, int, int, int]] = []

    def add(residual: np.ndarray, lo: int, hi: int) -> None:
        nonlocal runs, left, span
        if residual[0] < least or residual[1] < 1 or lo >= hi:
            return  # nothing still to come fits
        if runs == len(left):
            left, span = np.concatenate([left, left * 0]), np.concatenate([span, span * 0])
        left[runs], span[runs] = residual, (lo, hi)
        runs += 1

    least = min(histogram, default=0)
    for size in sorted(histogram, reverse=True):
        demand = np.array([size, 1, size * size], np.int64)
        rank, todo = 0, histogram[size]
        while todo:
            r = left[:runs]
            fits = np.nonzero((r >= demand).all(1))[0]
            if len(fits):
                scaled = (r[fits] - demand * (choose == "residual")) / full
                score = (scaled * scaled) @ w if choose == "residual" else -(scaled @ (w * demand / full))
                at = int(fits[score.argmin()])
                residual, (lo, hi) = left[at].copy(), span[at].copy()
                runs -= 1  # the run is replaced by its parts
                left[at], span[at] = left[runs], span[runs]
            else:
                residual, lo = full.copy(), containers
                per = int((residual // demand).min())
                hi = lo + -(-todo // per)
                containers = hi
            per = int((residual // demand).min()) if choose == "residual" else 1
            used = min(hi - lo, -(-todo // per))
            taken = min(todo, used * per)
            rows.append((size, rank, rank + taken, lo, per))
            whole = taken // per
            add(residual - per * demand, lo, lo + whole)
            if taken % per:
                add(residual - (taken % per) * demand, lo + whole, lo + whole + 1)
            add(residual, lo + used, hi)
            rank, todo = rank + taken, todo - taken
    return np.array(rows, np.int64).reshape(-1, 5), containers


def largest_item(capacity: int, attention: int | None = None) -> int:
    """The most tokens that fit a container alone."""
    return min(capacity, math.isqrt(attention)) if attention else capacity


def lower_bound(histogram: dict[int, int], capacity: int, *, documents: int | None = None, attention: int | None = None) -> int:
    """Fewer containers cannot hold these items."""
    needs = [(sum(s * n for s, n in histogram.items()), capacity), (sum(histogram.values()), documents or capacity), (sum(s * s * n for s, n in histogram.items()), attention or capacity * capacity)]
    return max(-(-need // each) for need, each in needs)


def items_of(sizes: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece, token_start, size): a document over the capacity of one item as full pieces and a rest."""
    n = F.col("n_tokens")
    pieces = F.sequence(F.lit(0), F.floor((n - 1) / capacity).cast("int"))
    rows = sizes.where(n > 0).select("doc_id", n.cast("long").alias("n"), F.explode(pieces).alias("piece"))
    start = F.col("piece").cast("long") * capacity
    return rows.select("doc_id", "piece", start.alias("token_start"), F.least(F.lit(capacity).cast("long"), F.col("n") - start).cast("int").alias("size"))


def pack(sizes: DataFrame, capacity: int, *, rank_block: int = RANK_BLOCK, **constraints) -> DataFrame:
    """(container_id, doc_id, piece, token_start, n_tokens) from ``sizes`` (doc_id, n_tokens)."""
    spark = sizes.sparkSession
    items = written(items_of(sizes, largest_item(capacity, constraints.get("attention"))), "items")
    counts = {r["size"]: r["count"] for r in items.groupBy("size").count().collect()}  # at most capacity rows
    rows, _ = plan(counts, capacity, **constraints)
    order = np.lexsort((rows[:, 1], rows[:, 0])) if len(rows) else np.zeros(0, int)
    shared = spark.sparkContext.broadcast(rows[order])
    blocks = max(1, -(-max(counts.values(), default=0) // rank_block))
    placed = items.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)).cast("int"))
    by_block = Window.partitionBy("size", "block").orderBy("doc_id", "piece")
    ranked = placed.withColumn("n", F.row_number().over(by_block))
    if blocks > 1:
        before = Window.partitionBy("size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = placed.groupBy("size", "block").count().select("size", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip"))
        ranked = ranked.join(offsets, ["size", "block"])
    else:
        ranked = ranked.withColumn("skip", F.lit(0))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        key = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            size = batch.column("size").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            row = table[np.searchsorted(key, (size << 44) + rank, "right") - 1] if len(size) else table[:0]
            container = row[:, 3] + (rank - row[:, 1]) // np.maximum(row[:, 4], 1)
            yield pa.RecordBatch.from_arrays([pa.array(container), *(batch.column(c) for c in ("doc_id", "piece", "token_start", "size"))], ["container_id", "doc_id", "piece", "token_start", "n_tokens"])

    kind = sizes.schema["doc_id"].dataType.simpleString()
    rows_in = ranked.select("doc_id", "piece", "token_start", "size", (F.col("n") - 1 + F.col("skip")).cast("long").alias("rank"))
    return rows_in.mapInArrow(look_up, f"container_id long, doc_id {kind}, piece int, token_start long, n_tokens int")


def invariants(sizes: DataFrame, packed: DataFrame, capacity: int, *, documents: int | None = None, attention: int | None = None) -> DataFrame:
    """One row about a packing: documents, tokens, kept (no container over any of its capacities), whole (every document's
    pieces follow each other and hold all its tokens, and one that fits is in one piece), gapless container ids."""
    most = largest_item(capacity, attention)
    n = F.col("n_tokens").cast("long")
    load = packed.groupBy("container_id").agg(F.sum(n).alias("tokens"), F.count("*").alias("items"), F.sum(n * n).alias("cost"))
    fits = (F.col("tokens") <= capacity) & (F.col("items") <= (documents or capacity)) & (F.col("cost") <= (attention or capacity * capacity))
    kept = load.agg(F.coalesce(F.bool_and(fits), F.lit(True)).alias("kept"), (F.count("*") == F.coalesce(F.max("container_id") + 1, F.lit(0))).alias("gapless"))
    end = F.col("token_start") + F.col("n_tokens")
    parts = packed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.countDistinct("piece").alias("distinct"), F.max("piece").alias("last"), F.sum(n).alias("held"), F.max(end).alias("reach"), F.bool_and(F.col("token_start") == F.col("piece").cast("long") * most).alias("placed"))
    there = sizes.where("n_tokens > 0").select("doc_id", F.col("n_tokens").cast("long").alias("tokens"))
    both = there.join(parts, "doc_id", "full")
    right = (F.col("held") == F.col("tokens")) & (F.col("reach") == F.col("tokens")) & (F.col("pieces") == F.col("distinct")) & (F.col("last") + 1 == F.col("pieces")) & F.col("placed") & (F.col("pieces") == F.ceil(F.col("tokens") / most))
    whole = both.agg(F.count("*").alias("documents"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.bool_and(F.coalesce(right, F.lit(False))), F.lit(True)).alias("whole"))
    both = whole.unionByName(kept, allowMissingColumns=True)  # a row each
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
