"""The k most similar vectors of every vector, by balanced posting lists (problem 1).

Centroids of a two-level k-means, fitted on a bounded sample, head posting lists of about ``list_size`` vectors.
Dense regions get centroids in proportion, and a cluster with over twice its share of the sample is cut in two until
none is, which balances the lists. A graph links every centroid to its nearest ones; it is searched in memory, beam by
beam, from a few entry points, for a whole batch of vectors at once. A boundary vector is replicated to every list
whose centroid is almost as near as the nearest (``replicate``), unless a list already taken lies nearer to that
centroid than the vector does. A query visits the lists within ``probe`` times the nearest distance, and at least
``least_probes``. Where a table needs more lists than ``max_lists`` centroids can head, each of them is divided by a
second level of up to ``fine`` centroids, fitted on what the sample's vectors differ from their list's centroid by and
common to all lists; replication and pruning work on it in the same way, so lists keep their size up to
``max_lists * fine`` of them (16,384 x 4,096 of 256: 1.7e10 vectors; of 1,536: 1e11).

The assignments are written, and the lists counted. A list of more data or queries than ``block`` is cut into blocks
by those true counts, each (list, data block, query block) is one group of at most about twice ``block`` rows: a
blocked matrix product, of which each query keeps its k best. The groups' answers are merged per query.

Every vector is indexed and compared in float32 with its own values (16-bit floats travel as such when that loses
nothing); a cosine that comes close to ``at_least`` is decided in float64. What is broadcast is bounded: at most
``max_lists`` centroids with their links and ``fine`` more. The sample is bounded by ``sample_per_list * max_lists``
vectors and by ``sample_bytes``; it is chosen by a hash of the id alone.

Defined results. A vector is usable if it has models.dimensions elements, none null or NaN and not all zero, and
its chunk exists; of each (model, chunk) the usable row with the latest created_at, then the greater id, counts
(a null created_at is the earliest). Vectors with infinite elements are similar to nothing. Cosines are compared at six
decimals; ties go to the smaller chunk id. Of exact copies beyond k + 1 of one model only the k + 1 smallest ids can be anyone's neighbours, and the
others' neighbours are the k smallest; so they are not compared, and no result is lost. Null ids are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docmill.session import Scratch, written


@dataclass(frozen=True)
class Settings:
    k: int = 10
    list_size: int = 256
    max_lists: int = 16_384
    sample_per_list: int = 8
    links: int = 16
    entries: int = 256
    beam: int = 24
    rounds: int = 6
    replicate: float = 1.06
    replicas: int = 3
    probe: float = 1.12
    probes: int = 8
    least_probes: int = 2
    block: int = 4096
    fine: int = 4096
    fine_replicas: int = 2
    fine_probes: int = 4
    sample_bytes: int = 512 << 20


#: For neighbours with a clear similarity (0.75 and more): near vectors share one of the few nearest lists.
CLEAR = Settings(list_size=1536, sample_per_list=16, probe=1.1, probes=4, least_probes=3, replicate=1.15, replicas=3, beam=16, rounds=6)
#: For neighbours far below that: more lists for each query.
WIDE = Settings(probe=1.6, probes=48, beam=64, rounds=16, least_probes=12)


#: How near to the threshold a cosine of float32 is looked at again.
NEAR = 4e-6


def normal(x: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        scale = np.abs(x).max(1, keepdims=True)
        y = x / np.where(scale > 0, scale, 1)
        y = y / np.maximum(np.sqrt((y * y).sum(1, keepdims=True)), 1e-12)
    y[~np.isfinite(y).all(1)] = 0
    return y.astype(np.float32)


def pack(x: np.ndarray) -> list[bytes]:
    """Rows as bytes: the upper halves of the floats if the lower ones are all zero, else the floats."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32)
    short = (bits & 0xFFFF == 0).all(1)
    high = (bits >> 16).astype(np.uint16)
    return [high[n].tobytes() if short[n] else bits[n].tobytes() for n in range(len(bits))]


def unpack(rows: list[bytes], dim: int) -> np.ndarray:
    """The packed rows, each scaled to length one."""
    out = np.empty((len(rows), dim), np.uint32)
    for n, row in enumerate(rows):
        out[n] = np.frombuffer(row, np.uint32) if len(row) == 4 * dim else np.frombuffer(row, np.uint16).astype(np.uint32) << 16
    return normal(out.view(np.float32))


def exact_cosine(a: bytes, b: bytes, dim: int) -> float:
    """The cosine of two packed vectors in float64."""
    x, y = (np.frombuffer(v, np.float32) if len(v) == 4 * dim else (np.frombuffer(v, np.uint16).astype(np.uint32) << 16).view(np.float32) for v in (a, b))
    x, y = x.astype(np.float64), y.astype(np.float64)
    return float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)))


def _distinct(x: np.ndarray) -> np.ndarray:
    """The rows without repeats, in their order."""
    rows = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel()
    return x[np.sort(np.unique(rows, return_index=True)[1])]


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.concatenate([(x[i : i + 8192] @ centre.T).argmax(1) for i in range(0, len(x), 8192)] or [np.zeros(0, int)])


def _kmeans(x: np.ndarray, c: int, seed: int, rounds: int = 6) -> np.ndarray:
    """About ``c`` centroids, all of them distinct and in use: copies start one, and one that loses all its rows goes. A
    cluster of over twice the mean size is cut in two, as often as needed."""
    rng = np.random.default_rng(seed)
    start = _distinct(x)
    centre = start[rng.choice(len(start), min(c, len(start)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centre)
        order = np.argsort(near, kind="stable")
        used, at = np.unique(near[order], return_index=True)
        centre = normal(np.add.reduceat(x[order], at, axis=0))
    centre = _distinct(centre)
    most = max(4, 2 * len(x) // max(c, 1))
    if len(centre) < 2:
        return centre
    near, whole = _nearest(x, centre), []
    todo = [np.nonzero(near == k)[0] for k in range(len(centre))]
    parts = []
    while todo:
        rows = todo.pop()
        own = x[rows]
        if len(rows) > most and len(ends := _distinct(own)) > 1:
            pair = ends[[0, (ends @ ends[0]).argmin()]]
            for _ in range(4):
                side = (own @ pair.T).argmax(1)
                if side.min() == side.max():
                    break
                pair = normal(np.stack([own[side == 0].sum(0), own[side == 1].sum(0)]))
            if side.min() != side.max():
                todo += [rows[side == 0], rows[side == 1]]
                continue
        if len(rows):
            parts.append(normal(own.sum(0, keepdims=True)))
    whole = np.concatenate(parts)
    return _distinct(whole[whole.any(1)])


def _plain_kmeans(x: np.ndarray, c: int, seed: int, rounds: int = 6) -> np.ndarray:
    """Centroids of vectors of any length, by squared distance."""
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), min(c, len(x)), replace=False)].copy()
    for _ in range(rounds):
        half = (centre * centre).sum(1) / 2
        near = np.concatenate([(x[i : i + 8192] @ centre.T - half).argmax(1) for i in range(0, len(x), 8192)])
        order = np.argsort(near, kind="stable")
        used, at, n = np.unique(near[order], return_index=True, return_counts=True)
        centre = np.add.reduceat(x[order], at, axis=0) / n[:, None].astype(np.float32)
    return centre


class Lists:
    """Centroids and their graph, and the second level of a table that needs one, for one model."""

    def __init__(self, sample: np.ndarray, count: int, s: Settings, seed: int = 7):
        needed = max(1, -(-count // s.list_size))
        want = int(max(1, min(needed, s.max_lists, max(1, len(sample)))))
        top = _kmeans(sample, max(1, round(want**0.5)), seed)
        near = _nearest(sample, top)
        parts = []
        for t in range(len(top)):
            own = sample[near == t]
            if len(own):
                parts.append(_kmeans(own, max(1, round(want * len(own) / len(sample))), seed + t + 1))
        self.centre = _distinct(np.concatenate(parts))
        n = len(self.centre)
        links = min(s.links, n)
        self.links = np.empty((n, links), np.int32)
        for i in range(0, n, 1024):
            d = self.centre[i : i + 1024] @ self.centre.T
            self.links[i : i + 1024] = np.argpartition(-d, links - 1, 1)[:, :links]
        # entry points: the ones nearest to the upper level, and evenly spaced ones of every part of it
        even = np.arange(0, n, max(1, n // max(s.entries, int(8 * n**0.5))))
        self.entry = np.union1d((top @ self.centre.T).argmax(1), even).astype(np.int32)
        self.fine = None
        parts = min(s.fine, -(-needed // n))
        if parts > 1 and needed > s.max_lists:
            first, _ = self.search(sample, s, 1)
            self.fine = _plain_kmeans(sample - self.centre[first[:, 0]], parts, seed)

    def search(self, x: np.ndarray, s: Settings, want: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``want`` nearest centroids of each row and their cosines, best first, by beam search on the graph."""
        n = len(self.centre)
        beam = min(max(s.beam, want), n)
        start = x @ self.centre[self.entry].T
        take = min(beam, start.shape[1])
        pick = np.argpartition(-start, take - 1, 1)[:, :take]
        ids = np.full((len(x), beam), -1, np.int32)
        cos = np.full((len(x), beam), -9.0, np.float32)
        ids[:, :take], cos[:, :take] = self.entry[pick], np.take_along_axis(start, pick, 1)
        done = np.zeros((len(x), beam), bool)
        active = np.arange(len(x))
        for _ in range(s.rounds):
            # expand the best few not yet expanded of each row that still has one near its best
            c = np.where(done[active], -9.0, cos[active])
            few = np.argpartition(-c, min(3, beam - 1), 1)[:, : min(4, beam)]
            chosen = np.take_along_axis(ids[active], few, 1)
            np.put_along_axis(sub := done[active], few, True, 1)
            done[active] = sub
            new = np.where(chosen[:, :, None] >= 0, self.links[np.maximum(chosen, 0)], -1).reshape(len(active), -1)
            new.sort(1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            known = (new[:, :, None] == ids[active][:, None, :]).any(2)
            new[known] = -1
            value = np.full(new.shape, -9.0, np.float32)
            r, q = np.nonzero(new >= 0)
            for i in range(0, len(r), 16384):
                value[r[i : i + 16384], q[i : i + 16384]] = np.einsum("ij,ij->i", x[active[r[i : i + 16384]]], self.centre[new[r[i : i + 16384], q[i : i + 16384]]])
            all_ids = np.concatenate([ids[active], new], 1)
            all_cos = np.concatenate([cos[active], value], 1)
            all_done = np.concatenate([done[active], np.zeros(new.shape, bool)], 1)
            keep = np.argpartition(-all_cos, beam - 1, 1)[:, :beam]
            ids[active], cos[active], done[active] = (np.take_along_axis(a, keep, 1) for a in (all_ids, all_cos, all_done))
            # a row is done when every centroid it still holds has been expanded
            active = active[((ids[active] >= 0) & ~done[active]).any(1)]
            if not len(active):
                break
        order = np.argsort(-cos, 1, kind="stable")[:, :want]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)

    def assign(self, x: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, role) of all copies; role 1 data, 2 query, 3 both."""
        lists, cos = self.search(x, s, max(s.probes, s.replicas))
        far = np.sqrt(np.maximum(0, 2 - 2 * cos))
        near = far[:, :1]
        real = (lists >= 0) & (cos > -8)
        query = real & (far <= s.probe * near + 0.02)
        query[:, : s.least_probes] |= real[:, : s.least_probes]
        query[:, s.probes :] = False
        data = real & (far <= s.replicate * near + 0.01)
        data[:, s.replicas :] = False
        for j in range(1, min(s.replicas, lists.shape[1])):  # a list already taken that lies nearer makes the copy idle
            for i in range(j):
                both = data[:, i] & data[:, j]
                if both.any():
                    between = np.einsum("ij,ij->i", self.centre[lists[both, i]], self.centre[lists[both, j]])
                    data[np.nonzero(both)[0][between > cos[both, j]], j] = False
        role = data + 2 * query
        row, place = np.nonzero(role)
        row, which, role = row, lists[row, place].astype(np.int64), role[row, place]
        return (row, which, role) if self.fine is None else self._refined(x, row, which, role, s)

    def _refined(self, x: np.ndarray, row: np.ndarray, which: np.ndarray, role: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same by the second level: each copy goes to the parts of its list that are nearest to it."""
        want = min(max(s.fine_replicas, s.fine_probes), len(self.fine))
        half = (self.fine * self.fine).sum(1) / 2
        rows, lists, roles = [], [], []
        for i in range(0, len(row), 4096):
            r, w, o = row[i : i + 4096], which[i : i + 4096], role[i : i + 4096]
            rest = x[r] - self.centre[w]
            score = rest @ self.fine.T - half
            part = np.argpartition(-score, want - 1, 1)[:, :want]
            score = np.take_along_axis(score, part, 1)
            order = np.argsort(-score, 1, kind="stable")
            part, score = np.take_along_axis(part, order, 1), np.take_along_axis(score, order, 1)
            far = np.sqrt(np.maximum(0, (rest * rest).sum(1)[:, None] - 2 * score))
            data = (far <= s.replicate * far[:, :1] + 0.01) & (o & 1 > 0)[:, None]
            data[:, s.fine_replicas :] = False
            query = (far <= s.probe * far[:, :1] + 0.02) & (o & 2 > 0)[:, None]
            query[:, s.fine_probes :] = False
            both = data + 2 * query
            n, place = np.nonzero(both)
            rows.append(r[n])
            lists.append(w[n] * len(self.fine) + part[n, place])
            roles.append(both[n, place])
        return tuple(np.concatenate(a) if a else np.zeros(0, np.int64) for a in (rows, lists, roles))


def usable_vectors(embeddings: DataFrame, models: DataFrame, chunks: DataFrame) -> DataFrame:
    """(model, chunk_id, dim, vec binary): one packed vector for each usable (model, chunk); written once.

    Which row counts is decided on narrow columns with partial aggregation; the vectors themselves move only
    if the list of chosen rows is too long to broadcast.
    """
    dims = models.where("dimensions > 0").groupBy(F.col("id").alias("model")).agg(F.max("dimensions").alias("dim"))
    dims = F.broadcast(dims) if dims.count() <= 10_000 else dims
    rows = embeddings.where("id is not null and chunk_id is not null and embedding is not null").select("id", "chunk_id", "model", "embedding", "created_at").join(dims, "model").where(F.size("embedding") == F.col("dim"))
    rows = rows.where(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)) & F.exists("embedding", lambda v: v != 0))
    exists = chunks.where("id is not null").select(F.col("id").alias("chunk_id")).distinct()
    last = rows.select("model", "chunk_id", "created_at", "id").groupBy("model", "chunk_id").agg(F.max(F.struct("created_at", "id")).alias("last"))
    last = written(last.join(exists, "chunk_id", "left_semi").select("model", "chunk_id", F.col("last.created_at").alias("at"), F.col("last.id").alias("id")), "chosen")
    chosen = F.broadcast(last) if last.count() <= 500_000 else last
    same = (rows["id"] == chosen["id"]) & (rows["model"] == chosen["model"]) & (rows["chunk_id"] == chosen["chunk_id"]) & rows["created_at"].eqNullSafe(chosen["at"])
    kept = rows.join(chosen, same, "left_semi").select("model", "chunk_id", "dim", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, dim = batch.column("embedding"), batch.column("dim").to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
            ends = np.cumsum(dim)
            packed: list[bytes] = [b""] * len(dim)
            for d in np.unique(dim):
                at = np.nonzero(dim == d)[0]
                x = flat[(ends[at] - d)[:, None] + np.arange(d)]
                for n, row in zip(at, pack(x)):
                    packed[n] = row
            yield pa.RecordBatch.from_arrays([batch.column("model"), batch.column("chunk_id"), batch.column("dim"), pa.array(packed, pa.binary())], ["model", "chunk_id", "dim", "vec"])

    return written(kept.mapInArrow(run, "model long, chunk_id long, dim int, vec binary"), "vectors")


def _crowded(vectors: DataFrame, k: int) -> DataFrame | None:
    """(model, chunk_id, h, place) of the copies in classes of over k + 1 copies; place is 1 to k + 1 for the smallest ids, else 0."""
    key = vectors.select("model", "chunk_id", F.xxhash64("vec").alias("h"))
    many = key.groupBy("model", "h").agg(F.count("*").alias("n")).where(F.col("n") > k + 1)
    many = written(many, "copies")
    if many.isEmpty():
        return None
    copies = key.join(many.select("model", "h"), ["model", "h"]).withColumn("salt", F.pmod(F.xxhash64("chunk_id"), F.lit(256)))
    part = copies.withColumn("n", F.row_number().over(Window.partitionBy("model", "h", "salt").orderBy("chunk_id"))).where(F.col("n") <= k + 1)
    first = part.withColumn("place", F.row_number().over(Window.partitionBy("model", "h").orderBy("chunk_id"))).where(F.col("place") <= k + 1).select("model", "chunk_id", "place")
    return written(copies.select("model", "chunk_id", "h").join(first, ["model", "chunk_id"], "left").withColumn("place", F.coalesce("place", F.lit(0))), "crowd")


def without_surplus(vectors: DataFrame, crowd: DataFrame | None) -> DataFrame:
    """The vectors that are compared: all but the copies that can be nobody's neighbours."""
    if crowd is None:
        return vectors
    return vectors.join(crowd.where("place = 0").select("model", "chunk_id"), ["model", "chunk_id"], "left_anti")


def fit(vectors: DataFrame, s: Settings) -> dict[int, tuple[int, Lists]]:
    """model -> (dimensions, lists), fitted on a sample whose size follows the number of lists, which is bounded."""
    out = {}
    for m in vectors.groupBy("model", "dim").count().orderBy("model").collect():  # a row for each model
        lists = min(-(-m["count"] // s.list_size), s.max_lists)
        want = max(2048, min(lists * s.sample_per_list, s.sample_bytes // (4 * m.dim)))
        share = min(1.0, want / m["count"])
        rows = vectors.where((F.col("model") == m.model) & (F.pmod(F.xxhash64("chunk_id"), F.lit(1 << 30)) < int(share * (1 << 30)))).select("chunk_id", "vec").toArrow()
        order = np.argsort(rows.column("chunk_id").to_numpy(), kind="stable")
        sample = unpack(rows.column("vec").to_pylist(), m.dim)[order]
        if len(sample):
            out[m.model] = (m.dim, Lists(sample, m["count"], s))
    return out


def _spread_over_blocks(assigned: DataFrame, s: Settings, scratch: Scratch) -> DataFrame:
    """(model, list, block, asked, chunk_id, role, vec) of every copy: data goes to its block of a list and to all query
    blocks of it, a query to its query block and to all data blocks. Lists are cut by their true counts."""
    place = assigned.select("model", "chunk_id", "vec", F.explode(F.arrays_zip("lists", "roles")).alias("p")).select("model", F.col("p.lists").alias("list"), "chunk_id", F.col("p.roles").alias("role"), "vec")
    held = place.groupBy("model", "list").agg(F.ceil(F.count_if(F.col("role").bitwiseAND(1) > 0) / s.block).cast("int").alias("parts"), F.ceil(F.count_if(F.col("role").bitwiseAND(2) > 0) / s.block).cast("int").alias("turns"))
    large = scratch.written(held.where("parts > 1 or turns > 1"), "large")
    few = large.count()
    if not few:
        return place.withColumn("block", F.lit(0)).withColumn("asked", F.lit(0))
    place = place.join(F.broadcast(large) if few <= 200_000 else large, ["model", "list"], "left")
    parts, turns = F.greatest(F.coalesce("parts", F.lit(1)), F.lit(1)), F.greatest(F.coalesce("turns", F.lit(1)), F.lit(1))
    own, turn = F.pmod(F.xxhash64("chunk_id", F.lit(1)), parts).cast("int"), F.pmod(F.xxhash64("chunk_id", F.lit(2)), turns).cast("int")
    as_data = F.transform(F.sequence(F.lit(0), turns - 1), lambda q: F.struct(own.alias("block"), q.alias("asked"), F.lit(1).cast("tinyint").alias("role")))
    as_query = F.transform(F.sequence(F.lit(0), parts - 1), lambda b: F.struct(b.alias("block"), turn.alias("asked"), F.lit(2).cast("tinyint").alias("role")))
    none = F.array().cast("array<struct<block:int,asked:int,role:tinyint>>")
    here = F.array(F.struct(F.lit(0).alias("block"), F.lit(0).alias("asked"), F.col("role")))
    copies = F.when(F.col("parts").isNull(), here).otherwise(F.concat(F.when(F.col("role").bitwiseAND(1) > 0, as_data).otherwise(none), F.when(F.col("role").bitwiseAND(2) > 0, as_query).otherwise(none)))
    return place.select("model", "list", "chunk_id", "vec", F.explode(copies).alias("c")).select("model", "list", "c.block", "c.asked", "chunk_id", "c.role", "vec")


def most_similar(vectors: DataFrame, s: Settings = Settings(), *, at_least: float = -2.0, queries: str | None = None) -> DataFrame:
    """(model, chunk_id, neighbour, cosine, rank): the k nearest of each query among all vectors.

    ``vectors`` is the table of :func:`usable_vectors`. ``at_least`` leaves out pairs under that cosine before
    they leave their list. ``queries`` is an SQL condition on chunk_id; without it every vector is a query.
    """
    spark = vectors.sparkSession
    scratch = Scratch()
    crowd = _crowded(vectors, s.k)
    compared = without_surplus(vectors, crowd)
    index = fit(compared, s)  # on what is compared, so that surplus copies take no part of the sample and no centroids
    asked = F.expr(queries) if queries else F.lit(True)
    shared = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                model = batch.column("model").to_numpy()
                ask = batch.column("asked").to_numpy(zero_copy_only=False)
                for m in np.unique(model):
                    if m not in made:
                        continue
                    dim, lists = made[m]
                    rows = np.nonzero(model == m)[0]
                    part = batch.take(pa.array(rows))
                    row, which, role = lists.assign(unpack(part.column("vec").to_pylist(), dim), s)
                    role = np.where(ask[rows][row], role, role & 1)
                    row, which, role = row[role > 0], which[role > 0], role[role > 0]
                    order = np.argsort(row, kind="stable")
                    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(rows)))]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("model"), part.column("chunk_id"), part.column("vec"), pa.ListArray.from_arrays(ends, pa.array(which[order])), pa.ListArray.from_arrays(ends, pa.array(role[order].astype(np.int8)))],
                        ["model", "chunk_id", "vec", "lists", "roles"],
                    )

    def compare(table: pa.Table) -> pa.Table:
        model = table.column("model")[0].as_py()
        dim = shared.value[model][0]
        ids, at, same = np.unique(table.column("chunk_id").to_numpy(), return_index=True, return_inverse=True)  # a repeated row counts once
        role = np.zeros(len(ids), np.int8)
        np.bitwise_or.at(role, same, table.column("role").to_numpy())
        packed = table.column("vec").take(pa.array(at)).to_pylist()
        x = unpack(packed, dim)
        data, query = np.nonzero(role & 1)[0], np.nonzero(role & 2)[0]
        a_out, b_out, c_out = [], [], []
        live = x.any(1)
        floor = at_least - NEAR if at_least > -1 else at_least
        for i in range(0, len(query), 1024):
            q = query[i : i + 1024]
            best_c = np.full((len(q), 0), 0, np.float32)
            best_i = np.full((len(q), 0), 0, np.int64)
            for j in range(0, len(data), 4096):
                d = data[j : j + 4096]
                c = x[q] @ x[d].T
                c *= 1e6
                np.rint(c, out=c)  # ties are decided at six decimals
                c[q[:, None] == d[None, :]] = -9e6
                c[:, ~live[d]] = -9e6
                c[~live[q]] = -9e6
                if at_least > -1:
                    if not best_c.shape[1] and c.max(initial=-9e6) < floor * 1e6:
                        continue
                best_c, best_i = np.concatenate([best_c, c], 1), np.concatenate([best_i, np.broadcast_to(d, c.shape)], 1)
                if best_c.shape[1] > s.k:
                    # the k best, ties by id: rows are in id order, so a stable sort of a few candidates decides
                    kth = -np.partition(-best_c, s.k - 1, 1)[:, s.k - 1 : s.k]
                    width = int((best_c >= kth).sum(1).max())
                    keep = np.argsort(-best_c, 1, kind="stable")[:, :width] if width > 4 * s.k else np.sort(np.argpartition(-best_c, min(width, best_c.shape[1] - 1), 1)[:, :width], 1)
                    best_c, best_i = np.take_along_axis(best_c, keep, 1), np.take_along_axis(best_i, keep, 1)
            if not best_c.shape[1]:
                continue
            order = np.lexsort((best_i, -best_c), 1)[:, : s.k]
            best_c, best_i = np.take_along_axis(best_c, order, 1), np.take_along_axis(best_i, order, 1)
            take = (best_c > -8e6) & (best_c >= floor * 1e6)
            if at_least > -1:  # what float32 cannot tell from the threshold is decided in float64
                for r, p in zip(*np.nonzero(take & (best_c <= (at_least + NEAR) * 1e6))):
                    take[r, p] = exact_cosine(packed[q[r]], packed[best_i[r, p]], dim) >= at_least
            r, p = np.nonzero(take)
            a_out.append(ids[q[r]])
            b_out.append(ids[best_i[r, p]])
            c_out.append(best_c[r, p] / 1e6)
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        a = join(a_out, np.int64)
        return pa.table({"model": pa.array(np.full(len(a), model, np.int64)), "chunk_id": pa.array(a), "neighbour": pa.array(join(b_out, np.int64)), "cosine": pa.array(join(c_out, np.float32))})

    assigned = scratch.written(compared.select("model", "chunk_id", "vec", asked.alias("asked")).mapInArrow(place, "model long, chunk_id long, vec binary, lists array<long>, roles array<tinyint>"), "assigned")
    groups = _spread_over_blocks(assigned, s, scratch).groupBy("model", "list", "block", "asked")
    answers = written(groups.applyInArrow(compare, "model long, chunk_id long, neighbour long, cosine float"), "answers")
    scratch.clear()
    if queries is None and at_least > -1:  # what either side found holds for both
        answers = answers.unionByName(answers.select("model", F.col("neighbour").alias("chunk_id"), F.col("chunk_id").alias("neighbour"), "cosine"))
    one = answers.groupBy("model", "chunk_id", "neighbour").agg(F.max("cosine").alias("cosine"))
    if crowd is not None:
        # the others of a large class: their k nearest are its k smallest ids
        first = crowd.where((F.col("place") > 0) & (F.col("place") <= s.k)).select("model", "h", F.col("chunk_id").alias("neighbour"))
        rest = crowd.where("place = 0").where(asked).select("model", "h", "chunk_id").join(first, ["model", "h"]).select("model", "chunk_id", "neighbour", F.lit(1.0).cast("float").alias("cosine"))
        one = one.unionByName(rest)
    best = Window.partitionBy("model", "chunk_id").orderBy(F.desc("cosine"), "neighbour")
    return one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.k)


def mutual_pairs(vectors: DataFrame, s: Settings = CLEAR, *, at_least: float = 0.75) -> DataFrame:
    """(model, a, b), a < b: each among the other's k most similar, at least that similar."""
    top = most_similar(vectors, s, at_least=at_least)
    pair = top.select("model", F.least("chunk_id", "neighbour").alias("a"), F.greatest("chunk_id", "neighbour").alias("b"))
    return pair.groupBy("model", "a", "b").agg(F.count("*").alias("n")).where("n = 2").select("model", "a", "b")


FOUND_SQL = """
WITH usable AS (
  SELECT e.model, e.chunk_id, CAST(e.embedding AS DOUBLE[]) AS v, row_number() OVER (PARTITION BY e.model, e.chunk_id ORDER BY e.created_at DESC NULLS LAST, e.id DESC) AS n
  FROM chunk_embeddings e JOIN models m ON m.id = e.model
  WHERE len(e.embedding) = m.dimensions AND len(list_filter(e.embedding, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(e.embedding, lambda x: x <> 0)) > 0
    AND e.chunk_id IN (SELECT id FROM chunks)
), u AS (SELECT model, chunk_id, v FROM usable WHERE n = 1),
s AS (SELECT a.model, a.chunk_id AS a, b.chunk_id AS b, list_cosine_similarity(a.v, b.v) AS c FROM u a JOIN u b ON a.model = b.model AND a.chunk_id <> b.chunk_id),
t AS (SELECT model, a, b FROM (SELECT *, row_number() OVER (PARTITION BY model, a ORDER BY round(c, 6) DESC, b) AS r FROM s WHERE c >= 0.75) WHERE r <= 10)
SELECT t.model, t.a AS chunk_id_a, t.b AS chunk_id_b FROM t JOIN t r ON r.model = t.model AND r.a = t.b AND r.b = t.a WHERE t.a < t.b
"""
NEIGHBOURS_SQL = FOUND_SQL[: FOUND_SQL.rindex("s AS (SELECT a.model")] + """
s AS (SELECT a.model, a.chunk_id AS a, b.chunk_id AS b, list_cosine_similarity(a.v, b.v) AS c FROM u a JOIN u b ON a.model = b.model AND a.chunk_id <> b.chunk_id WHERE a.chunk_id % 100 = 0)
SELECT model, a AS chunk_id, b AS neighbour, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY model, a ORDER BY round(c, 6) DESC, b) AS r FROM s) WHERE r <= 10
"""
