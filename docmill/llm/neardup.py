"""Near-duplicate passages by covering locality-sensitive hashing (problem 5).

A passage is the set of its runs of ``width`` consecutive lower-cased words. Its sketch has 42 coordinates, each
the minimum of one hash function over the set, in six blocks of seven. Within a block the coordinates carry the
seven non-zero vectors m(i) of GF(2)^3, and there is one mask for each non-zero vector v: it keeps the four
coordinates with <m(i), v> = 1. Any two coordinates are orthogonal to a common v, so the seven masks of a block
cover every pattern of up to two differing coordinates: two sketches that differ in at most 17 of the 42
coordinates differ in at most two of some block and therefore collide in one of the 42 tables, with certainty. At
a similarity of 0.7 the chance that no table collides is under 0.1 %, at 0.8 under 1e-6; collisions of four
minima at once keep unrelated passages apart (about s^4), so the work grows with the input.

Plan: passages with the same set form a class (their sketch is equal, so they would meet in every table): one
representative per class, by partial aggregation. The keys (64 bits) of the representatives are counted first, by
partial aggregation, so a key that half of them have is one row of each task. Keys of 2 to ``block`` representatives
are gathered and give pairs. Members of more crowded keys are never gathered by them; they meet again, all together,
under the rarest of their runs of words: two sets of similarity s share at least one of the first n - ceil(s n) + 1
runs of each, in any order common to all (here the ``FREQUENT`` most frequent ones come last), so nothing is lost and
passages that only share a template meet no more. These runs are counted before they are gathered, too; members of a
run that is still crowded are compared block against block of ``CROWD``, each in its own task, and only verified
pairs leave it: that work is in proportion to the pairs of passages that really share their rarest words. The union
is made distinct, the word sets of the representatives involved are built again from their texts, and the exact
Jaccard similarity decides (integers, no rounding).

Defined results: null, empty and short texts (under ``min_words`` words) belong to no pair and no class; an id on
several rows counts once, and if its texts differ, with the one whose word set has the least hash; pairs are a < b. Classes of up to ``expand`` copies
give all their pairs, larger ones give the pairs of the representative with every copy (``classes`` lists all
members, so no link is lost); likewise between two classes. ``expand=None`` gives all pairs of all copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.session import Scratch, written

WIDTH, MIN_WORDS, NUMERATOR, DENOMINATOR = 3, 40, 7, 10
BLOCKS, COORDINATES = 6, 7
#: Representatives under one key that are paired at once; the members of larger ones meet again under rare words.
BLOCK = 16
#: Members of one block where a rare run of words is crowded, and the runs that count as frequent (16 bytes each on the driver).
CROWD, FREQUENT = 512, 500_000
#: Copies in a class up to which all pairs of copies are listed.
EXPAND = 200
#: Ids that may be broadcast (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 2_000_000

_WORD = regex.compile(r"[\p{L}\p{N}]+")
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (shift, multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(29))) * _U(0xD6E8FEB86659FD93)
        return x ^ (x >> _U(32))


def _constants(n: int, salt: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0xA24BAED4963EE407) + _U(salt)) | _U(1)


class _WordHash(dict):
    """Word -> 64-bit hash, kept per batch of work."""

    def __missing__(self, word: str) -> int:
        value = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return value


def words_of(text: str) -> list[str]:
    """Maximal runs of letters and digits, lower-cased."""
    found = _WORD.findall(text)
    return "\x00".join(found).lower().split("\x00") if found else []


def word_sets(texts: list[str | None], table: _WordHash, width: int, min_words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of words of each text; empty for short ones."""
    none = np.zeros(0, np.uint64)
    out = []
    factor = _constants(width, 77)
    for text in texts:
        words = words_of(text) if text else []
        if len(words) < max(min_words, width):
            out.append(none)
            continue
        h = np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
        n = len(h) - width + 1
        with np.errstate(over="ignore"):
            run = h[:n] * factor[0]
            for k in range(1, width):
                run = _mix(run) + h[k : k + n] * factor[k]
        out.append(np.unique(_mix(run)))
    return out


def masks() -> np.ndarray:
    """The seven masks of a block: row v - 1 keeps the coordinates i with <i + 1, v> odd."""
    v, m = np.arange(1, 8)[:, None], np.arange(1, 8)[None, :]
    return np.array([[bin(int(x)).count("1") % 2 for x in row] for row in (v & m)], bool)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """(set, coordinate) minima; all sets must be non-empty."""
    n = BLOCKS * COORDINATES
    a, b = _constants(n, 1), _constants(n, 2)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((len(sets), n), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out[:, k] = np.minimum.reduceat(flat * a[k] + b[k], starts)
    return out


def table_keys(sketch: np.ndarray) -> np.ndarray:
    """(set, table) 64-bit keys: for each block and mask the number of the table and the kept coordinates, hashed."""
    mixed = _mix(sketch)
    kept = masks()
    table = _constants(BLOCKS * 7, 3)
    out = np.empty((len(sketch), BLOCKS * 7), np.uint64)
    with np.errstate(over="ignore"):
        for block in range(BLOCKS):
            for v in range(7):
                key = np.full(len(sketch), table[block * 7 + v])
                for i in np.nonzero(kept[v])[0]:
                    key = _mix(key + mixed[:, block * COORDINATES + i])
                out[:, block * 7 + v] = key
    return out.view(np.int64)


def _class_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketched(chunks: DataFrame, *, key: str = "id", text: str = "text", width: int = WIDTH, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, class, size, keys array<long>) of every long enough row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _WordHash()
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                sets = word_sets(batch.column("t").to_pylist(), table, width, min_words)
                if len(table) > 500_000:
                    table.clear()
                kept = [n for n, s in enumerate(sets) if len(s)]
                if not kept:
                    continue
                sets = [sets[n] for n in kept]
                keys = table_keys(sketches(sets))
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(kept)), pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                    ["id", "class", "size", "keys"],
                )

    rows = chunks.where(chunks[key].isNotNull() & chunks[text].isNotNull()).select(chunks[key].cast("long").alias("id"), chunks[text].alias("t"))
    return rows.mapInArrow(run, "id long, class long, size int, keys array<long>")


def _sets_table(chunks: DataFrame, ids: DataFrame, key: str, text: str, width: int, min_words: int) -> DataFrame:
    """(rep, words array<long>) of the representatives in ``ids`` (rep)."""
    rows = chunks.select(chunks[key].cast("long").alias("rep"), chunks[text].alias("t"))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    rows = rows.join(ids, "rep", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _WordHash()
        for batch in batches:
            sets = word_sets(batch.column("t").to_pylist(), table, width, min_words)
            if len(table) > 500_000:
                table.clear()
            kept = [n for n, s in enumerate(sets) if len(s)]
            sets = [sets[n] for n in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pa.array(kept, pa.int64())), pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["rep", "class", "words"]
            )

    return rows.mapInArrow(run, "rep long, class long, words array<long>").groupBy("rep").agg(F.min_by("words", "class").alias("words"))


def _similar(a: str, b: str, numerator: int, denominator: int):
    """Jaccard of two word-set columns >= numerator / denominator, in integers."""
    common = F.size(F.array_intersect(a, b))
    return common * denominator >= (F.size(a) + F.size(b) - common) * numerator


def _counted(signature: DataFrame, block: int, numerator: int, denominator: int, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Of (rep, size, key): the pairs (a, b) under keys of 2 to ``block`` representatives whose sizes allow the
    similarity, and the crowded keys (key, n), None if there are none.

    Rows of crowded keys leave before the others are shuffled; where too many keys are crowded to be broadcast, the
    join leaves them behind (and splits the partitions that they skew)."""
    met = scratch.written(signature.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "met")
    crowded = met.where(F.col("n") > block)
    few = crowded.count()
    rest = signature.join(F.broadcast(crowded.select("key")), "key", "left_anti") if 0 < few <= BROADCAST_IDS else signature
    buckets = rest.join(met.where(F.col("n") <= block).select("key"), "key", "left_semi").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rep", "size"))).alias("reps"))
    a, b = F.col("a.size"), F.col("b.size")
    pairs = buckets.select(F.posexplode("reps").alias("n", "a"), "reps").select("a", F.explode(F.slice("reps", F.col("n") + 2, F.lit(block))).alias("b"))
    pairs = pairs.where((F.least(a, b) * denominator >= F.greatest(a, b) * numerator)).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()
    return scratch.written(pairs, "candidates"), crowded if few else None


def _rarest(sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(rep, size, key) of the runs of words under which a set meets every set similar to it."""
    words = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
    rows = words.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()  # bounded; any common order serves, this one keeps the groups small
    order = np.argsort(rows.column("word").to_numpy())
    shared = sets.sparkSession.sparkContext.broadcast((rows.column("word").to_numpy()[order], rows.column("n").to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, count = shared.value
        for batch in batches:
            lists = batch.column("words")
            flat, offset = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            at = np.minimum(np.searchsorted(frequent, flat), max(len(frequent) - 1, 0))
            n = np.where(frequent[at] == flat, count[at], 0) if len(frequent) else np.zeros(len(flat), np.int64)
            rep, key = [], []
            sizes = pa.array(np.diff(offset).astype(np.int32))
            for row in range(len(lists)):
                word = flat[offset[row] : offset[row + 1]]
                size = len(word) - -(-numerator * len(word) // denominator) + 1
                key.append(word[np.lexsort((word, n[offset[row] : offset[row + 1]]))[:size]])
                rep.append(np.full(size, row))
            if rep:
                rows = pa.array(np.concatenate(rep))
                yield pa.RecordBatch.from_arrays([batch.column("rep").take(rows), sizes.take(rows), pa.array(np.concatenate(key))], ["rep", "size", "key"])

    return sets.mapInArrow(run, "rep long, size int, key long")


class NearDuplicates:
    """The join's parts: ``members`` (id, rep, copies) and ``links`` between representatives (a, b)."""

    def __init__(self, chunks: DataFrame, *, key: str = "id", text: str = "text", width: int = WIDTH, min_words: int = MIN_WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, block: int = BLOCK, crowd: int = CROWD):
        scratch = Scratch()
        sketch = scratch.written(sketched(chunks, key=key, text=text, width=width, min_words=min_words), "sketches")
        # an id on several rows is in one class: its least
        one = sketch.groupBy("id").agg(F.min("class").alias("class"), F.count("*").alias("rows"))
        reps = one.groupBy("class").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
        known = written(one.join(reps, "class").select("id", "rep", "copies", "rows"), "members")
        self.members = known.select("id", "rep", "copies")
        stands = known.where("id = rep").select("id", "rows")
        kept = sketch.join(F.broadcast(stands) if stands.count() <= BROADCAST_IDS else stands, "id")
        again = kept.where("rows > 1").groupBy("id").agg(F.min_by("size", "class").alias("size"), F.min_by("keys", "class").alias("keys"))
        signature = kept.where("rows = 1").select("id", "size", "keys").unionByName(again).select(F.col("id").alias("rep"), "size", F.explode("keys").alias("key"))
        pairs, crowded = _counted(signature, block, numerator, denominator, scratch)
        ids = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
        hot = None
        if crowded is not None:
            hot = scratch.written(signature.join(crowded.select("key"), "key", "left_semi").select("rep").distinct(), "hot")
            ids = ids.union(hot)
        sets = scratch.written(_sets_table(chunks, ids.distinct(), key, text, width, min_words), "sets")
        found = None
        if hot is not None:
            rare = scratch.written(_rarest(sets.join(hot, "rep", "left_semi"), numerator, denominator), "rare")
            more, crowded = _counted(rare, block, numerator, denominator, scratch)
            pairs = pairs.union(more).distinct()
            if crowded is not None:
                found = _blockwise(rare, crowded, sets, crowd, numerator, denominator)
        a, b = sets.select(F.col("rep").alias("a"), F.col("words").alias("wa")), sets.select(F.col("rep").alias("b"), F.col("words").alias("wb"))
        links = pairs.join(a, "a").join(b, "b").where(_similar("wa", "wb", numerator, denominator)).select("a", "b")
        self.links = written(links.union(found).distinct() if found is not None else links, "links")
        scratch.clear()

    def pairs(self, expand: int | None = EXPAND) -> DataFrame:
        """(a, b), a < b: every linked pair of ids, copies included (see the module's text for large classes)."""
        expand = (1 << 62) if expand is None else expand
        few = self.members.where(F.col("copies") <= expand)
        crowd = self.members.where((F.col("copies") > expand) & (F.col("id") == F.col("rep")))
        stands = few.select("id", "rep").unionByName(crowd.select("id", "rep"))
        x = stands.select(F.col("id").alias("x"), F.col("rep").alias("a"))
        y = stands.select(F.col("id").alias("y"), F.col("rep").alias("b"))
        between = self.links.join(x, "a").join(y, "b").select("x", "y")
        several = few.where("copies > 1").select("id", "rep")
        inside = several.select(F.col("id").alias("x"), "rep").join(several.select(F.col("id").alias("y"), "rep"), "rep").where("x < y").select("x", "y")
        star = self.members.where((F.col("copies") > expand) & (F.col("id") != F.col("rep"))).select(F.col("rep").alias("x"), F.col("id").alias("y"))
        every = between.union(inside).union(star)
        return every.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    def classes(self) -> DataFrame:
        """(id, class_id, links): class and number of linked ids with other texts, of every long enough id."""
        size = self.members.where("id = rep").select("rep", "copies")
        both = self.links.union(self.links.select("b", "a")).toDF("rep", "other")
        degree = both.join(size.toDF("other", "copies"), "other").groupBy("rep").agg(F.sum("copies").alias("links"))
        return self.members.join(degree, "rep", "left").select("id", F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def _blockwise(rows: DataFrame, crowded: DataFrame, sets: DataFrame, crowd: int, numerator: int, denominator: int) -> DataFrame:
    """(a, b) of the similar pairs under crowded keys: every member goes to each pair of blocks that holds its own, and
    the pairs of blocks are the tasks."""
    blocks = F.ceil(F.col("n") / crowd)
    rows = rows.join(F.broadcast(crowded) if crowded.count() <= BROADCAST_IDS else crowded, "key").select("key", "rep", blocks.cast("int").alias("blocks"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep", "key"), F.col("blocks")).cast("int"))
    rows = rows.select("key", "rep", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).join(sets, "rep")
    rows = rows.select("key", "rep", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "words")
    return rows.groupBy("key", "lo", "hi").applyInArrow(_compare(numerator, denominator), "a long, b long")


def _compare(numerator: int, denominator: int):
    def run(table: pa.Table) -> pa.Table:
        # one (key, lo, hi): own tells the block; within one block each pair once, across blocks lo x hi
        rep, own = table.column("rep").to_numpy(), table.column("own").to_numpy()
        low, high = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        lists = table.column("words").combine_chunks()
        size = pc.list_value_length(lists).to_numpy().astype(np.int64)
        start = np.cumsum(size) - size
        flat = lists.flatten().to_numpy()
        mine = np.nonzero(own == high)[0]
        where = np.repeat(start[mine] - (np.cumsum(size[mine]) - size[mine]), size[mine]) + np.arange(size[mine].sum())
        word, owner = flat[where], np.repeat(mine, size[mine])
        order = np.argsort(word, kind="stable")
        word, owner = word[order], owner[order]
        a, b = [], []
        for i in np.nonzero(own == low)[0]:
            w = flat[start[i] : start[i] + size[i]]
            lo, n = np.searchsorted(word, w), np.searchsorted(word, w, "right")
            n -= lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common = np.bincount(owner[at], minlength=len(rep))
            j = np.nonzero(common * denominator >= (size + size[i] - common) * numerator)[0]
            j = j[(rep[j] != rep[i]) & ((low != high) | (j > i))]
            a.append(np.minimum(rep[j], rep[i]))
            b.append(np.maximum(rep[j], rep[i]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate(a) if a else none, "b": np.concatenate(b) if b else none})

    return run


FOUND_SQL = r"""
WITH c AS (SELECT id, min(text) AS text FROM chunks WHERE text IS NOT NULL GROUP BY id),
w AS (SELECT id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS ws FROM c),
l AS (SELECT id, list_transform(ws, lambda x: lower(x)) AS ws FROM w WHERE len(ws) >= 40),
s AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(ws) - 1), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2])) AS run FROM l),
n AS (SELECT id, count(*) AS size FROM s GROUP BY id),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM s a JOIN s b ON a.run = b.run AND a.id < b.id GROUP BY a.id, b.id)
SELECT a AS chunk_id_a, b AS chunk_id_b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 10 * common >= 7 * (x.size + y.size - common)
"""
CLASSES_SQL = FOUND_SQL[: FOUND_SQL.rindex("SELECT a AS chunk_id_a")] + r"""
, k AS (SELECT id, md5(string_agg(run, chr(10) ORDER BY run)) AS c FROM s GROUP BY id),
e AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 10 * common >= 7 * (x.size + y.size - common)),
li AS (SELECT a.id, count(*) AS links FROM (SELECT a AS id, b AS other FROM e UNION ALL SELECT b, a FROM e) a JOIN k x ON x.id = a.id JOIN k y ON y.id = a.other WHERE x.c <> y.c GROUP BY a.id)
SELECT k.id AS chunk_id, min(k.id) OVER (PARTITION BY k.c) AS class_id, coalesce(li.links, 0) AS links FROM k LEFT JOIN li ON li.id = k.id
"""
