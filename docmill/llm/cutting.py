"""Cutting oversized items at natural boundaries, by content-defined chunking (problem 3).

A rolling hash of the last ``WINDOW`` characters marks landmarks where its value is a multiple of ``SPACING``.
A piece that starts at s ends near the first landmark at least half the capacity behind s: at the nearest line
or sentence end if one lies close, else at the nearest boundary of any kind that keeps the piece between half and
the whole capacity, else at the last boundary that still makes progress, and only where a stretch has no boundary
at all at the capacity itself (but not before a combining mark). Landmarks depend on nothing but the text around
them, so an edit moves the cuts next to it and the later ones meet the old landmarks again. The next piece starts
``overlap`` characters before the cut, at the boundary nearest to that (half to one and a half times the overlap,
and inside a word only where that window has no boundary). A piece that ends early, before a stretch without
boundaries, may be shorter than that; the next one then starts at a boundary within it. Pieces cover the item
without a gap.

Boundaries are U+0020, tab, line feed, carriage return, U+3000 and the marks 。！？; a piece ends after one.

Defined results: null items and items within the capacity give nothing here (``pieces`` can pass them as one
piece); an item of blanks is cut like any other; offsets count code points. Repeated chunk ids count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Natural boundaries: fixed values of the task.
BOUNDARIES = " \t\n\r　。！？"
LINE_ENDS = "\n\r"
SENTENCE_MARKS = "。！？"
CLOSERS = ".!?…।؟"
WINDOW, SPACING = 24, 512


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _in(c: np.ndarray, letters: str) -> np.ndarray:
    return np.isin(c, [ord(x) for x in letters])


def landmarks(c: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash marks a landmark."""
    if len(c) <= WINDOW:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(c) - WINDOW + 1, np.uint64)
        factor = np.uint64(0x9E3779B97F4A7C15)
        for k in range(WINDOW):
            h = h * factor + c[k : k + len(h)]
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.nonzero(h % np.uint64(SPACING) == 0)[0] + WINDOW


def _attached(c: int) -> bool:
    """Whether a code point belongs to the one before it (marks, joiners, selectors, skin tones)."""
    import unicodedata

    return c in (0x200D, 0x200C) or 0xFE00 <= c <= 0xFE0F or 0x1F3FB <= c <= 0x1F3FF or unicodedata.category(chr(c)).startswith("M")


def _nearest(sorted_at: np.ndarray, target: int, lo: int, hi: int) -> int:
    """The value in lo..hi nearest to target, the lower of two; -1 if none."""
    i, j = np.searchsorted(sorted_at, lo), np.searchsorted(sorted_at, hi, "right")
    if i >= j:
        return -1
    k = min(max(int(np.searchsorted(sorted_at, target)), i), j - 1)
    if k > i and target - sorted_at[k - 1] <= abs(sorted_at[k] - target):
        k -= 1
    return int(sorted_at[k])


def _unattached(c: np.ndarray, at: int, low: int) -> int:
    """``at``, or some characters before it where the next one would hang on the last."""
    back = at
    while low < back < len(c) and at - back < 32 and (_attached(int(c[back])) or c[back - 1] == 0x200D):
        back -= 1
    return back if back > low and at - back < 32 else at


def cut(text: str, capacity: int, overlap: int) -> list[tuple[int, int, bool]]:
    """(start, end, ends at a boundary) of the pieces of one item longer than the capacity."""
    c = _codes(text)
    n = len(c)
    bounds = np.nonzero(_in(c, BOUNDARIES))[0] + 1
    after_blank = np.nonzero(_in(c, " 　\t") & np.concatenate([[False], _in(c, CLOSERS)[:-1]]))[0] + 1
    strong = np.unique(np.concatenate([np.nonzero(_in(c, LINE_ENDS + SENTENCE_MARKS))[0] + 1, after_blank]))
    marks = landmarks(c)
    out, start, last = [], 0, 0
    while n - start > capacity:
        hi, lo = start + capacity, max(last + 1, start + capacity // 2)
        k = int(np.searchsorted(marks, lo))
        target = int(marks[k]) if k < len(marks) and marks[k] <= hi else hi
        end = _nearest(strong, target, max(lo, target - capacity // 8), min(hi, target + capacity // 8))
        if end < 0:
            end = _nearest(bounds, target, lo, hi)
        if end < 0:
            end = _nearest(bounds, lo, last + 1, lo)
        natural = end >= 0
        if not natural:
            end = _unattached(c, hi, last)
        out.append((start, end, natural))
        if end - start <= overlap + overlap // 2:  # a short head before a long stretch: as much of it as begins behind a boundary
            back = _nearest(bounds, end - overlap, start + 1, end)
        else:
            back = _nearest(bounds, end - overlap, end - overlap - overlap // 2, end - overlap // 2)
            back = back if back >= 0 else _unattached(c, end - overlap, start)
        start, last = back, end
    out.append((start, n, True))
    return out


def unbroken(text: str, pieces: list[tuple[int, int, bool]], capacity: int) -> list[int]:
    """Starts of the maximal stretches without a boundary that are longer than the capacity, from an item's pieces.

    Ends of consecutive pieces lie at most the capacity apart, so every such stretch has an end inside, and that end is
    at no boundary. Only stretches around such ends are measured.
    """
    forced = np.array([end for _, end, natural in pieces if not natural], np.int64)
    if not len(forced):
        return []
    c = _codes(text)
    edges = np.concatenate([[0], np.nonzero(_in(c, BOUNDARIES))[0] + 1, [len(c) + 1]])
    k = np.unique(np.searchsorted(edges, forced, "right"))
    return edges[k - 1][edges[k] - 1 - edges[k - 1] > capacity].tolist()


def cut_items(items: DataFrame, *, capacity: int, overlap: int, with_text: bool = True) -> DataFrame:
    """Cuts the oversized rows of ``items`` (item_kind, item_id, text); no shuffle.

    Returns rows of two sorts: pieces (piece >= 0, start_char, end_char, natural, text) and stretches that had to
    be cut without a boundary (piece null, start_char).
    """
    if not 0 <= overlap < capacity // 4:
        raise ValueError("the overlap must be under a quarter of the capacity")
    schema = "item_kind string, item_id long, piece int, start_char long, end_char long, natural boolean, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for kind, item, text in zip(*(batch.column(x).to_pylist() for x in ("item_kind", "item_id", "text"))):
                found = cut(text, capacity, overlap)
                rows += [(kind, item, n, a, b, natural, text[a:b] if with_text else None) for n, (a, b, natural) in enumerate(found)]
                rows += [(kind, item, None, a, None, None, None) for a in unbroken(text, found, capacity)]
                if len(rows) > 5000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        names = ["item_kind", "item_id", "piece", "start_char", "end_char", "natural", "text"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    big = items.where(F.char_length("text") > capacity).select("item_kind", F.col("item_id").cast("long").alias("item_id"), "text")
    return big.mapInArrow(run, schema)


def invariants(items: DataFrame, pieces: DataFrame, capacity: int, overlap: int) -> DataFrame:
    """(item_kind, item_id, n_chars, digest, within, natural, shared) of every oversized item, from its pieces alone.

    ``digest`` is the MD5 of the text put together again from the pieces; ``within``: no piece is over the capacity;
    ``natural``: each piece but the last ends behind a boundary, or there is none in what it adds; ``shared``: each piece
    starts behind a boundary or in an overlap without one, and shares half to one and a half times the overlap with the
    one before, unless that one is short itself.
    """
    # the pieces of one item are as large as its text, which is a row of the input
    rows = pieces.groupBy("item_kind", "item_id").agg(F.array_sort(F.collect_list(F.struct(F.col("piece").alias("n"), F.col("start_char").alias("a"), F.col("end_char").alias("b"), "natural", "text"))).alias("p"))
    bound = "[" + "".join(f"\\x{{{ord(x):x}}}" for x in BOUNDARIES) + "]"
    before = F.slice("p", F.lit(1), F.size("p") - 1)
    pairs = F.arrays_zip(before.alias("x"), F.slice("p", F.lit(2), F.size("p")).alias("y"))
    added = F.concat(F.col("p")[0]["text"], F.array_join(F.transform(pairs, lambda q: F.substring(q["y"]["text"], (q["x"]["b"] - q["y"]["a"] + 1).cast("int"), F.lit(1 << 30))), ""))
    joined = F.forall(pairs, lambda q: (q["y"]["n"] == q["x"]["n"] + 1) & (q["y"]["a"] > q["x"]["a"]) & (q["y"]["a"] <= q["x"]["b"]) & (q["y"]["b"] > q["x"]["b"]))
    natural = F.forall(before, lambda x: F.when(x["natural"], F.right(x["text"], F.lit(1)).rlike(bound)).otherwise(~F.right(x["text"], F.lit(capacity // 2)).rlike(bound)))

    def share(q):
        common, head = q["x"]["b"] - q["y"]["a"], q["x"]["b"] - q["x"]["a"]
        size = common.between(overlap // 2, overlap + overlap // 2 + 32) | (head <= overlap + overlap // 2)
        lead = F.substring(q["x"]["text"], (q["y"]["a"] - q["x"]["a"]).cast("int"), F.lit(1))
        window = F.substring(F.right(q["x"]["text"], F.lit(overlap + overlap // 2)), 1, overlap)
        return size & (lead.rlike(bound) | ~window.rlike(bound))

    whole = rows.select("item_kind", "item_id", F.char_length(added).alias("n_chars"), F.when(joined, F.md5(added)).alias("digest"), F.forall("p", lambda x: (F.char_length(x["text"]) <= capacity) & (x["b"] - x["a"] == F.char_length(x["text"]))).alias("within"), natural.alias("natural"), F.forall(pairs, share).alias("shared"))
    return items.select("item_kind", "item_id").join(whole, ["item_kind", "item_id"], "left")


def oversized_items(sources: DataFrame, chunks: DataFrame, capacity: int) -> DataFrame:
    """(item_kind, item_id, text) over the capacity; the length test runs before ids are made distinct."""
    s = sources.select(F.lit("source").alias("item_kind"), F.col("source_id").alias("item_id"), F.col("content").alias("text"))
    c = chunks.where(F.char_length("text") > capacity).groupBy(F.col("id").alias("item_id")).agg(F.min("text").alias("text"))
    return s.where(F.char_length("text") > capacity).unionByName(c.select(F.lit("chunk").alias("item_kind"), "item_id", "text"))


def budget(budgets: DataFrame, purpose: str) -> tuple[int, int]:
    """(capacity, overlap) of a purpose; the table has a row for each purpose."""
    row = budgets.where(F.col("purpose") == purpose).orderBy("budget_id").first()
    if row is None:
        raise ValueError(f"no budget for {purpose}")
    return int(row.capacity), int(row.overlap or 0)


METHOD_SQL = """
WITH b AS (SELECT capacity FROM budgets WHERE purpose = 'piece' ORDER BY budget_id LIMIT 1),
items AS (
  SELECT 'source' AS item_kind, source_id AS item_id, content AS t FROM sources
  UNION ALL SELECT 'chunk', id, min(text) FROM chunks GROUP BY id
)
SELECT item_kind, item_id, CAST(length(t) AS INT) AS n_chars, md5(t) AS digest, true AS within, true AS "natural", true AS shared FROM items, b WHERE length(t) > capacity
"""
FOUND_SQL = r"""
WITH b AS (SELECT capacity FROM budgets WHERE purpose = 'piece' ORDER BY budget_id LIMIT 1),
items AS (
  SELECT 'source' AS item_kind, source_id AS item_id, content AS t FROM sources
  UNION ALL SELECT 'chunk', id, min(text) FROM chunks GROUP BY id
), big AS (SELECT i.* FROM items i, b WHERE length(t) > capacity),
parts AS (SELECT item_kind, item_id, string_split_regex(t, '[ \t\n\r　。！？]') AS p FROM big),
flat AS (SELECT item_kind, item_id, unnest(p) AS part, generate_subscripts(p, 1) AS n FROM parts),
placed AS (SELECT *, sum(length(part) + 1) OVER (PARTITION BY item_kind, item_id ORDER BY n) - length(part) - 1 AS pos FROM flat)
SELECT item_kind, item_id, CAST(-1 AS BIGINT) AS run_start FROM big
UNION ALL SELECT item_kind, item_id, CAST(pos AS BIGINT) FROM placed, b WHERE length(part) > capacity
"""
