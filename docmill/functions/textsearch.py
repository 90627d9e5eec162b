"""English full-text vectors: words, stop words (their positions still count), Porter2 stems; match, rank, BM25."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.schemas import LEXEMES
from docmill.session import written

#: The English stop list of the Snowball project (fixed values).
STOP_WORDS = frozenset(
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves "
    "what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up down in out on off over under again further then once here there when where why how all any "
    "both each few more most other some such no nor not only own same so than too very s t can will just don should now".split()
)
_WORD = re.compile(r"[^\W_]+")
_V = "aeiouy"
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_EXCEPTIONS = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", **{w: w for w in ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")}}
_AFTER_1A = frozenset(("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"))
_STEP2 = [("ational", "ate"), ("ization", "ize"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble")]
_STEP3 = [("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"), ("ness", ""), ("ful", "")]
_STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic")


def _region(word: str, start: int) -> int:
    """Behind the first consonant after a vowel, from ``start``."""
    for k in range(start + 1, len(word)):
        if word[k] not in _V and word[k - 1] in _V:
            return k + 1
    return len(word)


def _short_end(w: str) -> bool:
    if len(w) == 2:
        return w[0] in _V and w[1] not in _V
    return len(w) > 2 and w[-1] not in _V + "wxY" and w[-2] in _V and w[-3] not in _V


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """The Porter2 stem of a lower-case word."""
    if len(word) <= 2 or not word.isascii():
        return word
    if word in _EXCEPTIONS:
        return _EXCEPTIONS[word]
    w = "".join("Y" if c == "y" and (k == 0 or word[k - 1] in _V) else c for k, c in enumerate(word))
    prefix = next((p for p in ("gener", "commun", "arsen") if w.startswith(p)), None)
    r1 = len(prefix) if prefix else _region(w, 0)
    r2 = _region(w, r1)
    # 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and any(c in _V for c in w[:-2]):
        w = w[:-1]
    if w in _AFTER_1A:
        return w
    # 1b
    if w.endswith(("eedly", "eed")):
        cut = 5 if w.endswith("eedly") else 3
        if len(w) - cut >= r1:
            w = w[:-cut] + "ee"
    else:
        for ending in ("ingly", "edly", "ing", "ed"):
            if w.endswith(ending):
                base = w[: -len(ending)]
                if any(c in _V for c in base):
                    if base.endswith(("at", "bl", "iz")):
                        base += "e"
                    elif base.endswith(_DOUBLES):
                        base = base[:-1]
                    elif len(base) <= r1 and _short_end(base):
                        base += "e"
                    w = base
                break
    # 1c
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _V:
        w = w[:-1] + "i"
    # 2
    for ending, to in _STEP2:
        if w.endswith(ending):
            if len(w) - len(ending) >= r1:
                w = w[: -len(ending)] + to
            break
    else:
        if w.endswith("ogi") and len(w) - 3 >= r1 and w[-4:-3] == "l":
            w = w[:-1]
        elif w.endswith("li") and len(w) - 2 >= r1 and w[-3:-2] in tuple("cdeghkmnrt"):
            w = w[:-2]
    # 3
    for ending, to in _STEP3:
        if w.endswith(ending):
            if len(w) - len(ending) >= r1:
                w = w[: -len(ending)] + to
            break
    else:
        if w.endswith("ative") and len(w) - 5 >= r2:
            w = w[:-5]
    # 4
    for ending in _STEP4:
        if w.endswith(ending):
            if len(w) - len(ending) >= r2:
                w = w[: -len(ending)]
            break
    else:
        if w.endswith("ion") and len(w) - 3 >= r2 and w[-4:-3] in ("s", "t"):
            w = w[:-3]
    # 5
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_end(w[:-1]))):
        w = w[:-1]
    elif w.endswith("l") and len(w) - 1 >= r2 and w[-2:-1] == "l":
        w = w[:-1]
    return w.replace("Y", "y")


def lexemes_of(text: str | None, stemmed: bool = True) -> dict[str, list[int]]:
    """Lexeme -> positions (from 1, stop words count)."""
    out: dict[str, list[int]] = {}
    for n, m in enumerate(_WORD.finditer((text or "").lower()), 1):
        w = m[0]
        if w not in STOP_WORDS:
            out.setdefault(stem(w) if stemmed else w, []).append(n)
    return out


@F.pandas_udf(LEXEMES)
def _vector_udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda t: None if t is None else [{"lexeme": w, "positions": p} for w, p in sorted(lexemes_of(t).items())])


def search_vector(text: Column | str) -> Column:
    """Sorted lexemes with positions, as a text-search vector."""
    return _vector_udf(F.col(text) if isinstance(text, str) else text)


def words(text: Column | str) -> Column:
    """Unstemmed words without stop words, in generated code: array<string>."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(*sorted(STOP_WORDS)))


def inverted_index(docs: DataFrame, *, key: str, text: str, stemmed: bool = False) -> DataFrame:
    """(term, key, tf, size): one row for each term of each document; ``size`` is the document's number of terms."""
    if stemmed:
        rows = docs.select(key, F.explode(search_vector(text)).alias("v")).select(key, F.col("v.lexeme").alias("term"), F.size("v.positions").alias("tf"))
        sizes = rows.groupBy(key).agg(F.sum("tf").alias("size"))
        return rows.join(sizes, key).select("term", key, "tf", "size")
    rows = docs.select(key, words(text).alias("ws"))
    return rows.select(key, F.size("ws").alias("size"), F.explode("ws").alias("term")).groupBy("term", key).agg(F.count("*").cast("int").alias("tf"), F.first("size").alias("size"))


def matches(vector: Column | str, query: str) -> Column:
    """Whether a text-search vector has every lexeme of the query (AND)."""
    v = F.transform(F.col(vector) if isinstance(vector, str) else vector, lambda x: x["lexeme"])
    wanted = sorted(lexemes_of(query))
    return F.size(F.array_intersect(v, F.array(*map(F.lit, wanted)))) == len(wanted) if wanted else F.lit(False)


def bm25(index: DataFrame, query: list[str], *, key: str, k1: float = 1.2, b: float = 0.75, documents: int | None = None, mean_size: float | None = None) -> DataFrame:
    """(key, score) of the documents that have a query term. The query's terms are literals, so the index is filtered
    before anything is shuffled; the corpus statistics cover all documents."""
    if documents is None or mean_size is None:
        stats = index.groupBy(key).agg(F.first("size").alias("size")).agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
        documents, mean_size = stats.n, stats.mean or 1.0
    hits = index.where(F.col("term").isin(*query))
    frequency = hits.groupBy("term").agg(F.countDistinct(key).alias("df"))
    idf = F.log(1 + (F.lit(documents) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("size") / F.lit(float(mean_size))))
    return hits.join(F.broadcast(frequency), "term").groupBy(key).agg(F.sum(part).alias("score"))


def vector_size(vector: Column | str) -> Column:
    """The number of words of a text-search vector."""
    return F.aggregate(F.col(vector) if isinstance(vector, str) else vector, F.lit(0), lambda n, x: n + F.size(x["positions"]))


def _frequency(term: str) -> Column:
    return F.aggregate("v", F.lit(0), lambda n, x: F.when(x["lexeme"] == term, F.size(x["positions"])).otherwise(n))


def bm25_vectors(rows: DataFrame, query: list[str], *, key: str, vector: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, score) from stored text-search vectors: one scan for the corpus statistics, one for the scores; no text is
    read, nothing is exploded and nothing but the statistics is shuffled."""
    terms = sorted(set(query))
    rows = rows.select(key, F.col(vector).alias("v")).where(F.size("v") > 0).withColumn("size", vector_size("v"))
    for i, t in enumerate(terms):
        rows = rows.withColumn(f"tf{i}", _frequency(t))
    counts = rows.agg(F.count("*").alias("n"), F.avg("size").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))]).first()
    score, hit = F.lit(0.0), F.lit(False)
    for i in range(len(terms)):
        df, tf = counts[f"df{i}"], F.col(f"tf{i}")
        idf = math.log(1 + (counts.n - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("size") / F.lit(float(counts.mean or 1.0))))
        hit = hit | (tf > 0)
    return rows.where(hit).select(key, score.alias("score"))


def _equal_to(term: str):
    return lambda w: w == term


def bm25_scan(docs: DataFrame, query: list[str], *, key: str, text: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The same scores straight from the texts: one scan leaves the size and the frequencies of the query's words of every
    document, a narrow table that is written; statistics (of all documents) and scores come from that. Nothing is exploded."""
    terms = sorted(set(query))
    rows = docs.select(key, words(text).alias("ws")).where(F.size("ws") > 0)
    rows = written(rows.select(key, F.size("ws").alias("size"), *[F.size(F.filter("ws", _equal_to(t))).alias(f"tf{i}") for i, t in enumerate(terms)]), "frequencies")
    counts = rows.agg(F.count("*").alias("n"), F.avg("size").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))]).first()
    if not counts.n:
        return rows.select(key, F.lit(None).cast("double").alias("score")).limit(0)
    score, hit = F.lit(0.0), F.lit(False)
    for i in range(len(terms)):
        df, tf = counts[f"df{i}"], F.col(f"tf{i}")
        idf = math.log(1 + (counts.n - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("size") / F.lit(float(counts.mean))))
        hit = hit | (tf > 0)
    return rows.where(hit).select(key, score.alias("score"))


def reciprocal_rank_fusion(left: DataFrame, right: DataFrame, *, key: str, constant: int = 60) -> DataFrame:
    """(key, rrf_score) of two ranked lists (key, rank)."""
    both = left.select(key, F.col("rank").alias("a")).join(right.select(key, F.col("rank").alias("b")), key, "full")
    return both.select(key, "a", "b", (F.coalesce(1 / (constant + F.col("a")), F.lit(0.0)) + F.coalesce(1 / (constant + F.col("b")), F.lit(0.0))).alias("rrf_score"))
