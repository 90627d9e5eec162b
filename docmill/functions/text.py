"""Column functions on paths, names, texts and settings; all inside generated code unless noted."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.schemas import CHARS_PER_TOKEN, CONTENT_TYPES, GUESSED_TYPES, INGESTIBLE_SUFFIXES


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def suffix(path: Column | str) -> Column:
    """The last suffix with its dot, lower-cased; empty for none and for dot-files."""
    return F.lower(F.regexp_extract(_c(path), r"[^/.][^/]*(\.[^./]+)$", 1))


def is_ingestible(path: Column | str) -> Column:
    return suffix(path).isin(*INGESTIBLE_SUFFIXES)


def _by_suffix(path: Column | str, kinds: dict[str, str]) -> Column:
    s = suffix(path)
    out = F.lit("application/octet-stream")
    for ending, kind in kinds.items():
        out = F.when(s == ending, kind).otherwise(out)
    return out


def content_type(path: Column | str) -> Column:
    """Type of a stored document by suffix, application/octet-stream for unknown ones."""
    return _by_suffix(path, CONTENT_TYPES)


def guessed_type(path: Column | str) -> Column:
    """Media type of a source file by suffix, with all that is ingested."""
    return _by_suffix(path, GUESSED_TYPES)


def pretty_size(size: Column | str) -> Column:
    """A number of bytes as shown: below ten units of the next size in the smaller one, rounded half up."""
    n = F.abs(_c(size).cast("long"))
    sign = F.when(_c(size) < 0, F.lit("-")).otherwise(F.lit(""))
    out, scale = None, 1
    steps = ["bytes", "kB", "MB", "GB", "TB", "PB"]
    for k, unit in enumerate(steps):
        shown = F.floor((n + scale // 2) / F.lit(scale)) if k else n
        text = F.concat(sign, shown.cast("string"), F.lit(f" {unit}"))
        fits = (shown < 10240) if unit != steps[-1] else F.lit(True)
        out = F.when(fits, text) if out is None else out.when(fits, text)
        scale *= 1024
    return out


def stem(path: Column | str) -> Column:
    """The path without the last suffix (a dot-file keeps its name)."""
    return F.regexp_replace(_c(path), r"(?<=[^/])\.[^./]*$", "")


def content_path(relative: Column | str, base: str = "") -> Column:
    """Where a source lies in the content tree: base / parent / stem."""
    return F.concat(F.lit(f"{base.rstrip('/')}/" if base else ""), stem(relative))


def display_path(path: Column | str) -> Column:
    """A document path as shown: without ``/source.json``."""
    return F.regexp_replace(_c(path), r"/source\.json$", "")


def glob_regex(pattern: str) -> str:
    """A glob as a regular expression: ``**`` spans levels, ``*`` and ``?`` stay within one."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if pattern.startswith("**/", i):
            out, i = out + "(?:[^/]+/)*", i + 3
            continue
        if pattern.startswith("**", i):
            out, i = out + ".*", i + 2
            continue
        out += "[^/]*" if c == "*" else "[^/]" if c == "?" else c if c.isalnum() or c in "_/" else "\\" + c
        i += 1
    return f"^{out}$"


def estimate_tokens(text: Column | str) -> Column:
    """Code points divided by three, rounded down."""
    return F.floor(F.char_length(_c(text)) / CHARS_PER_TOKEN).cast("int")


def replace_nbsp(text: Column | str) -> Column:
    return F.translate(_c(text), "\u00a0", " ")


def contextual_text(context: Column | str, text: Column | str) -> Column:
    """Context, an empty line and the text; the text alone without context."""
    return F.concat_ws("\n\n", _c(context), _c(text))


def iso_utc(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def shown_time(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm")


def preview(text: Column | str, size: int = 100) -> Column:
    """The first characters, with an ellipsis if there are more."""
    return F.when(F.char_length(_c(text)) > size, F.concat(F.substring(_c(text), 1, size), F.lit("..."))).otherwise(_c(text))


def parse_bool(text: Column | str) -> Column:
    """struct(value, clear): ``none`` clears; true/t/yes/y/1 and false/f/no/n/0; anything else is an error; null is null."""
    low = F.lower(_c(text))
    value = F.when(low.isin("true", "t", "yes", "y", "1"), F.lit(True)).when(low.isin("false", "f", "no", "n", "0"), F.lit(False)).when(low == "none", F.lit(None)).when(low.isNotNull(), F.raise_error(F.concat(F.lit("not a boolean: "), low)).cast("boolean"))
    return F.struct(value.alias("value"), F.coalesce(low == "none", F.lit(False)).alias("clear"))


def parse_number(text: Column | str, kind: str = "int") -> Column:
    """struct(value, clear): ``none`` clears; otherwise a number (padding and single underscores allowed) or an error."""
    low = F.lower(_c(text))
    digits = F.regexp_replace(F.trim(low), r"(?<=\d)_(?=\d)", "")
    number = (F.when(digits.rlike(r"^[+-]?\d+$"), digits) if kind in ("int", "bigint") else digits).try_cast(kind)
    value = F.when(low == "none", F.lit(None)).when(low.isNotNull() & number.isNull(), F.raise_error(F.concat(F.lit("not a number: "), low)).cast(kind)).otherwise(number)
    return F.struct(value.alias("value"), F.coalesce(low == "none", F.lit(False)).alias("clear"))


def parse_prompt(text: Column | str) -> Column:
    """struct(value, clear): exactly ``None`` clears."""
    t = _c(text)
    return F.struct(F.when(t != "None", t).alias("value"), F.coalesce(t == "None", F.lit(False)).alias("clear"))


def pack_words(text: str | None, max_tokens: int) -> list[str]:
    """Greedy chunks of whole words: at most ``max_tokens`` estimated tokens, counting a space behind every word; a
    longer single word stays whole; white space is folded; empty text gives none."""
    most = int(max_tokens * CHARS_PER_TOKEN)
    words = (text or "").split()
    ends = list(accumulate(len(w) + 1 for w in words))
    out: list[str] = []
    start = held = 0
    while start < len(words):
        end = max(start + 1, bisect_right(ends, held + most, start))
        out.append(" ".join(words[start:end]))
        start, held = end, ends[end - 1]
    return out


def greedy_chunks(text: Column | str, max_tokens: int) -> Column:
    """:func:`pack_words` as array<string>; an Arrow-batched UDF, since a fold in SQL is several times slower."""

    @F.pandas_udf("array<string>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda t: pack_words(t, max_tokens))

    return run(_c(text))
