"""Structure-aware chunks of parsed documents, with a heading path and optional generated context.

Sections are walked in order; a block over the token budget is cut at sentence ends, then at words; neighbouring
pieces under the same headings are merged up to the budget, in which the heading path counts. Tokens are counted by
``ChunkParameters.count``: an estimate of a third of the characters, or a tokenizer file, which is right for scripts
with more than one token a character as well.

A chunk's text is its heading path and passage, its contextual text the generated context before that. A context that
fails after its retries leaves the chunk without one; how many did is kept, and the document is made again next time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.schemas import CHARS_PER_TOKEN, CHUNKER, MAX_TOKENS, MERGE_PEERS, TOKENIZER_MODEL

CHUNK_ROWS = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("text", "contextual_text", "metadata")]))


@dataclass(frozen=True)
class ChunkParameters:
    max_tokens: int = MAX_TOKENS
    merge_peers: bool = MERGE_PEERS
    tokenizer_model: str = TOKENIZER_MODEL
    chunker: str = CHUNKER
    #: A tokenizer file that every executor can read; without it tokens are estimated.
    tokenizer_file: str | None = None
    #: What makes contexts, as text; see :class:`docmill.operators.providers.Contexts`.
    contexts: str | None = None

    def as_json(self) -> str:
        return json.dumps({k: v for k, v in asdict(self).items() if v is not None}, sort_keys=True)

    def count(self) -> Callable[[str], int]:
        """The number of tokens of a text."""
        return _file_counter(self.tokenizer_file) if self.tokenizer_file else tokens


def tokens(text: str) -> int:
    return int(len(text) / CHARS_PER_TOKEN)


@lru_cache(maxsize=4)
def _file_counter(path: str) -> Callable[[str], int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    return lru_cache(maxsize=50_000)(lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids))


def _longest(text: str, most: int, count: Callable[[str], int]) -> int:
    """How many characters from the start fit, at least one; by halving, so a long word is counted few times."""
    lo, hi = 1, min(len(text), max(2, most * 16))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if count(text[:mid]) <= most else (lo, mid - 1)
    return lo


def _fit(text: str, most: int, count: Callable[[str], int]) -> list[str]:
    """The text in parts of at most ``most`` tokens, cut at sentence ends, else at words, else anywhere."""
    if count(text) <= most:
        return [text]
    out: list[str] = []
    held, size = "", 0

    def add(part: str, n: int) -> None:
        nonlocal held, size
        if held and size + n + 1 <= most and count(f"{held} {part}") <= most:
            held += " " + part
            size = count(held)
        else:
            if held:
                out.append(held)
            held, size = part, n

    for sentence in re.split(r"(?<=[.!?。！？])\s+", text):
        n = count(sentence)
        if n <= most:
            add(sentence, n)
            continue
        for word in sentence.split():
            n = count(word)
            while n > most:  # one word over the budget
                cut = _longest(word, most, count)
                add(word[:cut], count(word[:cut]))
                word = word[cut:]
                n = count(word)
            if word:
                add(word, n)
    return [*out, held] if held else out


def structural_chunks(blocks: list[dict] | None, p: ChunkParameters) -> list[dict]:
    """Chunks (text, headings, page) of a block list."""
    count = p.count()
    headings: list[tuple[int, str]] = []
    known: list[str] = []
    room = p.max_tokens
    out: list[dict] = []
    for b in blocks or []:
        text = (b["text"] or "").replace("\u00a0", " ").strip()
        if not text or b["kind"] == "title":
            continue
        if b["kind"] == "heading":
            level = b["level"] or 1
            headings = [h for h in headings if h[0] < level] + [(level, text)]
            continue
        path = [h for _, h in headings]
        if path != known:
            known, room = path, max(p.max_tokens // 2, p.max_tokens - sum(count(h) + 1 for h in path))
        for piece in _fit(text, room, count):
            last = out[-1] if out else None
            glue = "\n" if b["kind"] in ("list_item", "table_row") else "\n\n"
            if p.merge_peers and last and last["headings"] == path and count(last["text"] + glue + piece) <= room:
                last["text"] += glue + piece
            else:
                out.append({"text": piece, "headings": path, "page": b["page"]})
    return out


def contextualized(chunk: dict) -> str:
    """The heading path, line by line, before the text."""
    return "\n".join([*chunk["headings"], chunk["text"]])


def contexts_of(session, texts: list[str]) -> tuple[list[str | None], int]:
    """The contexts of a document's chunks, with several requests in flight if the provider allows it, and how many failed."""

    def one(text: str) -> tuple[str | None, int]:
        try:
            return session.context_for(text), 0
        except Exception:  # the chunk does without
            return None, 1

    parallel = min(getattr(session, "parallel", 1), len(texts))
    if parallel > 1:
        with ThreadPoolExecutor(parallel) as pool:
            found = list(pool.map(one, texts))
    else:
        found = [one(t) for t in texts]
    return [c for c, _ in found], sum(n for _, n in found)


def chunk_documents(documents: DataFrame, parameters: ChunkParameters = ChunkParameters(), *, blocks: str = "blocks", provider=None) -> DataFrame:
    """Adds ``chunks`` (text, contextual_text, metadata), ``chunk_error``, ``summarized`` and ``failed_contexts``.
    ``provider`` is a factory of a context provider (see :mod:`docmill.operators.providers`), made once per task and only
    if the task has rows."""
    kept = documents.columns
    added = [T.StructField("chunks", CHUNK_ROWS), T.StructField("chunk_error", T.StringType()), T.StructField("summarized", T.BooleanType()), T.StructField("failed_contexts", T.IntegerType())]
    schema = T.StructType([*documents.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session = None
        for batch in batches:
            all_chunks, errors, summarized, failed = [], [], [], []
            for found in batch.column(blocks).to_pylist():
                summary, missing = False, 0
                try:
                    rows = structural_chunks(found, parameters)
                    texts = [contextualized(r) for r in rows]
                    contexts: list[str | None] = [None] * len(rows)
                    if provider is not None and rows:
                        session = session or provider()
                        session.set_document("\n\n".join(r["text"] for r in rows))
                        summary = bool(getattr(session, "summarized", False))
                        contexts, missing = contexts_of(session, texts)
                    all_chunks.append([
                        {"text": t, "contextual_text": f"{c}\n\n{t}" if c else t, "metadata": json.dumps({"headings": r["headings"], "page": r["page"]})} for r, t, c in zip(rows, texts, contexts)
                    ])
                    errors.append(None)
                except Exception as e:
                    all_chunks.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
                summarized.append(summary)
                failed.append(missing)
            if session is not None and hasattr(session, "flush"):
                session.flush()
            kind = pa.list_(pa.struct([("text", pa.string()), ("contextual_text", pa.string()), ("metadata", pa.string())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(all_chunks, kind), pa.array(errors, pa.string()), pa.array(summarized, pa.bool_()), pa.array(failed, pa.int32())], [*kept, *(f.name for f in added)])

    return documents.mapInArrow(run, schema)


def chunks_hash(chunks):
    """Hash of the canonical content of the chunks (no clock in it, so equal text keeps its embeddings fresh)."""
    from docmill.functions.hashing import content_hash

    return content_hash(F.to_json(chunks))
