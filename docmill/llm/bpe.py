"""Whole-corpus encoding with a public byte-level BPE, by a tokenization automaton (problem 6).

The merge list is compiled, merge by merge, into a deterministic automaton over token arcs that accepts
exactly the correct tokenizations. It starts as one state that loops on the 256 byte tokens. The gadget of a
merge ``u v -> w`` adds the arc ``w`` wherever the path ``u v`` exists and takes the arc ``v`` away after ``u``:

* the state after ``w`` starts with the arcs of the state after ``v`` (right inheritance),
* ``w`` is an arc wherever ``u`` is one (left inheritance),
* the path ``u v`` is then cut.

So a state is fully named by its last token, and an arc ``b`` out of state ``a`` is missing exactly if a gadget
cut it or it was missing when the younger of ``a`` and ``b`` was made. :meth:`Automaton.arc` evaluates that
recurrence over the (left part, right part, birth) tables the gadgets leave. The driver compiles the automaton once:
the gadget tables, the trie of arc labels and the transitions that the vocabulary's own words take, and broadcasts it.
Workers keep further transitions that their texts ask for in the same table, at most ``TRANSITIONS`` of them; beyond
that the table is the compiled one again (a bound of memory, not of results).

Encoding runs the automaton over the bytes of each pre-split word: every word has exactly one accepted path,
and the last arc into each byte position is the longest token whose arc leaves the state at its start. Equal
words are encoded once per task. Decoding emits the byte labels of the arcs.

The pattern that splits words is the vocabulary file's own; files with another kind of model, a normalizer or a
splitting that is not known here are refused.

Defined results: null and empty text give an empty list; blank text is encoded; strings that look like special
tokens are plain text; lone surrogates cannot occur in Spark strings. Time is linear in the text for any length.
"""

from __future__ import annotations

import hashlib
import json
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

#: The pre-split pattern of the public byte-level vocabulary (fixed value of the tokenizer file's kind).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Words kept per Python worker; beyond it the table starts anew (memory bound, not a result bound).
WORD_TABLE_LIMIT = 400_000
#: Transitions kept besides the compiled ones, per Python worker.
TRANSITIONS = 1_000_000


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Where the public vocabulary lies; any path may be passed to the operators instead."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"/opt/tokenizers/{name}"


def _byte_letters() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in keep}
    for n, b in enumerate(b for b in range(256) if b not in set(keep)):
        letters[chr(256 + n)] = b
    return letters


def split_pattern(spec: dict) -> str:
    """The regular expression by which a vocabulary file splits words."""
    if spec.get("normalizer"):
        raise ValueError("vocabularies with a normalizer are not supported")
    pre = spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", []) if pre.get("type") == "Sequence" else [pre]
    pattern = None
    for step in steps:
        if step.get("type") == "Split" and step.get("behavior") == "Isolated" and not step.get("invert") and "Regex" in step.get("pattern", {}) and pattern is None:
            pattern = step["pattern"]["Regex"]
        elif step.get("type") == "ByteLevel" and not step.get("add_prefix_space") and (pattern is None or not step.get("use_regex", True)):
            pattern = pattern or (SPLIT if step.get("use_regex", True) else None)
        else:
            raise ValueError(f"a splitting of words that is not supported: {step.get('type')}")
    if pattern is None or steps[-1].get("type") != "ByteLevel":
        raise ValueError("the vocabulary does not split words into bytes")
    return pattern


class Automaton:
    """The compiled merges; ``state`` and token are the same number, -1 is the start state."""

    def __init__(self, spec: bytes):
        letters = _byte_letters()
        whole = json.loads(spec)
        self.pattern = split_pattern(whole)
        model = whole["model"]
        if model.get("type", "BPE") != "BPE" or any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        vocab = model["vocab"]
        self.label: dict[int, bytes] = {}
        for text, token in vocab.items():
            if all(c in letters for c in text):
                self.label[token] = bytes(letters[c] for c in text)
        token_of = {label: token for token, label in self.label.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.birth: dict[int, int] = {t: -1 for t, label in self.label.items() if len(label) == 1}
        self.cut: dict[int, int] = {}  # (u, v) as one number -> birth of the merge that cut it
        self.table: dict[int, int] = {}  # transition table, filled on demand
        for rank, merge in enumerate(model["merges"]):
            u, v = merge.split(" ") if isinstance(merge, str) else merge
            self._gadget(vocab[u], vocab[v], vocab[u + v], rank)
        trie: list[dict[int, int]] = [{}]
        end: list[int] = [-1]
        for label, token in token_of.items():
            if token in self.birth:
                node = 0
                for b in label:
                    step = trie[node].get(b)
                    if step is None:
                        step = trie[node][b] = len(trie)
                        trie.append({})
                        end.append(-1)
                    node = step
                end[node] = token
        self.trie, self.end = trie, end
        self.whole = {label: t for label, t in token_of.items() if t in self.birth and self._own_path(t)}
        self.compiled = dict(self.table)

    def bound(self) -> None:
        """Back to the compiled transitions if too many have come besides."""
        if len(self.table) > len(self.compiled) + TRANSITIONS:
            self.table = dict(self.compiled)

    def dump(self) -> bytes:
        """The compiled automaton, to be broadcast."""
        state = dict(self.__dict__)
        state["table"] = None  # the compiled one
        return pickle.dumps(state, protocol=5)

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        out = cls.__new__(cls)
        out.__dict__.update(pickle.loads(data))
        out.table = dict(out.compiled)
        return out

    def _gadget(self, u: int, v: int, w: int, rank: int) -> None:
        self.cut[u << 20 | v] = rank
        if w not in self.birth:
            self.birth[w], self.left[w], self.right[w] = rank, u, v

    def missing_from(self, a: int, b: int) -> int:
        """The gadget (its number) since which arc ``b`` is missing after ``a``; a large number if never."""
        key = a << 20 | b
        known = self.table.get(key)
        if known is not None:
            return known
        never = 1 << 30
        found = self.cut.get(key, never)
        born_a, born_b = self.birth[a], self.birth[b]
        if born_a > born_b:  # a was made with the arcs of its right part
            inherited = self.missing_from(self.right[a], b)
            if inherited < born_a:
                found = min(found, born_a)
        elif born_b >= 0:  # b is an arc wherever its left part was one, after the cut of its own gadget
            inherited = self.missing_from(a, self.left[b])
            if inherited <= born_b:
                found = min(found, born_b)
        self.table[key] = found
        return found

    def arc(self, a: int, b: int) -> bool:
        """Whether the state after token ``a`` has the arc ``b``."""
        return a < 0 or self.missing_from(a, b) == 1 << 30

    def _own_path(self, token: int) -> bool:
        label = self.label[token]
        return len(label) == 1 or self.run(label) == [token]

    def run(self, data: bytes) -> list[int]:
        """The arcs of the one accepted path that spells ``data``."""
        n = len(data)
        if n == 1:
            return [self.end[self.trie[0][data[0]]]]
        state = [-1] * (n + 1)
        start = [0] * (n + 1)
        trie, end, table, never = self.trie, self.end, self.table, 1 << 30
        for i in range(n):
            a = state[i]
            if i and a < 0:
                continue
            node, j = 0, i
            while j < n:
                node = trie[node].get(data[j], -1)
                if node < 0:
                    break
                j += 1
                t = end[node]
                # starts come in rising order, so the first arc into j is the longest token
                if t >= 0 and state[j] < 0:
                    if a >= 0:
                        m = table.get(a << 20 | t)
                        if m is None:
                            m = self.missing_from(a, t)
                        if m != never:
                            continue
                    state[j], start[j] = t, i
        out = []
        while n:
            out.append(state[n])
            n = start[n]
        out.reverse()
        return out

    def encode_word(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        token = self.whole.get(data)
        return [token] if token is not None else self.run(data)

    def encode(self, text: str | None) -> list[int]:
        """The ids of one text."""
        return [t for w in regex.findall(self.pattern, text or "") for t in self.encode_word(w)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the labels of the arcs, one after the other."""
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", "replace")


class _Words(dict):
    """Word -> row number of (start, length) in one flat array of ids."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton
        self.ids: list[int] = []
        self.starts: list[int] = []
        self.sizes: list[int] = []
        self.arrays: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __missing__(self, word: str) -> int:
        ids = self.automaton.encode_word(word)
        row = self[word] = len(self.starts)
        self.starts.append(len(self.ids))
        self.sizes.append(len(ids))
        self.ids.extend(ids)
        self.arrays = None
        return row

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.arrays is None:
            self.arrays = np.array(self.ids, np.int32), np.array(self.starts, np.int64), np.array(self.sizes, np.int64)
        return self.arrays


class Encoder:
    """Encodes batches of texts; one per Python worker and vocabulary."""

    _made: dict[str, Encoder] = {}

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.words = _Words(self.automaton)
        self.find = regex.compile(automaton.pattern).findall

    @classmethod
    def of(cls, spec: bytes) -> Encoder:
        """The encoder of a vocabulary file's content."""
        return cls._cached(spec, Automaton)

    @classmethod
    def compiled(cls, data: bytes) -> Encoder:
        """The encoder of a compiled automaton."""
        return cls._cached(data, Automaton.load)

    @classmethod
    def _cached(cls, data: bytes, make) -> Encoder:
        key = hashlib.sha256(data).hexdigest()
        if key not in cls._made:
            cls._made[key] = cls(make(data))
        return cls._made[key]

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and the ids of all texts in one array."""
        if len(self.words) > WORD_TABLE_LIMIT:
            self.words = _Words(self.automaton)
        self.automaton.bound()
        look, find = self.words.__getitem__, self.find
        rows: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                found = find(text)
                counts[k] = len(found)
                rows.append(np.fromiter(map(look, found), np.int64, len(found)))
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        ids, starts, sizes = self.words.flat()
        if not len(row):
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32)
        size = sizes[row]
        ends = np.cumsum(size)
        where = np.repeat(starts[row] - (ends - size), size) + np.arange(ends[-1])
        word_end = np.cumsum(counts)
        offsets = np.zeros(len(texts) + 1, np.int64)
        offsets[1:] = np.where(word_end > 0, ends[np.maximum(word_end, 1) - 1], 0)
        return offsets, ids[where]


def read_spec(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def compiled(path: str) -> bytes:
    """The compiled automaton of a vocabulary file, made once per driver."""
    spec = read_spec(path)
    return Encoder.of(spec).automaton.dump()


def _slices(batch: pa.RecordBatch, column: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text each, so one task's memory stays flat."""
    texts = batch.column(column)
    if batch.num_rows == 0:
        return
    size = np.cumsum(np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(float)))
    at = 0
    while at < batch.num_rows:
        base = size[at - 1] if at else 0.0
        to = max(at + 1, int(np.searchsorted(size, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode_documents(documents: DataFrame, *, vocabulary: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids array<int>)``, one row per row of ``documents``; no shuffle.

    The automaton (some MB, fixed by the vocabulary) is compiled on the driver and broadcast. Null or empty text gives an empty
    list. Further columns of ``documents``, whatever their names, are not read.
    """
    spark = documents.sparkSession
    made = spark.sparkContext.broadcast(compiled(vocabulary or vocabulary_path()))
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.compiled(made.value)
        for whole in batches:
            for batch in _slices(whole, "t"):
                offsets, ids = encoder.batch(batch.column("t").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("k"), lists], ["k", "ids"])

    rows = documents.select(documents[key].alias("k"), documents[text].alias("t"))
    return rows.mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def count_tokens(documents: DataFrame, *, vocabulary: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens int)`` without the ids ever leaving Python."""
    spark = documents.sparkSession
    made = spark.sparkContext.broadcast(compiled(vocabulary or vocabulary_path()))
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.compiled(made.value)
        for whole in batches:
            for batch in _slices(whole, "t"):
                offsets, _ = encoder.batch(batch.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(np.diff(offsets).astype(np.int32))], ["k", "n"])

    rows = documents.select(documents[key].alias("k"), documents[text].alias("t"))
    return rows.mapInArrow(run, f"k {kind}, n int").withColumnRenamed("k", key).withColumnRenamed("n", "n_tokens")
