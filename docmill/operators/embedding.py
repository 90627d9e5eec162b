"""Embeddings of chunk texts: a registry of models and pluggable providers.

The default model is a deterministic hashing embedder under a name of its own: signed hashes of words and word pairs
with a length normalisation. The models of the registry need a provider: ``register_transformer`` takes a folder with
an exported encoder and its tokenizer, ``register`` any factory. A model without one is refused, so vectors are never
stored under the name of a model that did not make them.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.errors import ConfigurationError
from docmill.schemas import EMBEDDING_MODELS

DEFAULT_MODEL = "hashing-384"
Encode = Callable[[list[str]], np.ndarray]
_WORD = re.compile(r"\w+")
_PROVIDERS: dict[str, Callable[[int], Encode]] = {}


def hashing_provider(dimensions: int) -> Encode:
    table: dict[str, tuple[int, float]] = {}

    def place(token: str) -> tuple[int, float]:
        if token not in table:
            if len(table) > 300_000:
                table.clear()
            h = int.from_bytes(hashlib.blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
            table[token] = (h >> 1) % dimensions, 1.0 if h & 1 else -1.0
        return table[token]

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions), np.float32)
        for n, text in enumerate(texts):
            words = _WORD.findall(text.lower())
            for token in [*words, *map(" ".join, zip(words, words[1:]))]:
                at, sign = place(token)
                out[n, at] += sign
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length > 0, length, 1)

    return encode


EMBEDDING_MODELS.setdefault(DEFAULT_MODEL, ("hash", 384, 512))
_PROVIDERS[DEFAULT_MODEL] = hashing_provider


def best_device(available: list[str], wanted: str | None = None) -> str:
    """The execution provider of the runtime: the wanted one, or an accelerator if there is one, else the processor."""
    if wanted is not None:
        if wanted not in available:
            raise ConfigurationError(f"no device {wanted}; there are: {', '.join(available)}")
        return wanted
    return next((d for d in ("CUDAExecutionProvider", "ROCMExecutionProvider", "CoreMLExecutionProvider") if d in available), "CPUExecutionProvider")


def model_files(folder: str) -> tuple[str, str]:
    """Paths of the encoder and its tokenizer; what is not there is an error, nothing is downloaded."""
    paths = tuple(os.path.join(folder, name) for name in ("model.onnx", "tokenizer.json"))
    missing = [p for p in paths if not os.path.isfile(p)]
    if missing:
        raise ConfigurationError(f"the model is not available: {', '.join(missing)}")
    return paths


def transformer_provider(folder: str, *, max_tokens: int = 512, device: str | None = None, open_session: Callable | None = None, open_tokenizer: Callable | None = None) -> Callable[[int], Encode]:
    """A factory of encoders: texts are cut at ``max_tokens`` tokens, the first position of the last layer is the vector,
    scaled to length one. ``folder`` must be readable on every executor. The two openers are for other runtimes."""

    def factory(dimensions: int) -> Encode:
        model, vocabulary = model_files(folder)
        if open_session is None:
            import onnxruntime

            session = onnxruntime.InferenceSession(model, providers=[best_device(onnxruntime.get_available_providers(), device)])
        else:
            session = open_session(model)
        if open_tokenizer is None:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(vocabulary)
        else:
            tokenizer = open_tokenizer(vocabulary)
        tokenizer.enable_truncation(max_tokens)
        tokenizer.enable_padding()
        inputs = [x.name for x in session.get_inputs()]

        def encode(texts: list[str]) -> np.ndarray:
            found = tokenizer.encode_batch(texts)
            given = {"input_ids": [f.ids for f in found], "attention_mask": [f.attention_mask for f in found], "token_type_ids": [f.type_ids for f in found]}
            hidden = session.run(None, {name: np.array(given[name], np.int64) for name in inputs})[0]
            out = np.asarray(hidden, np.float32)[:, 0, :]
            if out.shape[1] != dimensions:
                raise ConfigurationError(f"the model gives {out.shape[1]} dimensions, not {dimensions}")
            length = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(length > 0, length, 1)

        return encode

    return factory


def register_transformer(model: str, folder: str, **settings) -> None:
    """The provider of a model of the registry, checked at once."""
    model_info(model)
    model_files(folder)
    _PROVIDERS[model] = transformer_provider(folder, **settings)


def provider_of(model: str) -> Callable[[int], Encode]:
    """The factory of a model's encoders; without one the model is refused."""
    model_info(model)
    if model not in _PROVIDERS:
        raise ConfigurationError(f"no provider for the embedding model {model}: register one, or use {DEFAULT_MODEL}")
    return _PROVIDERS[model]


def register(model: str, keyword: str, dimensions: int, batch: int, factory: Callable[[int], Encode]) -> None:
    """Adds a model with its provider."""
    EMBEDDING_MODELS[model] = (keyword, dimensions, batch)
    _PROVIDERS[model] = factory


def model_info(model: str) -> tuple[str, int, int]:
    """(keyword, dimensions, batch); an unknown model is an error."""
    if model not in EMBEDDING_MODELS:
        raise ConfigurationError(f"unknown embedding model {model}; known: {', '.join(sorted(EMBEDDING_MODELS))}")
    return EMBEDDING_MODELS[model]


def embedding_filename(model: str) -> str:
    return f"{model_info(model)[0]}.json"


def embed(text: Column | str, model: str = DEFAULT_MODEL) -> Column:
    """array<float> per text; null and empty texts give null. The provider is made once per task."""
    _, dimensions, batch = model_info(model)
    factory = provider_of(model)

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = None
        for s in parts:
            out: list = [None] * len(s)
            rows = [n for n, t in enumerate(s) if t]
            for at in range(0, len(rows), batch):
                some = rows[at : at + batch]
                encode = encode or factory(dimensions)
                for n, v in zip(some, encode([s.iloc[n] for n in some])):
                    out[n] = v
            yield pd.Series(out, dtype=object)

    return run(F.col(text) if isinstance(text, str) else text)


def embed_chunks(chunk_sets: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """(doc_path, model, dimensions, chunk_index, vector, chunks_hash) from (doc_path, chunks, chunks_hash): one row for
    each chunk, so a document with very many of them is spread over batches and never gathered."""
    _, dimensions, _ = model_info(model)
    rows = chunk_sets.where(F.size("chunks") > 0).select("doc_path", "chunks_hash", F.posexplode("chunks").alias("chunk_index", "c"))
    return rows.select("doc_path", F.lit(model).alias("model"), F.lit(dimensions).alias("dimensions"), "chunk_index", embed("c.contextual_text", model).alias("vector"), "chunks_hash")
