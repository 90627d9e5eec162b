"""Table schemas and the small registries."""

from __future__ import annotations

from pyspark.sql import types as T

DB_SCHEMA_VERSION = "1.0.0"
METADATA_SCHEMA_VERSION = "1.0"
CHUNKING_SCHEMA_VERSION = "1.0"
EMBEDDING_SCHEMA_VERSION = "1.0"
#: Chunking parameters: fixed values of the data format.
CHUNKER, MAX_TOKENS, MERGE_PEERS, TOKENIZER_MODEL = "HybridChunker", 450, True, "ibm-granite/granite-embedding-30m-english"
CHARS_PER_TOKEN = 3.0

_ = T.StructField


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


S, L, I, TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()  # noqa: E741
DOCUMENTS = _struct(("id", L), ("path", S), ("filename", S), ("content_type", S), ("file_size", L), ("last_modified", TS), ("chunks_file_path", S), ("created_at", TS), ("updated_at", TS))
LEXEMES = T.ArrayType(_struct(("lexeme", S), ("positions", T.ArrayType(I))))
CHUNKS = _struct(("id", L), ("document_id", L), ("chunk_index", I), ("text", S), ("contextual_text", S), ("metadata", S), ("text_search_vector", LEXEMES), ("created_at", TS))
MODELS = _struct(("id", L), ("name", S), ("dimensions", I), ("provider", S), ("description", S), ("created_at", TS))
EMBEDDINGS = _struct(("id", L), ("chunk_id", L), ("model", L), ("embedding", T.ArrayType(T.FloatType())), ("created_at", TS))
SCHEMA_METADATA = _struct(("id", I), ("title", S), ("description", S), ("schema_version", S), ("embedding_models_count", I), ("last_modified_at", TS))
SCHEMA_CHANGES = _struct(
    ("id", L), ("changed_at", TS), ("changed_by_tool", S), ("changed_by_version", S), ("changed_by_user", S), ("documents_added", I), ("documents_deleted", I), ("chunks_added", I),
    ("chunks_deleted", I), ("embeddings_added", I), ("embeddings_deleted", I), ("embedding_models_added", T.ArrayType(S)), ("schema_version", S), ("notes", S),
)
RAG_SETTINGS = _struct(
    ("id", I), ("refinement_prompt", S), ("enable_refinement", T.BooleanType()), ("enable_reranking", T.BooleanType()), ("similarity_threshold", T.DoubleType()), ("max_chunks", I),
    ("max_tokens_in_context", I), ("refinement_questions_count", I), ("updated_at", TS),
)
TABLES = {
    "documents": DOCUMENTS, "chunks": CHUNKS, "models": MODELS, "embeddings": EMBEDDINGS, "schema_metadata": SCHEMA_METADATA, "schema_changes": SCHEMA_CHANGES, "rag_settings": RAG_SETTINGS,
}
#: Parsed source: the block list of a document.
BLOCKS = T.ArrayType(_struct(("kind", S), ("level", I), ("text", S), ("page", I)))
META = _struct(
    ("metadata_version", S),
    ("processing", _struct(("ingested_at", S), ("source_hash", S), ("docling_version", S))),
    ("filesystem", _struct(("original_path", S), ("size_bytes", L), ("mtime", S), ("detected_mime", S))),
    ("content", _struct(("title", S), ("language", S))),
    ("source", T.MapType(S, S)),
)

# Registries: fixed values of the data format.
#: model name -> keyword, dimensions, batch size
EMBEDDING_MODELS = {
    "ibm-granite/granite-embedding-30m-english": ("gran", 384, 64),
    "ibm/slate-125m-english-rtrvr-v2": ("slate", 768, 2000),
    "avsolatorio/NoInstruct-small-Embedding-v0": ("noins", 384, 32),
    "intfloat/e5-small-v2": ("e5sm", 384, 32),
}
#: context limits of language models in tokens; unknown models have the default
CONTEXT_LIMITS = {
    "ibm/granite-3-8b-instruct": 131072,
    "ibm/granite-3-2-8b-instruct": 8192,
    "ibm/granite-3-2b-instruct": 8192,
    "ibm/granite-3-3-8b-instruct": 8192,
    "meta-llama/llama-3-3-70b-instruct": 8192,
    "meta-llama/llama-3-1-70b-gptq": 131072,
    "meta-llama/llama-3-1-8b": 131072,
    "meta-llama/llama-3-405b-instruct": 131072,
    "qwen2.5:7b-instruct": 32768,
    "qwen2.5:3b-instruct": 32768,
    "qwen2.5:1.5b-instruct": 32768,
    "llama3.2:3b": 131072,
    "llama3.2:1b": 131072,
    "gemma2:2b": 8192,
    "gpt-4o-mini": 128000,
    "gpt-4o": 128000,
    "gpt-3.5-turbo": 16385,
}
DEFAULT_CONTEXT_LIMIT, CONTEXT_SHARE = 32768, 0.7
INGESTIBLE_SUFFIXES = (".html", ".htm", ".pdf", ".docx", ".pptx", ".xlsx", ".md", ".csv")
CONTENT_TYPES = {".json": "application/json", ".txt": "text/plain", ".md": "text/markdown", ".html": "text/html", ".pdf": "application/pdf"}
#: types that are guessed for the files that are ingested (registered media types)
GUESSED_TYPES = CONTENT_TYPES | {
    ".htm": "text/html", ".csv": "text/csv",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}
