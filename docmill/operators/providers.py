"""Context providers: a document is set (and summarised if it is too long for the model), then asked for the context of
each chunk. ``LocalContext`` is deterministic; ``ChatProvider`` speaks the public chat-completions protocol."""

from __future__ import annotations

import importlib
import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import asdict, dataclass
from typing import Protocol

from docmill.errors import ConfigurationError
from docmill.functions.text import pack_words
from docmill.schemas import CHARS_PER_TOKEN, CONTEXT_LIMITS, CONTEXT_SHARE, DEFAULT_CONTEXT_LIMIT

SUMMARY_RESERVE = 600
#: Tries of a request and the wait before the second, doubled each time.
TRIES, WAIT = 4, 1.0


class ContextProvider(Protocol):
    def summarize(self, text: str) -> str: ...

    def context_for(self, chunk: str) -> str: ...

    def set_document(self, text: str) -> None: ...

    def close(self) -> None: ...


def estimate(text: str) -> int:
    return int(len(text) / CHARS_PER_TOKEN)


def usable_tokens(limit: int | None) -> int:
    return int((limit or DEFAULT_CONTEXT_LIMIT) * CONTEXT_SHARE)


def context_limit(model: str | None, override: int | None = None) -> int:
    """The override, else the model's limit, else the default."""
    return override or CONTEXT_LIMITS.get(model or "", DEFAULT_CONTEXT_LIMIT)


def map_reduce_summarize(text: str, max_tokens: int, summarize: Callable[[str], str]) -> tuple[str, int]:
    """Summary of a text of any length and the number of parts asked for: parts are summarised, joined by an empty line
    and summarised again while the result is too long. A summary that does not shrink ends it."""
    size = max_tokens - SUMMARY_RESERVE
    if size <= 0:
        raise ConfigurationError("the context limit leaves no room for a document")
    parts_asked = 0
    while True:
        parts = pack_words(text, size)
        parts_asked += len(parts)
        summary = "\n\n".join(summarize(p) for p in parts)
        if estimate(summary) <= size or len(summary) >= len(text):
            return summary, parts_asked
        text = summary


class Session:
    """Keeps the document that contexts refer to."""

    def __init__(self, limit: int | None = None):
        self.limit, self.document, self.summarized = limit, "", False

    def set_document(self, text: str) -> None:
        usable = usable_tokens(self.limit)
        self.summarized = estimate(text) > usable
        self.document = map_reduce_summarize(text, usable, self.summarize)[0] if self.summarized else text

    def summarize(self, text: str) -> str:
        raise NotImplementedError

    def close(self) -> None:
        pass


class LocalContext(Session):
    """Context without a model: the first sentence of the document. A pure function of its input."""

    def summarize(self, text: str) -> str:
        return " ".join(text.split()[:40])

    def context_for(self, chunk: str) -> str:
        first = self.document.strip().split(". ")[0].split("\n")[0]
        return "" if not first or chunk.startswith(first) else f"From a document that begins: {first[:200]}"


def messages(document: str, chunk: str) -> list[dict]:
    """The turns of a context request."""
    return [
        {"role": "system", "content": "You place passages in their document. Answer with one or two sentences."},
        {"role": "user", "content": f"Document:\n{document}"},
        {"role": "assistant", "content": "I have read the document."},
        {"role": "user", "content": f"Passage:\n{chunk}\n\nWhat is this passage about within the document?"},
    ]


def retried(call: Callable[[], dict], *, tries: int = TRIES, wait: float = WAIT, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The answer of a request that is made again after time-outs, broken connections, 429 and errors of the server."""
    for n in range(tries):
        try:
            return call()
        except urllib.error.HTTPError as e:
            if n + 1 == tries or (e.code < 500 and e.code != 429):
                raise
        except OSError:  # URLError, time-outs, resets
            if n + 1 == tries:
                raise
        sleep(wait * 2**n)
    raise AssertionError("unreachable")


class ChatProvider(Session):
    """A server with the public chat-completions interface; made on the executors, one per task."""

    #: Requests in flight for one document.
    parallel = 8

    def __init__(self, url: str, model: str, *, key: str | None = None, limit: int | None = None, timeout: float = 60.0, post: Callable[[str, dict, dict], dict] | None = None, wait: float = WAIT):
        if not url or not model:
            raise ConfigurationError("a chat provider needs a URL and a model")
        super().__init__(context_limit(model, limit))
        self.url, self.model, self.key, self.timeout, self.wait = url.rstrip("/"), model, key or os.environ.get("LLM_API_KEY"), timeout, wait
        self.post = post or self._post

    def _post(self, url: str, body: dict, headers: dict) -> dict:
        request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer)

    def _request(self, turns: list[dict], most: int) -> tuple[str, dict, dict]:
        headers = {"Authorization": f"Bearer {self.key}"} if self.key else {}
        return f"{self.url}/v1/chat/completions", {"model": self.model, "messages": turns, "temperature": 0.3, "max_tokens": most}, headers

    def _ask(self, turns: list[dict], most: int) -> str:
        got = retried(lambda: self.post(*self._request(turns, most)), wait=self.wait)
        return got["choices"][0]["message"]["content"].strip()

    def summarize(self, text: str) -> str:
        return self._ask([{"role": "system", "content": "Summarise the text; keep names and figures."}, {"role": "user", "content": text}], 500)

    def context_for(self, chunk: str) -> str:
        return self._ask(messages(self.document, chunk), 200)


class ProjectChatProvider(ChatProvider):
    """A hosted service whose chat interface takes a project and a token that is bought with an API key (the public
    text-chat interface of watsonx.ai). Key and project come from WATSONX_API_KEY and WATSONX_PROJECT_ID unless given."""

    #: Address of the token service and version of the interface (fixed values).
    TOKENS, VERSION = "https://iam.cloud.ibm.com/identity/token", "2024-10-08"

    def __init__(self, url: str, model: str, *, key: str | None = None, project: str | None = None, buy: Callable[[str], dict] | None = None, clock: Callable[[], float] = time.time, **settings):
        key, project = key or os.environ.get("WATSONX_API_KEY"), project or os.environ.get("WATSONX_PROJECT_ID")
        if not key or not project:
            raise ConfigurationError("the provider needs WATSONX_API_KEY and WATSONX_PROJECT_ID")
        super().__init__(url, model, key=key, **settings)
        self.project, self.buy, self.clock = project, buy or self._buy, clock
        self._token, self._until = "", 0.0

    def _buy(self, key: str) -> dict:
        form = urllib.parse.urlencode({"grant_type": "urn:ibm:params:oauth:grant-type:apikey", "apikey": key}).encode()
        with urllib.request.urlopen(urllib.request.Request(self.TOKENS, form), timeout=self.timeout) as answer:
            return json.load(answer)

    def _request(self, turns: list[dict], most: int) -> tuple[str, dict, dict]:
        if self.clock() > self._until - 60:
            got = retried(lambda: self.buy(self.key), wait=self.wait)
            self._token, self._until = got["access_token"], self.clock() + float(got.get("expires_in", 3600))
        body = {"model_id": self.model, "project_id": self.project, "messages": turns, "temperature": 0.3, "max_tokens": most}
        return f"{self.url}/ml/v1/text/chat?version={self.VERSION}", body, {"Authorization": f"Bearer {self._token}"}


@dataclass(frozen=True)
class Contexts:
    """What makes contexts: called by tasks, it gives a provider. Its description is part of the chunking parameters, so
    chunks are made again when it changes."""

    provider: str
    model: str | None = None
    endpoint: str | None = None
    context_limit_override: int | None = None

    def __call__(self) -> Session:
        if self.provider == "local":
            return LocalContext(self.context_limit_override)
        kind = ProjectChatProvider if self.provider == "watsonx" else ChatProvider
        return kind(self.endpoint or "", self.model or "", limit=self.context_limit_override)

    def description(self) -> dict:
        return {k: v for k, v in asdict(self).items() if v is not None}


#: Defaults of contexts (fixed values of the command line).
DEFAULT_URL, DEFAULT_CONTEXT_MODEL = "http://localhost:11434", "qwen2.5:7b-instruct"


def provider_factory(*, skip_context: bool = True, provider: str | None = None, url: str | None = None, watsonx_url: str | None = None, model: str | None = None, limit: int | None = None, local: bool = False) -> Contexts | None:
    """What tasks call for a provider; None if contexts are switched off. The provider follows from the URL given; an
    unclear choice is an error."""
    if skip_context:
        return None
    if local:
        return Contexts("local", context_limit_override=limit)
    if url and watsonx_url:
        raise ConfigurationError("two URLs are given; which provider is meant?")
    kind = {"openai": "openai_compatible", None: "watsonx" if watsonx_url else "openai_compatible"}.get(provider, provider)
    if kind not in ("openai_compatible", "watsonx"):
        raise ConfigurationError(f"unknown provider {provider}: openai or watsonx")
    if (kind == "watsonx") != bool(watsonx_url) and (watsonx_url or kind == "watsonx"):
        raise ConfigurationError("provider and URL do not belong together")
    if kind == "openai_compatible" and not url and not provider:
        raise ConfigurationError("contexts need a provider: give a URL or name one")
    return Contexts(kind, model or DEFAULT_CONTEXT_MODEL, watsonx_url or url or DEFAULT_URL, limit)


class FunctionProvider(Session):
    """Any other client (a vendor's SDK, a local model) as one function from turns and a token limit to a text. The
    function is imported by name on the executors, so its library is needed there only."""

    def __init__(self, function: str | Callable[[list[dict], int], str], *, model: str | None = None, limit: int | None = None):
        super().__init__(context_limit(model, limit))
        if isinstance(function, str):
            module, _, name = function.rpartition(".")
            try:
                function = getattr(importlib.import_module(module), name)
            except (ImportError, AttributeError, ValueError) as e:
                raise ConfigurationError(f"no provider function {function}: {e}") from None
        self.ask = function

    def summarize(self, text: str) -> str:
        return self.ask([{"role": "system", "content": "Summarise the text; keep names and figures."}, {"role": "user", "content": text}], 500).strip()

    def context_for(self, chunk: str) -> str:
        return self.ask(messages(self.document, chunk), 200).strip()
