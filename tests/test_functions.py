import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill import config
from docmill.errors import ConfigurationError
from docmill.functions import hashing
from docmill.functions import text as tx
from docmill.functions import textsearch as ts
from docmill.functions import vectors as vx
from docmill.operators import embedding, providers
from docmill.operators import staleness as st
from docmill.operators.chunking import ChunkParameters, structural_chunks
from docmill.operators.upsert import upsert
from docmill.sources import discovery
from docmill.sources.extract import parse, parse_csv, parse_html


def values(spark, rows, column):
    frame = spark.createDataFrame([(r,) for r in rows], "x string")
    return {r.x: r.y for r in frame.select("x", column(F.col("x")).alias("y")).collect()}


def test_hash_vectors(spark):
    assert hashing.hash_bytes(b"") == "xxh64:ef46db3751d8e999" and hashing.hash_bytes(b"abc") == "xxh64:44bc2cf5ad770999"
    for data in (b"", b"a", b"0123456", bytes(range(256)) * 3, "日本".encode()):
        assert f"{hashing._xxh64(data):016x}" == hashing.hash_bytes(data)[6:]
    assert values(spark, ["abc", None, ""], hashing.content_hash) == {"abc": "xxh64:44bc2cf5ad770999", None: None, "": "xxh64:ef46db3751d8e999"}


def test_paths(spark):
    assert values(spark, ["a/b.v1.HTML", ".x", "a/.md", "n", None], tx.suffix) == {"a/b.v1.HTML": ".html", ".x": "", "a/.md": "", "n": "", None: None}
    assert values(spark, ["a/b.v1.htm", ".x", "d.d/n"], tx.content_path) == {"a/b.v1.htm": "a/b.v1", ".x": ".x", "d.d/n": "d.d/n"}
    assert values(spark, ["a.PDF", "b.exe"], tx.content_type) == {"a.PDF": "application/pdf", "b.exe": "application/octet-stream"}
    import re

    for pattern, path, hit in (("a/*", "a/b", True), ("a/*", "a/b/c", False), ("**/c", "a/b/c", True), ("**/c", "c", True), ("a?.x", "ab.x", True), ("a.x", "abx", False)):
        assert bool(re.match(tx.glob_regex(pattern), path)) == hit
    frame = spark.createDataFrame([("a/b/x",), ("a/y",), ("c/z",), ("top",)], "path string")
    assert {r.folder for r in discovery.leaf_folders(frame).collect()} == {"a/b", "c"}


def test_greedy_packing(spark):
    assert tx.pack_words("", 5) == tx.pack_words(None, 5) == tx.pack_words("  \u2003\n", 5) == []
    assert tx.pack_words("aaaa bbbb cccc", 5) == ["aaaa bbbb cccc"]
    assert tx.pack_words("aaaa bbbbb cccc", 5) == ["aaaa bbbbb", "cccc"]
    assert tx.pack_words("x" * 99 + " y", 5) == ["x" * 99, "y"]
    assert values(spark, ["abcd", "", None], tx.estimate_tokens) == {"abcd": 1, "": 0, None: None}
    assert values(spark, ["a\u00a0b"], tx.replace_nbsp) == {"a\u00a0b": "a b"}


def test_needs_update_table(spark):
    rows = [(False, True, "t", "t", None, None, True), (True, True, None, "t", None, "h", False), (True, False, "t", None, None, None, True), (True, True, "t", None, None, None, True), (True, True, "t", "u", None, None, True),
            (True, True, "t", "t", None, None, False), (True, True, None, None, "h", None, True), (True, True, None, None, "h", "g", True), (True, True, None, None, "h", "h", False), (True, True, "t", "t", "h", "g", True)]
    f = spark.createDataFrame(rows, "e boolean, m boolean, gt string, st string, gh string, sh string, want boolean")
    c = F.col
    out = f.select("want", st.needs_update(exists=c("e"), has_meta=c("m"), given_time=c("gt"), stored_time=c("st"), given_hash=c("gh"), stored_hash=c("sh")).alias("got")).collect()
    assert all(r.want == r.got for r in out)


def test_structural_chunks():
    p = ChunkParameters(max_tokens=10)
    block = lambda kind, text, level=None: {"kind": kind, "level": level, "text": text, "page": 1}
    got = structural_chunks([block("heading", "A", 1), block("text", "one two"), block("text", "three"), block("heading", "B", 2), block("text", "w " * 40), block("heading", "C", 1), block("text", "x" * 70)], p)
    assert got[0] == {"text": "one two\n\nthree", "headings": ["A"], "page": 1}
    assert all(len(c["text"]) <= 32 for c in got) and got[1]["headings"] == ["A", "B"] and got[-1]["headings"] == ["C"]
    assert structural_chunks(None, p) == structural_chunks([], p) == []


def test_chunks_by_a_tokenizer(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.WordLevel({"[UNK]": 0}, unk_token="[UNK]"))
    t.pre_tokenizer = pre_tokenizers.Split("", "isolated")  # every character is a token
    t.save(str(tmp_path / "t.json"))
    p = ChunkParameters(max_tokens=40, tokenizer_file=str(tmp_path / "t.json"))
    blocks = [{"kind": "heading", "level": 1, "text": "見出し", "page": None}, {"kind": "text", "level": None, "text": "語" * 130 + "。 " + "word " * 30, "page": None}]
    got = structural_chunks(blocks, p)
    assert all(len(c["text"]) + 4 <= 40 for c in got) and "".join(c["text"] for c in got).replace(" ", "") == ("語" * 130 + "。" + "word" * 30)
    estimated = structural_chunks(blocks, ChunkParameters(max_tokens=40))
    assert max(len(c["text"]) for c in estimated) > 100  # a third of the characters is far off here


def test_sizes_and_media_types(spark):
    frame = spark.createDataFrame([(0,), (10239,), (10240,), (10485247,), (10485248,), (5 << 30,), (123 << 40,), (-20480,), (None,)], "n long")
    assert [r[0] for r in frame.select(tx.pretty_size("n")).collect()] == ["0 bytes", "10239 bytes", "10 kB", "10239 kB", "10 MB", "5120 MB", "123 TB", "-20 kB", None]
    assert values(spark, ["a.DOCX", "b.csv", "c.htm", "d.x"], tx.guessed_type) == {"a.DOCX": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "b.csv": "text/csv", "c.htm": "text/html", "d.x": "application/octet-stream"}


def test_work_list_tries_failures_again(spark):
    current = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), (None, "1")], "k string, h string")
    stored = spark.createDataFrame([("a", "1", None), ("b", "1", "failed"), ("c", "0", None), (None, "1", None)], "k string, h string, error string")
    pick = lambda **s: {r.k for r in st.work_list(current, stored, ["k"], ["h"], **s).collect()}
    assert pick() == {"c"} and pick(failed=F.col("error").isNotNull()) == {"b", "c"} and pick(force=True) == {"a", "b", "c", None}


def test_extractors():
    title, blocks = parse_html("<p>a<p>b<script>x = '</p>'</script><h2>H")
    assert title == "H" and [b[:3] for b in blocks] == [("text", None, "a"), ("text", None, "b"), ("heading", 2, "H")]
    assert parse_csv("\ufeffa,b\n\"x\ny\",2\n".encode())[1][1][2] == "x\ny | 2"
    with pytest.raises(ValueError):
        parse("x.pdf", b"")


def test_providers():
    summary, parts = providers.map_reduce_summarize("word " * 4000, 1000, lambda t: t[:50])
    assert parts == 17 and providers.estimate(summary) <= 400
    with pytest.raises(ConfigurationError):
        providers.map_reduce_summarize("x", 600, str)
    with pytest.raises(ConfigurationError):
        providers.provider_factory(skip_context=False)
    assert providers.context_limit("gemma2:2b") == 8192 and providers.context_limit("x") == 32768 and providers.context_limit("x", 5) == 5 and providers.usable_tokens(8192) == 5734
    local = providers.FunctionProvider(lambda turns, most: f" {turns[-1]['content'][:4]}{most} ", limit=50)
    local.set_document("word " * 10)
    assert local.context_for("c") == "Pass200" and not local.summarized
    with pytest.raises(ConfigurationError):
        providers.FunctionProvider("no.such.function")
    sent = []
    chat = providers.ChatProvider("http://h/", "m", limit=100, post=lambda url, body, headers: sent.append((url, body)) or {"choices": [{"message": {"content": " ok "}}]})
    chat.set_document("short")
    assert chat.context_for("c") == "ok" and sent[0][0] == "http://h/v1/chat/completions" and [m["role"] for m in sent[0][1]["messages"]] == ["system", "user", "assistant", "user"]


def test_requests_are_tried_again():
    from urllib.error import HTTPError, URLError

    waits, answers = [], [URLError("reset"), HTTPError("u", 503, "busy", {}, None), {"ok": 1}]

    def call():
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    assert providers.retried(call, sleep=waits.append) == {"ok": 1} and waits == [1.0, 2.0]
    answers[:] = [HTTPError("u", 401, "no", {}, None)]
    with pytest.raises(HTTPError):
        providers.retried(call, sleep=waits.append)
    answers[:] = [TimeoutError()] * 9
    with pytest.raises(TimeoutError):
        providers.retried(call, sleep=waits.append)
    assert len(answers) == 5


def test_project_provider_buys_tokens(monkeypatch):
    monkeypatch.delenv("WATSONX_API_KEY", raising=False)
    with pytest.raises(ConfigurationError):
        providers.ProjectChatProvider("http://h", "m")
    now, sent, bought = [1000.0], [], []
    p = providers.ProjectChatProvider("http://h/", "m", key="k", project="p", clock=lambda: now[0], buy=lambda key: bought.append(key) or {"access_token": f"t{len(bought)}", "expires_in": 600}, post=lambda url, body, headers: sent.append((url, body, headers)) or {"choices": [{"message": {"content": " yes "}}]})
    p.set_document("doc")
    assert p.context_for("c") == "yes" == p.summarize("x")
    now[0] += 700
    p.context_for("c")
    assert bought == ["k", "k"] and sent[0][0].startswith("http://h/ml/v1/text/chat?version=") and sent[0][1]["project_id"] == "p" and [s[2]["Authorization"] for s in sent] == ["Bearer t1", "Bearer t1", "Bearer t2"]


def test_choice_of_contexts():
    f = providers.provider_factory
    assert f() is None and f(skip_context=False, local=True).description() == {"provider": "local"}
    assert f(skip_context=False, url="http://h").description() == {"provider": "openai_compatible", "model": "qwen2.5:7b-instruct", "endpoint": "http://h"}
    assert f(skip_context=False, watsonx_url="http://w", model="m", limit=9).description() == {"provider": "watsonx", "model": "m", "endpoint": "http://w", "context_limit_override": 9}
    assert f(skip_context=False, provider="openai").endpoint == "http://localhost:11434"
    for bad in ({}, {"provider": "watsonx"}, {"provider": "other", "url": "u"}, {"url": "u", "watsonx_url": "w"}, {"provider": "openai", "watsonx_url": "w"}):
        with pytest.raises(ConfigurationError):
            f(skip_context=False, **bad)


def test_models_without_a_provider_are_refused(spark, tmp_path):
    for model in ("ibm-granite/granite-embedding-30m-english", "intfloat/e5-small-v2"):
        with pytest.raises(ConfigurationError):
            embedding.embed("t", model)
        with pytest.raises(ConfigurationError):
            embedding.register_transformer(model, str(tmp_path))
    (tmp_path / "model.onnx").write_text("")
    (tmp_path / "tokenizer.json").write_text("")

    class Tokens:
        def __init__(self, text):
            self.ids, self.attention_mask, self.type_ids = [len(text), 1], [1, 1], [0, 0]

    class Tokenizer:
        def enable_truncation(self, n):
            self.most = n

        def enable_padding(self):
            pass

        def encode_batch(self, texts):
            return [Tokens(t[: self.most]) for t in texts]

    class Input:
        name = "input_ids"

    class Session:
        def get_inputs(self):
            return [Input()]

        def run(self, names, given):
            ids = given["input_ids"].astype(float)
            return [np.stack([np.stack([ids[:, 0], ids[:, 0] * 0 + 1], 1), np.ones((len(ids), 2))], 1)]

    made = embedding.transformer_provider(str(tmp_path), max_tokens=3, open_session=lambda p: Session(), open_tokenizer=lambda p: Tokenizer())
    assert np.allclose(made(2)(["a", "abcdef"]), [[2**-0.5, 2**-0.5], [0.9486833, 0.3162278]])
    with pytest.raises(ConfigurationError):
        made(384)(["a"])
    assert embedding.best_device(["CPUExecutionProvider", "CUDAExecutionProvider"]) == "CUDAExecutionProvider" and embedding.best_device(["CPUExecutionProvider"]) == "CPUExecutionProvider"
    with pytest.raises(ConfigurationError):
        embedding.best_device(["CPUExecutionProvider"], "CUDAExecutionProvider")


def test_embeddings(spark):
    encode = embedding.hashing_provider(384)
    a = encode(["alpha beta", "alpha beta", ""])
    assert np.array_equal(a[0], a[1]) and abs(np.linalg.norm(a[0]) - 1) < 1e-6 and not a[2].any()
    got = values(spark, ["alpha beta", "", None], embedding.embed)
    assert np.allclose(got["alpha beta"], a[0]) and got[""] is None and got[None] is None
    with pytest.raises(ConfigurationError):
        embedding.model_info("none")
    assert embedding.embedding_filename(embedding.DEFAULT_MODEL) == "hash.json" and embedding.embedding_filename("ibm-granite/granite-embedding-30m-english") == "gran.json"
    f = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [4.0, -3.0])], "id int, embedding array<float>")
    assert [(r.id, round(r.similarity, 6)) for r in vx.top_k(f, [1.0, 0.0], 5).collect()] == [(3, 0.8), (1, 0.6)]
    assert f.select(vx.normalized("embedding")).first()[0] == pytest.approx([0.6, 0.8])


def test_stems(spark):
    pairs = "caresses caress flies fli dies die mules mule denied deni agreed agre owned own meeting meet stating state hopping hop hoping hope traditional tradit reference refer colonizer colon plotted plot relational relat conditional condit happy happi sky sky generous generous communism communism skis ski consign consign consistency consist knightly knight".split()
    assert {w: ts.stem(w) for w in pairs[::2]} == dict(zip(pairs[::2], pairs[1::2]))
    assert ts.lexemes_of("The cats, and the CAT sat") == {"cat": [2, 5], "sat": [6]}
    f = spark.createDataFrame([(1, "batteries were rejected"), (2, "a battery"), (3, None)], "id int, t string")
    assert [r.id for r in f.where(ts.matches(ts.search_vector("t"), "battery rejecting")).collect()] == [1]
    index = ts.inverted_index(f, key="id", text="t")
    assert [r.id for r in ts.bm25(index, ["battery"], key="id").collect()] == [2]


def test_bm25_by_index_and_scan_agree(spark):
    f = spark.createDataFrame([(1, "alpha beta the beta"), (2, "beta gamma"), (3, ""), (4, None), (5, "delta")], "id int, t string")
    by_index = {r.id: round(r.score, 9) for r in ts.bm25(ts.inverted_index(f, key="id", text="t"), ["beta", "delta"], key="id").collect()}
    by_scan = {r.id: round(r.score, 9) for r in ts.bm25_scan(f, ["beta", "delta"], key="id", text="t").collect()}
    assert by_index == by_scan and set(by_scan) == {1, 2, 5}
    assert ts.bm25_scan(f.limit(0), ["beta"], key="id", text="t").count() == 0


def test_upsert(spark):
    target = spark.createDataFrame([(5, "a", 1, "old"), (9, "b", 2, "old")], "id long, path string, size int, kind string")
    incoming = spark.createDataFrame([("b", 3, "new"), ("d", 4, "new"), ("c", 5, "new"), (None, 6, "new")], "path string, size int, kind string")
    rows = {r.path: (r.id, r.size, r.kind) for r in upsert(target, incoming, keys=["path"], updated=["size"]).collect()}
    assert rows["a"] == (5, 1, "old") and rows["b"] == (9, 3, "old") and {rows[k][0] for k in ("c", "d", None)} == {10, 11, 12} and rows["c"][2] == "new"
    assert upsert(target.limit(0), incoming.limit(0), keys=["path"], updated=["size"]).count() == 0


def test_previous_row(spark):
    from docmill.operators.ordered import previous_row

    rows = [("hot", n, n * 10) for n in range(300)] + [(k, n, n) for k in ("a", "z", None) for n in range(3)]
    f = spark.createDataFrame(rows, "k string, n int, v int").repartition(5)
    got = {(r.k, r.n): r.previous and (r.previous.n, r.previous.v) for r in previous_row(f, key="k", order="n", columns=["n", "v"]).collect()}
    assert got == {(k, n): None if n == 0 else (n - 1, (n - 1) * (10 if k == "hot" else 1)) for k, n, _ in rows}
    assert previous_row(f.limit(0), key="k", order="n", columns=["v"]).count() == 0


def test_config(tmp_path):
    assert config.resolve({}, None) == config.DEFAULTS
    compose = tmp_path / "c.yml"
    compose.write_text("services:\n  db:\n    environment:\n      POSTGRES_DB: x\n      - POSTGRES_USER=u\n    ports:\n      - \"5999:5432\"\n")
    assert config.resolve({}, str(compose)) | {"password": ""} == {"host": "localhost", "port": "5999", "database": "x", "user": "u", "password": ""}
    assert config.resolve({"POSTGRES_DB": "y"}, str(compose))["database"] == "y"
    assert config.resolve({"DATABASE_URL": "postgres://u:p%40@h:1/d"}, None) == {"host": "h", "port": "1", "database": "d", "user": "u", "password": "p@"}
    for env in ({"DATABASE_URL": "mysql://u@h/d"}, {"DATABASE_URL": "postgresql://h/d"}, {"DATABASE_URL": "postgresql://u@h/d", "POSTGRES_DB": "x"}, {"POSTGRES_PORT": "x"}, {"DATABASE_URL": "postgresql://u@h:x/d"}):
        with pytest.raises(ConfigurationError):
            config.resolve(env, None)
    assert config.resolve({"DATABASE_URL": "postgresql://u@h"}, None) == config.DEFAULTS | {"host": "h", "user": "u"}
    assert config.jdbc_options(config.DEFAULTS)["url"] == "jdbc:postgresql://localhost:5432/ragdb"
