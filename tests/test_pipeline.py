import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from docmill import cli, pipeline, status
from docmill.errors import ConfigurationError, ContentError, StoreError
from docmill.operators.embedding import DEFAULT_MODEL
from docmill.operators.providers import LocalContext
from docmill.store import Store
from docmill.streaming.ingest import stream_ingest


@pytest.fixture
def folder(tmp_path):
    src = tmp_path / "in"
    (src / "web" / "pages").mkdir(parents=True)
    (src / "web" / "pages" / "one page.v1.htm").write_bytes("<html><head><meta charset='iso-8859-1'><title>Über</title><script>x='</p>'</script></head><body><h1>Head</h1><p>First para.</p><ul><li>a<li>b</ul><table><tr><td>1</td><td>2</td></tr></table>".encode("latin-1"))
    (src / "data.csv").write_text("﻿a,b\n1,2\n,\n3,4\n", encoding="utf-8")
    (src / "NOTES.MD").write_text("# Title\n\ntext one\nmore\n\n## Sub\n- x\n- y\n\n```\ncode\n```\n" + "word " * 900)
    (src / "bad.docx").write_bytes(b"not a zip")
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("word/document.xml", '<w:document xmlns:w="u"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Doc</w:t></w:r></w:p><w:p><w:r><w:t>Body text</w:t></w:r></w:p></w:body></w:document>')
    (src / "ok.docx").write_bytes(z.getvalue())
    (src / "skip.bin").write_bytes(b"x")
    return src


def test_stages_are_incremental(spark, folder, tmp_path):
    content, store = pipeline.Content(spark, str(tmp_path / "content")), Store(spark, str(tmp_path / "store"))
    assert pipeline.ingest(spark, str(folder), content, dry_run=True).count() == 5
    first = pipeline.run(spark, str(folder), content, store)
    assert (first["ingest"].made, first["ingest"].errors) == (4, 1)
    rows = {r.doc_path: r for r in content.read("ingested", pipeline.INGESTED).collect()}
    assert rows["bad"].error and rows["web/pages/one page.v1"].title == "Über" and rows["data"].blocks[0].text == "a | b"
    assert json.loads(rows["ok"].meta)["content"] == {"title": "Doc"} and "content" not in json.loads(rows["data"].meta)
    chunks = {r.doc_path: r.chunks for r in content.read("chunked", pipeline.CHUNKED).collect()}
    assert len(chunks["NOTES"]) >= 3 and all(len(c.text) <= 1352 for c in chunks["NOTES"])
    assert chunks["NOTES"][1].contextual_text.startswith("Title\nSub\n")
    assert first["load"].loaded == 4 and first["load"].deltas["documents_added"] == 4
    counts = status.totals(*(store.table(t) for t in ("documents", "chunks", "embeddings", "models"))).first().asDict()
    assert counts["chunks"] == counts["embeddings"] == sum(map(len, chunks.values()))
    # nothing changed: nothing is made again
    again = pipeline.run(spark, str(folder), content, store)
    assert (again["ingest"].made, again["chunk"].made, again["embed"].made) == (0, 0, 0) and again["load"].loaded == 0 and again["load"].skipped == 4
    # force keeps the counts consistent
    forced = pipeline.load_content(content, store, force=True)
    assert forced.loaded == 4 and status.totals(*(store.table(t) for t in ("documents", "chunks", "embeddings", "models"))).first().asDict() == counts
    ids = {r.path: r.id for r in store.table("documents").collect()}
    assert sorted(ids.values()) == [1, 2, 3, 4]
    # a shrunken document keeps its tail unless pruned
    (folder / "NOTES.MD").write_text("# Title\n\nshort\n")
    assert pipeline.ingest(spark, str(folder), content).made == 1
    pipeline.generate_chunks(content)
    pipeline.generate_embeddings(content)
    pipeline.load_content(content, store)
    of_notes = lambda: store.table("chunks").where(F.col("document_id") == ids["NOTES"]).count()
    assert of_notes() == len(chunks["NOTES"])
    pipeline.load_content(content, store, prune=True, model=DEFAULT_MODEL)
    pipeline.generate_embeddings(content, force=True)
    pipeline.load_content(content, store, prune=True)
    assert of_notes() == 1
    log = store.table("schema_changes").orderBy("id").collect()
    assert log[0].notes == "Database initialized" and log[1].embedding_models_added == [DEFAULT_MODEL] and len(log) >= 4
    assert "Documents added: 4" in store.table("schema_changes").where("id = 2").select(status.change_text()).first()[0]
    # dump, restore, manifest, tree
    assert store.dump(str(tmp_path / "bundle"))["documents"] == 4
    other = Store(spark, str(tmp_path / "other"))
    other.restore(str(tmp_path / "bundle"))
    assert sorted(other.table("documents").collect()) == sorted(store.table("documents").collect())
    assert [r.path for r in status.manifest(store.table("documents")).collect()] == sorted(ids)
    assert pipeline.export_tree(content, str(tmp_path / "tree")) == 4
    tree = pipeline.read_tree(spark, str(tmp_path / "tree"))
    assert {r.doc_path for r in tree.collect()} == set(ids)
    third = Store(spark, str(tmp_path / "third"))
    result = pipeline.load(third, tree.withColumn("vectors", F.when(F.col("doc_path") == "ok", F.array()).otherwise(F.col("vectors"))), DEFAULT_MODEL)
    assert result.loaded == 3 and [r.doc_path for r in result.errors.collect()] == ["ok"]


def test_contexts(spark, folder, tmp_path):
    content = pipeline.Content(spark, str(tmp_path / "content"))
    pipeline.ingest(spark, str(folder), content)
    pipeline.generate_chunks(content, provider=LocalContext)
    chunks = {r.doc_path: r.chunks for r in content.read("chunked", pipeline.CHUNKED).collect()}
    assert any(c.contextual_text.startswith("From a document") for c in chunks["NOTES"])
    with pytest.raises(ContentError):
        pipeline.generate_chunks(content, pattern="none/*")
    with pytest.raises(ContentError):
        pipeline.ingest(spark, str(tmp_path / "absent"), content)


def test_failures_are_tried_again_and_replace_nothing(spark, tmp_path, monkeypatch):
    from docmill.sources import extract

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.md").write_text("# A\n\ntext")
    (src / "b.pdf").write_bytes(b"%PDF")
    content = pipeline.Content(spark, str(tmp_path / "c"))
    ingest = lambda: (lambda r: (r.made, r.errors))(pipeline.ingest(spark, str(src), content))
    version = lambda: content._pointer("ingested").read()
    state = lambda: sorted((r.doc_path, r.error is None, r.title) for r in content.read("ingested", pipeline.INGESTED).collect())
    assert ingest() == (1, 1) and state() == [("a", True, "A"), ("b", False, None)]
    at = version()
    assert ingest() == (0, 1) and version() == at  # tried again, nothing new to say
    monkeypatch.setitem(extract.PARSERS, ".pdf", lambda data: ("late", [("text", None, "found", 1)]))
    assert ingest() == (1, 0) and state() == [("a", True, "A"), ("b", True, "late")] and ingest() == (0, 0)
    # a version that cannot be read stays beside the last good one
    (src / "b.pdf").write_bytes(b"%PDF other")

    def broken(data):
        raise ValueError("broken")

    monkeypatch.setitem(extract.PARSERS, ".pdf", broken)
    assert ingest() == (0, 1) and state() == [("a", True, "A"), ("b", False, None), ("b", True, "late")]
    assert ingest() == (0, 1)
    assert pipeline.generate_chunks(content).made == 2 and pipeline.generate_chunks(content).made == 0
    monkeypatch.setitem(extract.PARSERS, ".pdf", lambda data: ("mended", [("text", None, "found", 1)]))
    assert ingest() == (1, 0) and state() == [("a", True, "A"), ("b", True, "mended")]
    assert pipeline.generate_chunks(content).made == 1


def test_failed_contexts_are_tried_again(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.md").write_text("# One\n\nfirst\n\n# Two\n\nsecond")
    content = pipeline.Content(spark, str(tmp_path / "c"))
    pipeline.ingest(spark, str(src), content)
    flag = tmp_path / "down"
    flag.write_text("")

    path = str(flag)

    def provider():
        import os

        class Flaky(LocalContext):  # fails for one passage while a file says so
            def context_for(self, chunk):
                if "second" in chunk and os.path.exists(path):
                    raise TimeoutError("no answer")
                return "CONTEXT"

        return Flaky()

    rows = lambda: content.read("chunked", pipeline.CHUNKED).collect()
    assert pipeline.generate_chunks(content, provider=provider).made == 1
    assert [c.contextual_text for c in rows()[0].chunks] == ["CONTEXT\n\nOne\nfirst", "Two\nsecond"] and rows()[0].failed_contexts == 1
    assert rows()[0].chunks[1].text == "Two\nsecond" and json.loads(rows()[0].enrichment)["provider"] == "provider"
    flag.unlink()
    assert pipeline.generate_chunks(content, provider=provider).made == 1 and rows()[0].failed_contexts == 0
    assert pipeline.generate_chunks(content, provider=provider).made == 0
    assert pipeline.generate_chunks(content).made == 1  # without contexts the parameters differ
    assert rows()[0].enrichment is None


def test_content_from_memory(spark, tmp_path):
    content = pipeline.Content(spark, str(tmp_path / "c"))
    assert pipeline.ingest_from_content(content, "<h1>H</h1><p>é</p>", "site/page", "page.html", metadata={"url": "http://u", "etag": "1"}).made == 1
    row = content.read("ingested", pipeline.INGESTED).first()
    meta = json.loads(row.meta)
    assert row.doc_path == "site/page" and row.title == "H" and meta["source"] == {"url": "http://u", "etag": "1"} and meta["processing"]["parser_version"].startswith("docmill")
    assert pipeline.ingest_from_content(content, "<h1>H</h1><p>é</p>", "site/page", "page.html").made == 0
    assert pipeline.ingest_from_content(content, "caf\u00e9".encode("utf-8"), "site/other", "x.txt").made == 1
    with pytest.raises(ContentError):
        pipeline.ingest_from_content(content, "x", "p", "nosuffix")


def test_database(spark, folder, tmp_path):
    from docmill.sources.database import read_database, write_database

    content, store = pipeline.Content(spark, str(tmp_path / "content")), Store(spark, str(tmp_path / "store"))
    pipeline.run(spark, str(folder), content, store)
    options = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    write_database(store, options)
    tables = read_database(spark, options)
    for name in ("documents", "chunks", "embeddings", "models", "schema_changes"):
        assert sorted(map(repr, tables[name].collect())) == sorted(map(repr, store.table(name).collect()))


def test_single_file_and_stream(spark, folder, tmp_path):
    content = pipeline.Content(spark, str(tmp_path / "a"))
    assert pipeline.ingest(spark, str(folder / "data.csv"), content).made == 1
    streamed = pipeline.Content(spark, str(tmp_path / "b"))
    query = stream_ingest(spark, str(folder), streamed, checkpoint=str(tmp_path / "check"))
    query.awaitTermination(120)
    pipeline.ingest(spark, str(folder), content)
    pick = lambda c: sorted((r.doc_path, r.source_hash) for r in c.read("ingested", pipeline.INGESTED).collect())
    assert pick(streamed) == pick(content)


def test_late_and_repeated_deliveries(spark, tmp_path):
    from docmill.streaming.ingest import delivered, stream_documents

    schema = "doc_id long, updated_at timestamp, body string"
    put = lambda n, rows: spark.createDataFrame(rows, "doc_id long, updated_at string, body string").withColumn("updated_at", F.col("updated_at").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    run = lambda: stream_documents(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), str(tmp_path / "out"), checkpoint=str(tmp_path / "log")).awaitTermination()
    rows = lambda: sorted((r.doc_id or -1, r.body) for r in delivered(spark, str(tmp_path / "out"), schema).collect())
    put(1, [(1, "2031-05-01", "a"), (1, "2031-05-01", "a"), (2, None, "b"), (None, None, "n")])
    run()
    assert rows() == [(-1, "n"), (1, "a"), (2, "b")]
    put(2, [(1, "2031-05-01", "a"), (2, None, "b"), (3, "2020-01-01", "late"), (1, "2031-06-01", "a2")])  # years late, and not dropped
    run()
    assert rows() == [(-1, "n"), (1, "a"), (1, "a2"), (2, "b"), (3, "late")]
    run()
    assert len(rows()) == 5


def test_sources_of_one_stem(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    text = {"a.md": "# From md\n\ntext", "a.html": "<h1>From html</h1><p>text</p>", "a.csv": "From,csv\n1,2", "b.md": "# Other"}
    for name, body in text.items():
        (src / name).write_text(body)
    content = pipeline.Content(spark, str(tmp_path / "c"))
    state = lambda c: sorted((r.doc_path, r.filename, r.error is None) for r in c.read("ingested", pipeline.INGESTED).collect())
    ingest = lambda: (lambda r: (r.made, r.errors))(pipeline.ingest(spark, str(src), content))
    assert pipeline.ingest(spark, str(src), content, dry_run=True).count() == 2
    assert ingest() == (2, 2)
    first = [("a", "a.csv", True), ("a", "a.html", False), ("a", "a.md", False), ("b", "b.md", True)]
    assert state(content) == first
    for _ in range(2):  # nothing changed, so nothing takes turns
        assert ingest() == (0, 0) and state(content) == first
    assert pipeline.generate_chunks(content).made == 2
    # one by one, in whatever order, the end is the same
    singly = pipeline.Content(spark, str(tmp_path / "d"))
    found = [(r.made, r.errors) for r in (pipeline.ingest(spark, str(src / n), singly) for n in ("a.html", "b.md", "a.csv", "a.md"))]
    assert found == [(1, 0), (1, 0), (1, 1), (0, 1)] and state(singly) == first
    # the holder goes: the next name has the path
    (src / "a.csv").unlink()
    assert ingest() == (1, 1) and state(content) == [("a", "a.html", True), ("a", "a.md", False), ("b", "b.md", True)]
    (src / "a.md").unlink()
    assert ingest() == (0, 0) and state(content) == [("a", "a.html", True), ("b", "b.md", True)]


def test_settings(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(StoreError):
        status.status(store)
    store.initialize()
    row = status.configure(store, refinement_prompt="Ask", enable_refinement="Yes", max_chunks=" 1_0 ", similarity_threshold="0.7").first()
    assert (row.refinement_prompt, row.enable_refinement, row.max_chunks, row.similarity_threshold, row.enable_reranking) == ("Ask", True, 10, 0.7, None)
    row = status.configure(store, refinement_prompt="None", enable_refinement="none", enable_reranking="f").first()
    assert (row.refinement_prompt, row.enable_refinement, row.enable_reranking, row.max_chunks) == (None, None, False, 10)
    for bad in ({"max_chunks": "x"}, {"enable_refinement": "maybe"}, {}, {"other": "1"}):
        with pytest.raises(ConfigurationError):
            status.configure(store, **bad)
    assert status.status(store)["totals"].first().documents == 0
    with pytest.raises(StoreError):
        store.drop()


def test_audit(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    sources = frame([("a", "1"), ("b", "2"), ("c", "3"), ("d", None)], "doc_path string, source_hash string")
    chunks = frame([("a", "1", "h", 2), ("b", "x", "h", 1), ("d", None, "h", 0)], "doc_path string, source_hash string, chunks_hash string, chunk_count int")
    vectors = frame([("a", "m", "other"), ("b", "n", "h")], "doc_path string, model string, chunks_hash string")
    meta = frame([("a", "1.0"), ("b", "0.9"), ("c", None)], "doc_path string, metadata_version string")
    folders = frame([("a",), ("z",)], "folder string")
    others = frame([("a", "x.txt")], "doc_path string, file string")
    messages = status.audit_messages(sources, chunks, vectors, meta, model="m", others=others, folders=folders)
    assert {(r.doc_path, r.kind) for r in messages.collect()} == {("a", "stale embeddings"), ("b", "stale chunks"), ("b", "missing embeddings"), ("b", "metadata version"), ("c", "missing chunks"), ("c", "invalid metadata"), ("d", "missing metadata"), ("a", "unknown file"), ("z", "orphan folder")}
    row = status.audit_summary(sources, chunks, vectors, meta, messages, model="m").first()
    assert (row.sources, row.chunks, row.zero_chunks, row.embeddings, row.passed) == (4, 2, 1, 1, False)


def test_command_line(spark, folder, tmp_path, capsys):
    base = ["--content-dir", str(tmp_path / "c"), "--store", str(tmp_path / "s")]
    run = lambda *a: cli.execute(cli.parser().parse_args([*base, *a]), spark)
    assert run("pipeline", str(folder), "--output-file", str(tmp_path / "d"), "--title", "T", "--username", "u") == 0
    assert run("db-status") == run("config", "--max-chunks", "5") == run("manifest", str(tmp_path / "m")) == run("db-logs") == run("db-stop") == 0
    assert run("audit") == 0
    assert run("db-destroy", "--yes") == 0
    with pytest.raises(StoreError):
        run("db-status")


def test_search(spark, folder, tmp_path):
    from docmill.operators.retrieval import overlap_reranker, refined, search

    content, store = pipeline.Content(spark, str(tmp_path / "content")), Store(spark, str(tmp_path / "store"))
    pipeline.run(spark, str(folder), content, store)
    rows = search(store, "first para", rerank=overlap_reranker("first para")).collect()
    assert rows[0].document_path == "web/pages/one page.v1" and rows[0].bm25 > 0 and rows[0].similarity > 0
    status.configure(store, max_chunks="2", max_tokens_in_context="400", similarity_threshold="0.99")
    few = search(store, "first para").collect()
    assert len(few) <= 2 and all(r.similarity is None for r in few)
    # an index of this snapshot gives the same passages; one of an older snapshot does not count
    from docmill.operators.index import SearchIndex

    status.configure(store, max_chunks="none", max_tokens_in_context="none", similarity_threshold="none", enable_refinement="yes", refinement_questions_count="2")
    ask = lambda: [(r.document_path, r.chunk_index, round(r.rrf_score, 9)) for r in search(store, "first para", refine=lambda q, n: ["code text", "other"]).collect()]
    scanned = ask()
    index = SearchIndex(store)
    assert index.current() is None
    index.build()
    assert index.current()["documents"] == store.table("chunks").count() and ask() == scanned
    status.configure(store, max_chunks="1")
    assert index.current() is not None and len(ask()) == 1
    pipeline.load_content(content, store, force=True)
    assert index.current() is None
    assert refined("q", 2, lambda q, n: [q + "?"] * 5) == ["q", "q?", "q?"] and refined("q", 3) == ["q"]
