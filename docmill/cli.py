"""Command line: python -m docmill.cli COMMAND ... ; expected errors exit with 1."""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import functions as F

from docmill import pipeline, status
from docmill.config import jdbc_options, resolve
from docmill.errors import DocmillError
from docmill.functions import text as tx
from docmill.operators.chunking import ChunkParameters
from docmill.operators.embedding import DEFAULT_MODEL
from docmill.operators.providers import provider_factory
from docmill.session import get_session
from docmill.sources.database import write_database
from docmill.store import Store

SETTINGS = ("refinement_prompt", "enable_refinement", "enable_reranking", "similarity_threshold", "max_chunks", "max_tokens_in_context", "refinement_questions_count")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docmill")
    p.add_argument("--content-dir", default="content")
    p.add_argument("--store", default="store")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str, **options) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for x in positional:
            c.add_argument(x)
        for k, v in options.items():
            c.add_argument(f"--{k.replace('_', '-')}", **({"action": "store_true"} if v is bool else {"default": v}))
        for name in ("content_dir", "store"):  # may also stand behind the command
            c.add_argument(f"--{name.replace('_', '-')}", default=argparse.SUPPRESS)
        return c

    command("ingest", "source", force=bool, dry_run=bool)
    context = {"context": bool, "skip_context": bool, "local_context": bool, "llm_provider": None, "openai_url": None, "watsonx_url": None, "context_model": None, "context_limit": None}
    facts = {"title": None, "description": None, "username": None, "note": None}
    connection = {"host": None, "port": None, "db": None, "user": None, "password": None}
    command("chunk", pattern=None, tokenizer_file=None, force=bool, dry_run=bool, **context)
    command("embed", pattern=None, model=DEFAULT_MODEL, force=bool, dry_run=bool)
    command("load", pattern=None, model=DEFAULT_MODEL, force=bool, prune=bool, **facts, **connection)
    command("db-status")
    command("db-dump", "target").add_argument("--database", action="store_true", help="also into the configured database")
    command("db-restore", "source")
    command("audit", pattern=None, model=DEFAULT_MODEL)
    command("config", **{s: None for s in SETTINGS})
    command("manifest", "target")
    command("cleanup-workers")
    command("db-start")
    command("db-stop")
    command("db-destroy", yes=bool)
    command("db-logs", follow=bool)
    command("pipeline", "source", model=DEFAULT_MODEL, output_file="docmill_dump", force=bool, **facts, **context)
    return p


def _audit(content: pipeline.Content, args) -> bool:
    sources = pipeline.matching(content.read("ingested", pipeline.INGESTED).where("error is null"), args.pattern)
    chunked = pipeline.matching(content.read("chunked", pipeline.CHUNKED).where("error is null"), args.pattern)
    embedded = pipeline.matching(pipeline.sets_of(content.read("embedded", pipeline.EMBEDDED)), args.pattern)
    meta = sources.selectExpr("doc_path", "get_json_object(meta, '$.metadata_version') AS metadata_version")
    messages = status.audit_messages(sources, chunked, embedded, meta, model=args.model)
    messages.orderBy("doc_path", "kind").show(1000, False)
    row = status.audit_summary(sources, chunked, embedded, meta, messages, model=args.model).first()
    print(row.asDict())
    return row.passed


def _provider(args):
    asked = args.context or args.local_context or args.llm_provider or args.openai_url or args.watsonx_url
    limit = int(args.context_limit) if args.context_limit else None
    return provider_factory(skip_context=args.skip_context or not asked, provider=args.llm_provider, url=args.openai_url, watsonx_url=args.watsonx_url, model=args.context_model, limit=limit, local=args.local_context)


def _facts(args) -> dict:
    return {"title": args.title, "description": args.description, "user": args.username, "note": args.note}


def _follow(store: Store, seconds: float = 2.0, rounds: int | None = None) -> None:
    """Shows changes as they are made, until interrupted."""
    last = 0
    while rounds is None or rounds > 0:
        fresh = store.table("schema_changes").where(F.col("id") > last).orderBy("id").select("id", status.change_text().alias("change")).collect()
        for row in fresh:
            print(row.change)
            last = row.id
        if rounds is not None:
            rounds -= 1
        if rounds != 0:
            time.sleep(seconds)


def execute(args: argparse.Namespace, spark=None) -> int:
    spark = spark or get_session(master=args.master)
    content, store = pipeline.Content(spark, args.content_dir), Store(spark, args.store)
    c = args.command
    if c == "ingest":
        out = pipeline.ingest(spark, args.source, content, force=args.force, dry_run=args.dry_run)
    elif c == "chunk":
        out = pipeline.generate_chunks(content, pattern=args.pattern, parameters=ChunkParameters(tokenizer_file=args.tokenizer_file), provider=_provider(args), force=args.force, dry_run=args.dry_run)
    elif c == "embed":
        out = pipeline.generate_embeddings(content, model=args.model, pattern=args.pattern, force=args.force, dry_run=args.dry_run)
    elif c == "load":
        out = pipeline.load_content(content, store, model=args.model, pattern=args.pattern, force=args.force, prune=args.prune, **_facts(args))
        given = {"host": args.host, "port": args.port, "database": args.db, "user": args.user, "password": args.password}
        if any(given.values()):
            write_database(store, jdbc_options(resolve() | {k: v for k, v in given.items() if v}))
    elif c == "pipeline":
        out = pipeline.run(spark, args.source, content, store, model=args.model, dump=args.output_file, provider=_provider(args), force=args.force, **_facts(args))
    elif c == "db-status":
        for name, value in status.status(store).items():
            print(f"{name}:")
            if name == "changes":
                for row in value.orderBy("id").select(status.change_text().alias("change")).collect():
                    print(row.change)
            elif name == "bytes":
                print(spark.range(1).select(tx.pretty_size(F.lit(value))).first()[0])
            else:
                value.show(20, False) if hasattr(value, "show") else print(value)
        return 0
    elif c == "audit":
        return 0 if _audit(content, args) else 1
    elif c == "config":
        out = status.configure(store, **{s: getattr(args, s) for s in SETTINGS}).first()
    elif c == "manifest":
        status.write_manifest(store, args.target)
        out = args.target
    elif c == "db-dump":
        out = store.dump(args.target)
        if args.database:
            write_database(store, jdbc_options(resolve()))
    elif c == "db-restore":
        out = store.restore(args.source)
    elif c == "db-start":
        out = "created" if store.initialize() else "exists"
    elif c == "db-destroy":
        store.drop(confirm=args.yes)
        out = "destroyed"
    elif c == "db-logs" and args.follow:
        _follow(store)
        return 0
    elif c == "db-logs":
        store.table("schema_changes").orderBy("id").select(status.change_text().alias("change")).show(1000, False)
        return 0
    else:  # db-stop, cleanup-workers: Spark owns its workers and a store has no server
        out = "nothing to do"
    if hasattr(out, "show"):
        out.show(1000, False)
    else:
        print(out)
    return 0


def main(argv: list[str] | None = None) -> int:
    try:
        return execute(parser().parse_args(argv))
    except DocmillError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    except KeyboardInterrupt:
        return 130


if __name__ == "__main__":
    sys.exit(main())
