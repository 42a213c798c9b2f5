"""Command line: ingest, ask, stats, evaluate, review, clear."""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from quillmill.operators import retrieval
from quillmill.operators.embedding import EmbeddingCache
from quillmill.pipeline import Pipeline
from quillmill.settings import Settings
from quillmill.sources import files
from quillmill.sources.state import Folder, State, export_review, save_report


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="quillmill")
    out.add_argument("--store", required=True, help="folder of the cache, the state and the vectors")
    out.add_argument("--settings", help="file of NAME=value lines; by default the environment")
    commands = out.add_subparsers(dest="command", required=True)
    ingest = commands.add_parser("ingest", help="Markdown files into the table of vectors")
    ingest.add_argument("folder")
    ingest.add_argument("--reset", action="store_true", help="touched namespaces lose their old vectors")
    ask = commands.add_parser("ask")
    ask.add_argument("question")
    evaluate = commands.add_parser("evaluate", help="a set of questions with what is expected of them")
    evaluate.add_argument("questions")
    evaluate.add_argument("--weak", type=float, default=0.25)
    review = commands.add_parser("review", help="a sample of chunks")
    review.add_argument("--size", type=int, default=20)
    clear = commands.add_parser("clear")
    clear.add_argument("what", choices=("all", "chunks", "embeddings", "cache", "vectors"))
    commands.add_parser("stats")
    for sub in (ask, evaluate, clear):
        sub.add_argument("--namespace")
    for sub in (ask, evaluate):
        sub.add_argument("-k", type=int)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("quillmill").getOrCreate()
    settings = Settings.from_file(args.settings) if args.settings else Settings.of(dict(os.environ))
    state, cache = State(spark, f"{args.store}/state"), EmbeddingCache(spark, f"{args.store}/cache")
    table = retrieval.VectorTable(spark, f"{args.store}/vectors", settings.embedding_dimension, settings.metric)
    pipeline = Pipeline(spark, settings, state)
    if args.command == "ingest":
        return "\n".join(f"{r.namespace or '(default)'}: {r.accepted} stored, {r.rejected} rejected" for r in pipeline.run(files.read_markdown(spark, args.folder), cache, table, args.reset).collect())
    if args.command == "ask":
        return retrieval.show_matches(pipeline.ask(args.question, table, args.namespace, k=args.k).selectExpr("0 as qid", "*"))
    if args.command == "evaluate":
        asked = files.numbered_questions(files.read_questions(spark, args.questions))
        per = retrieval.evaluate(asked, pipeline.ask_all(asked, table, args.namespace, k=args.k), args.weak)
        return "\n".join([json.dumps(retrieval.summary(per).first().asDict()), *save_report(asked, per, Folder(spark, f"{args.store}/reports"))])
    if args.command == "review":
        chunks = state.load_chunks()
        if chunks is None:
            raise SystemExit("no chunks: ingest first")
        return "\n".join(export_review(chunks, Folder(spark, f"{args.store}/reviews"), args.size, ("doc_id", "seq")))
    if args.command == "clear":
        {"all": state.clear_all, "chunks": state.clear_chunks, "embeddings": lambda: state.clear_embeddings(args.namespace or ""), "cache": cache.clear, "vectors": lambda: table.delete(args.namespace)}[args.what]()
        return f"cleared {args.what}"
    facts = [state.status(), *(f"cache: {r.n_entries} entries, {r.megabytes} MB" for r in cache.stats().collect())]
    return "\n".join(facts + ([f"{r.namespace or '(default)'}: {r.n} vectors, {r.percent} %" for r in table.stats().orderBy("namespace").collect()] if table.exists() else ["no vectors"]))


if __name__ == "__main__":
    print(main())
