"""docflow run | review | comment | validate | schema. Exit codes: 0 well, 1 something was wrong, 2 bad usage."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import frontmatter, schemas, udfs
from .config import default_config, load_config
from .operators import review, sinks
from .operators.validate import validate
from .plans import ingest
from .sources.corpus import read_corpus


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docflow", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run")
    run.add_argument("--config", type=Path)
    run.add_argument("--corpus", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--folder", help="answers of the service, as files")
    run.add_argument("--dry-run", action="store_true")
    decide = commands.add_parser("review")
    decide.add_argument("--corpus", required=True)
    decide.add_argument("--out", required=True)
    decide.add_argument("--decision", choices=["approve", "reject"], required=True)
    decide.add_argument("--ids", required=True)
    decide.add_argument("--notes")
    answer = commands.add_parser("comment")
    answer.add_argument("--corpus", required=True)
    answer.add_argument("--out", required=True)
    answer.add_argument("--event", required=True, help="the event as a JSON file; of a whole review, with its comments")
    answer.add_argument("--name", required=True, help="the event's name")
    answer.add_argument("--repo", required=True)
    check = commands.add_parser("validate")
    check.add_argument("--corpus", required=True)
    schema = commands.add_parser("schema")
    schema.add_argument("--output", type=Path, required=True)
    schema.add_argument("--check", action="store_true")
    return top


def _write_documents(documents: DataFrame, out: str) -> None:
    documents.select("folder", "name", udfs.write_document("front_matter", "body").alias("text")).write.partitionBy("folder").mode("overwrite").parquet(out)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "schema":
        text = json.dumps(frontmatter.json_schema(), indent=2) + "\n"
        if args.check:
            return int(not args.output.exists() or args.output.read_text(encoding="utf-8") != text)
        args.output.write_text(text, encoding="utf-8")
        return 0
    spark = SparkSession.builder.appName("docflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    documents = read_corpus(spark, args.corpus)
    if args.command == "validate":
        errors = validate(documents).orderBy("path", "message").toLocalIterator()
        failures = 0
        for row in errors:
            print(f"::error file={row['path']}::{row['message']}")
            failures += 1
        print(f"{documents.count()} files, {failures} errors")
        return int(failures > 0)
    if args.command == "review":
        try:
            decided = review.apply_decision(documents, args.decision, review.split_ids(args.ids), args.notes)
        except ValueError as problem:
            print(f"::error::{problem}")
            return 1
        _write_documents(decided, args.out)
        return 0
    if args.command == "comment":
        events = spark.createDataFrame([(args.name, Path(args.event).read_text(encoding="utf-8"))], "name string, json string")
        comments = review.event_comments(events.select("name", F.from_json("json", schemas.EVENT).alias("event")), args.repo, default_config().corpus.branch_prefix)
        results, decided = review.answer_comments(documents, comments)
        answers = [r.asDict() for r in results.orderBy("id").collect()]  # the comments of one review
        if any(r["changed"] for r in answers):
            _write_documents(decided, args.out)
        print(json.dumps(answers))
        return int(not all(r["ok"] for r in answers))
    config, now = load_config(args.config) if args.config else default_config(), datetime.now(UTC)
    waiting = sinks.open_batches(spark, f"{args.out}/batches", ingest.branch_stem(config, now))
    done = ingest.run(spark, config, documents, *waiting, now, **({"folder": args.folder} if args.folder else {}))
    if not args.dry_run:
        sinks.write_batches(done.batches, f"{args.out}/batches", done.branches)
        sinks.write_originals(done.batches, f"{args.out}/{config.originals.dir}", done.branches)
        sinks.write_change_sets(done.branches, done.descriptions, f"{args.out}/change_sets")
    print(done.statistics.toJSON().first())
    return 0


if __name__ == "__main__":
    sys.exit(main())
