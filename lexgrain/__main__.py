"""python -m lexgrain --tables DIR VERB ...: the pipeline's steps and queries from the command line."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from lexgrain import pipeline
from lexgrain.operators import lookups
from lexgrain.settings import Settings, logger


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="lexgrain")
    p.add_argument("--tables")
    sub = p.add_subparsers(dest="verb", required=True)
    sub.add_parser("ingest").add_argument("--input")
    sub.add_parser("parse").add_argument("--retry-errors", action="store_true")
    for verb in ("extract-references", "resolve-references", "detect-conflicts", "build-deltas", "backfill-hierarchy", "build-fts", "stats", "reset"):
        sub.add_parser(verb)
    sub.add_parser("export-rag").add_argument("--output", required=True)
    sub.add_parser("preview-rag").add_argument("--count", type=int, default=5)
    for verb in ("search", "search-like"):
        sub.add_parser(verb).add_argument("q")
    tree = sub.add_parser("tree")
    tree.add_argument("canonical_doc")
    tree.add_argument("--version-tag")
    o = p.parse_args(args)
    conf = Settings.from_env(o.tables, getattr(o, "input", None))
    log = logger(conf.log_level)
    spark = spark or SparkSession.builder.appName("lexgrain").getOrCreate()
    t = pipeline.Tables(spark, conf.tables)
    steps = {
        "ingest": lambda: pipeline.ingest(t, conf.input_dir).first().asDict(),
        "parse": lambda: pipeline.parse(t, o.retry_errors),
        "extract-references": lambda: {"created": pipeline.extract_references(t)},
        "resolve-references": lambda: {"edges": pipeline.resolve_references(t)},
        "detect-conflicts": lambda: {"events": pipeline.detect_conflicts(t)},
        "build-deltas": lambda: {"deltas": pipeline.build_deltas(t)},
        "backfill-hierarchy": lambda: {"nodes": pipeline.backfill_hierarchy(t)},
        "build-fts": lambda: {"entries": pipeline.build_fts(t)},
        "export-rag": lambda: {"records": pipeline.export(t, o.output)},
        "reset": lambda: t.reset() or {},
    }
    shown = {
        "stats": lambda: lookups.quality(t.read("nodes")),
        "preview-rag": lambda: lookups.preview(t.read("nodes"), t.read("documents"), o.count),
        "search": lambda: pipeline.search(t, o.q).select("node_id", "text_content").orderBy("node_id").limit(20),
        "search-like": lambda: lookups.search_like(t.read("nodes"), "text_content", o.q).select("node_id", "text_content").orderBy("node_id").limit(20),
        "tree": lambda: lookups.tree(t.read("documents"), t.read("document_versions"), t.read("nodes"), o.canonical_doc, o.version_tag).select("node_id", "canonical_path", "text_content"),
    }
    if o.verb in steps:
        log.info(o.verb, extra={"fields": steps[o.verb]()})
    else:
        shown[o.verb]().show(100, truncate=100)
    return 0


if __name__ == "__main__":
    sys.exit(main())
