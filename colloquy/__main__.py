"""python -m colloquy: merge, score and report from tables that Spark reads; every path may be any that Spark knows."""

from __future__ import annotations

import argparse

from colloquy.config import Config
from colloquy.functions import fixed

VERSION = "0.2"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="colloquy", description="Collate several texts of one speech.")
    p.add_argument("--version", action="version", version=f"colloquy {VERSION}")
    sub = p.add_subparsers(dest="command", required=True)
    m = sub.add_parser("merge", help="merge sources (key, source_ord, source, text) to one text a key")
    m.add_argument("sources")
    m.add_argument("out")
    m.add_argument("--key", default="key")
    m.add_argument("--chunk-words", type=int, default=fixed.CHUNK_WORDS)
    m.add_argument("--skeleton", help="the source whose segments and speakers the merged text keeps")
    e = sub.add_parser("ensemble", help="resolve models' texts (key, model, text)")
    e.add_argument("texts")
    e.add_argument("out")
    e.add_argument("--key", default="key")
    e.add_argument("--no-adjudicator", action="store_true", help="keep the best model's text")
    s = sub.add_parser("score", help="score outputs (file_id, name, text) against references")
    for name in ("entries", "outputs", "references", "turns", "out"):
        s.add_argument(name)
    s.add_argument("--metrics", default="wer,cpwer,der")
    s.add_argument("--subset")
    s.add_argument("--file-ids")
    s.add_argument("--max-files", type=int)
    r = sub.add_parser("report", help="one page of scored rows")
    r.add_argument("scored")
    r.add_argument("out")
    q = sub.add_parser("query", help="one of the registered queries")
    q.add_argument("name")
    q.add_argument("tables")
    q.add_argument("out")
    return p


def main(args: list[str] | None = None, spark=None) -> None:
    a = parser().parse_args(args)
    if a.command == "merge":
        Config(chunk_words=a.chunk_words)  # refuses what makes no sense
    from colloquy.operators import ensemble, scoring, structure
    from colloquy.session import get_spark
    from colloquy.sources import files, sinks

    spark = spark or get_spark()
    read = spark.read.parquet
    if a.command == "merge":
        sources = read(a.sources)
        if a.skeleton:
            own, rest = ensemble.separated(sources, a.key, a.skeleton)
            merged = ensemble.structured_merge(structure.segments(own, a.key, "text"), rest, a.key, a.chunk_words)
            ensemble.rendering(merged, a.key).write.parquet(a.out)
        else:
            ensemble.flat_merge(sources, a.key, a.chunk_words).write.parquet(a.out)
    elif a.command == "ensemble":
        ensemble.driven(read(a.texts), a.key, not a.no_adjudicator).write.parquet(a.out)
    elif a.command == "score":
        entries = read(a.entries)
        if a.subset or a.file_ids or a.max_files:
            entries = files.filtered(entries, a.subset, a.file_ids.split(",") if a.file_ids else None, limit=a.max_files)
        metrics = tuple(x.strip() for x in a.metrics.split(","))
        scoring.scored(entries, read(a.outputs), read(a.references), read(a.turns), metrics).write.parquet(a.out)
    elif a.command == "report":
        sinks.write_text(scoring.report(read(a.scored)), "page", a.out)
    else:
        from colloquy.plans import catalog

        catalog.QUERIES[a.name](spark, a.tables).write.parquet(a.out)


if __name__ == "__main__":
    main()
