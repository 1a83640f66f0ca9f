"""The jobs from a shell: spark-submit glossmill/jobs.py JOB [options] SOURCE TARGET.

Reads a folder of text files, writes one `key<TAB>count` text folder.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import glossmill as g  # noqa: E402


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="jobs.py", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, *flags, min_freq=10):
        sub = jobs.add_parser(name)
        sub.add_argument("source")
        sub.add_argument("target")
        sub.add_argument("--parts", type=int, default=40, help="output files")
        if name != "rolling-term-sum":
            sub.add_argument(
                "--malformed", choices=["fail", "drop"], help="faulty records (default: the scan's own)"
            )
        if min_freq is not None:
            sub.add_argument("--min-freq", type=int, default=min_freq)
            sub.add_argument("--ignore-case", action="store_true")
        if "text" in flags:
            sub.add_argument("--skip", action="append", default=[], metavar="FILE")
        if "count" in flags:
            sub.add_argument("--by-heading", action="store_true")
            sub.add_argument("--per-document", action="store_true")
            sub.add_argument("--stem", action="store_true")
        if "stop" in flags:
            sub.add_argument("--stop-words", metavar="FILE")
        return sub

    for name in ("ngrams", "tagged-ngrams"):
        flags = ("text", "count") if name == "ngrams" else ()
        job(name, *flags).add_argument("-n", type=int, default=2)
    job("word-counts", "text", "count", "stop")
    pairs = job("cooccurrence", "text", "stop")
    pairs.add_argument("--per-document", action="store_true")
    chunks = job("chunk-counts", "text", "stop", min_freq=5)
    chunks.add_argument("--by-document", action="store_true")
    job("rolling-term-sum", min_freq=None)
    sweep = job("ngram-sweep", "text")
    sweep.add_argument("--lowest", type=int, default=2)
    sweep.add_argument("--highest", type=int, default=10)
    return top


def result(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, object]:
    """Result of a job and the key its lines start with."""
    options = {}
    if "min_freq" in args:
        options = dict(min_freq=args.min_freq, case_sensitive=not args.ignore_case)
    if "skip" in args:
        options["skip_patterns"] = g.read_skip_patterns(spark, *args.skip)
    if getattr(args, "stop_words", None):
        options["stop_words"] = g.read_word_table(spark, args.stop_words)
    scan = {"observation": getattr(args, "seen", None)}
    if getattr(args, "malformed", None):
        scan["malformed"] = args.malformed
    keys = []
    if "by_heading" in args:
        options.update(by_heading=args.by_heading, stem=args.stem)
        options["unit"] = "document" if args.per_document else "occurrence"
        keys = ["heading"] if args.by_heading else []
    if args.job == "ngrams":
        df = g.ngrams(g.read_marked(spark, args.source, **scan), args.n, **options)
        return df, [*keys, "gram"]
    if args.job == "ngram-sweep":
        records = g.read_marked(spark, args.source, **scan)
        return g.ngram_sweep(records, args.lowest, args.highest, **options), ["gram"]
    if args.job == "word-counts":
        df = g.word_counts(g.read_marked(spark, args.source, **scan), **options)
        return df, [*keys, "word"]
    if args.job == "cooccurrence":
        unit = "document" if args.per_document else "sentence"
        df = g.cooccurrence(g.read_marked(spark, args.source, **scan), unit, **options)
        return df, ["hi", "lo"]
    if args.job == "tagged-ngrams":
        df = g.tagged_ngrams(g.read_tagged(spark, args.source, **scan), args.n, **options)
        return df, df.columns[:-1]
    if args.job == "chunk-counts":
        by = "doc_id" if args.by_document else "year"
        df = g.chunk_counts(g.read_chunked(spark, args.source, **scan), by, **options)
        return df, g.yearly_key(by)
    return g.rolling_term_sum(g.read_yearly(spark, args.source)), g.trend_key()


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"glossmill {args.job}").getOrCreate()
    args.seen = Observation("records")
    df, key = result(spark, args)
    g.write_tsv(df, args.target, key, parts=args.parts)
    if args.job != "rolling-term-sum":
        counts = args.seen.get
        print("records: " + ", ".join(f"{k} {v}" for k, v in counts.items()), file=sys.stderr)


if __name__ == "__main__":
    main()
