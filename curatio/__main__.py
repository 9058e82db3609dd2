"""Command line over :mod:`curatio.plans.jobs`, one subcommand per script of
the original (links, crawl merge, classify, convert, report)::

    python -m curatio extract  --pages pages/ --out raw/
    python -m curatio merge    --parts 'parts/*.jsonl' --out raw/
    python -m curatio classify --raw raw/ --lexicon lexicon.json --out processed/
    python -m curatio convert  --classified processed/classified --out processed/ --max-samples 5000 --seed 42
    python -m curatio report   --classified processed/classified

``--master`` defaults to the cluster's (spark-submit) or ``local[*]``.
"""

from __future__ import annotations

import argparse
import sys

from curatio import defaults as D


def _session(master: str | None):
    from pyspark.sql import SparkSession

    from curatio.session import checkpoint_dir
    b = SparkSession.builder.appName("curatio")
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    checkpoint_dir(spark)
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="curatio")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("links")
    s.add_argument("--pages", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--selector", default=D.LINK_SELECTOR)
    s.add_argument("--substring", default=D.LINK_SUBSTRING)
    s = sub.add_parser("extract")
    s.add_argument("--pages", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--question-selector", default=D.QUESTION_SELECTOR)
    s.add_argument("--answer-selector", default=D.ANSWER_SELECTOR)
    s = sub.add_parser("merge")
    s.add_argument("--parts", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--previous", default=None, help="raw rows of earlier runs (URLs to skip)")
    s = sub.add_parser("classify")
    s.add_argument("--raw", default=None, help="raw rows; else the newest raw file of --raw-dir")
    s.add_argument("--raw-dir", default=".")
    s.add_argument("--vectors", default=None, help="parquet: url, embedding")
    s.add_argument("--prototypes", default=None, help="parquet: dept, proto")
    s.add_argument("--lexicon", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("convert")
    s.add_argument("--classified", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--max-samples", type=int, default=D.CAP_PER_CATEGORY)
    s.add_argument("--seed", type=int, default=D.CAP_SEED)
    s = sub.add_parser("report")
    s.add_argument("--classified", required=True)
    a = ap.parse_args(argv)

    from curatio.operators.lexicon import read_lexicon
    from curatio.plans import jobs
    spark = _session(a.master)
    if a.cmd == "links":
        jobs.links(spark.read.parquet(a.pages), a.out, a.selector, a.substring)
    elif a.cmd == "extract":
        jobs.extract(spark.read.parquet(a.pages), a.out, a.question_selector, a.answer_selector)
    elif a.cmd == "merge":
        jobs.merge(spark, a.parts, a.out, a.previous)
    elif a.cmd == "classify":
        raw = jobs.read_raw(spark, a.raw) if a.raw else jobs.newest_raw(spark, a.raw_dir)
        raw = jobs.with_vectors(raw, spark.read.parquet(a.vectors)) if a.vectors else raw
        jobs.classify_corpus(spark, raw, read_lexicon(spark, a.lexicon), a.out,
                             vec_col="embedding" if a.vectors else None,
                             prototypes=spark.read.parquet(a.prototypes) if a.prototypes else None)
    elif a.cmd == "convert":
        jobs.convert_corpus(spark, spark.read.parquet(a.classified), a.out, a.max_samples or None, a.seed)
    elif a.cmd == "report":
        jobs.report(spark.read.parquet(a.classified)).orderBy("rank").show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
