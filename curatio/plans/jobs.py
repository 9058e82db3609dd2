"""File-to-file entry points mirroring the original scripts (links, crawl
merge, classify, convert, report), each a short chain of the operators.

    links     pages table            -> link rows (JSON lines)         S1/X1/W1
    extract   pages table            -> raw QA rows (JSON lines)       X5-X8/A5/W3
    merge     JSON-lines part files  -> raw QA rows                    S3/A5/W3
    classify  raw QA rows + lexicon  -> classified corpus + stats      S5/S8/V8/W4/W5
    convert   classified corpus      -> conversation records + stats   P3/P4/N1/N2/G4/A7/W6
    report    classified corpus      -> category distribution          A4/N3-N5

Every step reads and writes splittable formats (JSON lines / Parquet); the
classified corpus is partitioned by category.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio import defaults as D
from curatio.operators import curate as K
from curatio.operators.classify import ClassifyParams, classify
from curatio.operators.lexicon import Lexicon
from curatio.operators.pages import page_links, page_qa
from curatio.operators.report import distribution
from curatio.sources import readers as RD
from curatio.sources import sinks as SK


def links(pages: DataFrame, out_dir: str, selector: str = D.LINK_SELECTOR,
          substring: str = D.LINK_SUBSTRING) -> bool:
    """Link extraction over stored list pages; no output when none match."""
    return SK.write_links(page_links(pages, selector, substring), out_dir)


def extract(pages: DataFrame, out_dir: str, question_selector: str = D.QUESTION_SELECTOR,
            answer_selector: str = D.ANSWER_SELECTOR) -> bool:
    """Detail pages -> raw QA rows, first row per URL in page order."""
    qa = page_qa(pages, question_selector, answer_selector)
    qa = K.dedup_first_seen(qa, ["url"], ["page_id"])
    return SK.write_parts(qa, os.path.join(out_dir, f"run_ts={SK.run_stamp()}"))


def merge(spark: SparkSession, parts, out_dir: str, previous: str | None = None) -> bool:
    """Union JSON-lines part files, skip bad lines, first row per URL; with
    ``previous`` (raw rows of earlier runs) URLs already seen are skipped
    (J6, a null-safe left anti join)."""
    merged = RD.merge_parts(RD.read_json_parts(spark, parts))
    if previous:
        merged = K.drop_seen(merged, spark.read.schema(RD.QA_DDL).json(previous), ["url"])
    return SK.write_parts(merged, os.path.join(out_dir, f"run_ts={SK.run_stamp()}"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw QA rows from JSON lines (a folder) or the original JSON array
    file (a path ending in ``.json``; any file system); the schema gate
    raises when a row lacks question or answer."""
    if path.endswith(".json"):
        df = RD.read_json_array(spark, path, position="pos")
    else:
        df = spark.read.schema(RD.QA_DDL).json(path)
        df = df.select("*", F.struct(*RD.input_position()).alias("pos"))
    return RD.schema_gate(df)


def newest_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The newest raw array file of a folder, as the original takes when no
    path is given."""
    return read_raw(spark, RD.newest_file(spark, folder))


def with_vectors(raw: DataFrame, vectors: DataFrame, key: str = "url", vec_col: str = "embedding") -> DataFrame:
    """Rows with the embedding of their ``key`` (one row a key; null where
    there is none)."""
    one = vectors.groupBy(key).agg(F.min_by(vec_col, F.xxhash64(vec_col)).alias(vec_col))
    return raw.join(one, key, "left")


def classify_corpus(spark: SparkSession, raw: DataFrame, lex: Lexicon, out_dir: str,
                    params: ClassifyParams | None = None, vec_col: str | None = None,
                    prototypes: DataFrame | None = None) -> DataFrame:
    """Label every raw row; write the corpus partitioned by category and the
    ``category: N条`` stats. Rows keep their input position (``pos``: part and
    line, if read by :func:`read_raw`) for the first-appearance order of
    categories and the running ids. An empty corpus is an error."""
    rows = raw if "pos" in raw.columns else raw.withColumn("pos", F.monotonically_increasing_id())
    if not rows.take(1):
        raise ValueError("the corpus is empty")
    labelled = classify(rows, ["pos"], lex, vec_col, prototypes, params)
    labelled = labelled.select("pos", "question", "answer", "url", "label")
    SK.write_classified(labelled, os.path.join(out_dir, "classified"))
    written = spark.read.parquet(os.path.join(out_dir, "classified"))
    SK.write_stats(written, os.path.join(out_dir, "classification_stats"), order_col="pos")
    return written


def convert_corpus(spark: SparkSession, classified: DataFrame, out_dir: str,
                   cap: int | None = D.CAP_PER_CATEGORY, seed: int = D.CAP_SEED,
                   reject_terms=D.REJECT_TERMS) -> DataFrame:
    """Quality filter, per-category cap, running ids, conversation records;
    writes the records and the per-category original/filtered/final stats."""
    v = classified.withColumn("valid", K.quality_mask("question", "answer",
                                                      reject_terms=reject_terms))
    stats = K.conversion_stats(v, "label", "valid", cap)
    stats.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "conversion_stats"))
    # drawn by content, not by position, which depends on the file layout
    kept = v.filter("valid").withColumn("qa_key", F.md5(F.to_json(F.struct("url", "question", "answer"))))
    capped = K.cap_per_group(kept, "label", "qa_key", cap, seed)
    ids = K.running_ids(capped, "label", ["pos"], "id")
    records = K.conversation_records(ids, "id", "question", "answer")
    SK.write_conversations(records, os.path.join(out_dir, "conversations"))
    return spark.read.json(os.path.join(out_dir, "conversations"))


def report(classified: DataFrame, top_n: int = D.TOP_SLICES) -> DataFrame:
    """Category distribution: count, percentage, rank, top-N flag."""
    return distribution(classified, "label", top_n=top_n)
