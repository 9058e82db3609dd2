"""Sinks (W1-W7). Spark's commit protocol replaces write-then-rename and
part-file cleanup; every writer is distributed (one file per task), so the
array-shaped files of the original become folders of JSON lines.

Gates (S8, the no-output rule of W1 and W2) are judged in the writing pass:
rows are counted by the tasks that write them, into a folder beside the target,
which takes the target's place only if the counts pass."""

from __future__ import annotations

import time
import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from curatio import defaults as D
from curatio.operators.report import stats_text


def run_stamp(fmt: str = "%Y%m%d_%H%M%S") -> str:
    """Timestamp used in output names (``run_ts=...``)."""
    return time.strftime(fmt)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_gated(df: DataFrame, path: str, save: Callable[[DataFrameWriter, str], None],
                gate: Callable[[dict], bool | None], required: Sequence[str] = ()) -> bool:
    """Write ``df`` beside ``path`` by ``save(writer, folder)`` and count on the way:
    ``rows``, and ``lacking`` (rows with a null in a ``required`` column). If
    ``gate`` refuses the counts (False, or an error, which is raised), the new folder
    goes and what stood at ``path`` stays readable; else it takes that place.

    The input is computed once. Counts are of the tasks that committed their files,
    so retried and speculative tasks count once. Between the two renames of an
    overwrite ``path`` is absent for a moment; if the second one fails, the earlier
    output is put back. Returns whether ``path`` was written."""
    spark = df.sparkSession
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | F.col(c).isNull()
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("lacking"))
    target = path.rstrip("/")
    tag = uuid.uuid4().hex
    staged, aside = f"{target}.staged-{tag}", f"{target}.old-{tag}"
    fs, new = _fs(spark, staged)
    try:
        save(watched.write, staged)
        if gate(seen.get) is False:
            return False
        (_, at), (_, old) = _fs(spark, target), _fs(spark, aside)
        there = fs.exists(at)
        if there and not fs.rename(at, old):
            raise OSError(f"{path} can't be replaced")
        if not fs.rename(new, at):
            if there:
                fs.rename(old, at)
            raise OSError(f"{staged} can't be moved to {path}")
        if there:
            fs.delete(old, True)
        return True
    finally:
        if fs.exists(new):
            fs.delete(new, True)


def _any_rows(counts: dict) -> bool:
    return counts["rows"] > 0


def complete_rows(counts: dict) -> None:
    """S8 as a gate: an error when any row lacks a required field."""
    if counts["lacking"]:
        raise ValueError(f"Invalid data format: {counts['lacking']} rows lack a required field")


def write_links(links: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Link rows as JSON lines; no output at all when there are none (an
    earlier one stays). Modes other than overwrite are Spark's own."""
    rows = links.select("pos", F.col("link").alias("url"))
    if mode == "overwrite":
        return write_gated(rows, path, lambda w, p: w.json(p), _any_rows)
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).json(path)
    return seen.get["rows"] > 0


def write_parts(rows: DataFrame, path: str) -> bool:
    """QA rows as JSON lines, only when there are results (an earlier
    output stays if not)."""
    return write_gated(rows.select("question", "answer", "url"), path, lambda w, p: w.json(p), _any_rows)


def write_classified(df: DataFrame, path: str, group_col: str = "label",
                     fmt: str = "parquet", required: Sequence[str] = ()) -> None:
    """The classified corpus, partitioned by category (flat rows; the
    nested one-object form would put a whole category in one record). S8: a row
    with a null in a ``required`` column is an error, and the earlier corpus stays."""
    write_gated(df, path, lambda w, p: w.partitionBy(group_col).format(fmt).save(p), complete_rows, required)


def write_stats(df: DataFrame, path: str, group_col: str = "label",
                fmt: str = D.STATS_LINE_FORMAT, order_col=None) -> None:
    """The header, then one ``category: N条`` line per category, in one file:
    by first appearance in ``order_col``, by name without it."""
    order = group_col if order_col is None else order_col
    stats_text(df, group_col, order, fmt).write.mode("overwrite").text(path)


def write_conversations(records: DataFrame, path: str) -> None:
    """``{id, conversations:[{from, value}, ...]}`` as JSON lines."""
    write_gated(records.select("id", "conversations"), path, lambda w, p: w.json(p), lambda counts: None)


def output_name(input_name, prefix: str = D.CLASSIFIED_PREFIX,
                suffix: str = D.CLASSIFIED_SUFFIX):
    """Derive an output stem from an input file name by stripping the
    prefix and the suffix (works on a str or a Column)."""
    if isinstance(input_name, str):
        stem = input_name[len(prefix):] if input_name.startswith(prefix) else input_name
        return stem[: -len(suffix)] if suffix and stem.endswith(suffix) else stem
    c = F.regexp_replace(input_name, "^" + _re_escape(prefix), "")
    return F.regexp_replace(c, _re_escape(suffix) + "$", "")


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
