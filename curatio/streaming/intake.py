"""Structured Streaming re-aims of the crawl merge.

T1: new page files -> QA rows, incrementally (file source, the same
``mapInPandas`` parse and JVM gates as the batch operator).
T2, keyed state (``stream_first_seen``): the state of a URL is the position of
its first row so far. A row with an earlier position is emitted, any other is
dropped; nothing that was written is read again. ``first_seen_so_far`` gives of
the emitted rows the earliest per URL: the batch result of A5 over all parts that
arrived, in whatever order they came.
T2, folders (``stream_dedup``): exact first-seen URL dedup across micro-batches: inside a batch the
first row per URL in (part, line) order wins; across batches a left anti
join against the rows already committed drops URLs seen before. Rows are
stored by hash bucket of the URL, so a batch reads the buckets of its own keys
only. Within a bucket each batch writes its own ``batch_id=N`` folder with
overwrite, so a replayed batch replaces its partial output instead of
duplicating it, and the "seen" read excludes the batch being written.
"""

from __future__ import annotations

import contextlib
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from curatio import defaults as D
from curatio.operators.curate import dedup_first_seen, drop_seen
from curatio.operators.pages import page_qa
from curatio.operators.util import ship_by_value

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

PAGES_DDL = "page_id BIGINT, url STRING, html STRING"


def stream_page_qa(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                   schema: str = PAGES_DDL, fmt: str = "parquet",
                   question_selector: str = D.QUESTION_SELECTOR,
                   answer_selector: str = D.ANSWER_SELECTOR,
                   available_now: bool = True) -> StreamingQuery:
    """Start a query that turns newly arriving page files into QA rows
    (Parquet under ``out_dir``; exactly-once via the file sink log)."""
    pages = spark.readStream.schema(schema).format(fmt).load(source_dir)
    qa = page_qa(pages, question_selector, answer_selector)
    w = (qa.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def dedup_batch(batch: DataFrame, batch_id: int, target: str, key: str = "url",
                order_cols: Sequence[str] = ("part", "line"), buckets: int = 64) -> None:
    """T2 body for ``foreachBatch``: first-seen rows of this batch whose key
    was not committed by an earlier batch. Only the hash buckets that the
    batch's keys fall into are read."""
    spark = batch.sparkSession
    first = dedup_first_seen(batch, [key], list(order_cols)).withColumn(
        "bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
    try:
        touched = [r.bucket for r in first.select("bucket").distinct().collect()]    # ``buckets`` at most
        kept = first
        paths = _existing(spark, [f"{target.rstrip('/')}/bucket={b}" for b in sorted(touched)])
        if paths:
            seen = (spark.read.option("basePath", target).parquet(*paths)
                    .filter(F.col("batch_id") != batch_id).select(key))
            kept = drop_seen(first, seen, [key])
        (kept.withColumn("batch_id", F.lit(batch_id).cast("long")).repartition("bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "batch_id").parquet(target))
    finally:
        first.unpersist()


def _existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the folders that exist (any Hadoop file system)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = [(p, jvm.org.apache.hadoop.fs.Path(p)) for p in paths]
    return [p for p, h in hadoop if h.getFileSystem(conf).exists(h)]


def stream_dedup(lines: DataFrame, target: str, checkpoint: str, key: str = "url",
                 order_cols: Sequence[str] = ("part", "line"),
                 available_now: bool = True) -> StreamingQuery:
    """Run :func:`dedup_batch` on every micro-batch of ``lines``."""
    w = (lines.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: dedup_batch(df, bid, target, key, order_cols)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


class FirstPosition(StatefulProcessor):
    """State per key: the position (part, line) of its first row so far. Emits
    the first row of the batch if it stands before that position."""

    def __init__(self, part: str, line: str):
        self.part, self.line = part, line

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "part string, line long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, at = None, self.first.get() if self.first.exists() else None
        at = None if at is None else (at[0], int(at[1]))
        for block in rows:
            head = block.sort_values([self.part, self.line], kind="stable").head(1)
            if len(head):
                here = (head[self.part].iloc[0], int(head[self.line].iloc[0]))
                if at is None or here < at:
                    best, at = head, here
        if best is not None:
            self.first.update(at)
            yield best

    def close(self) -> None:
        pass


def first_of_block(lines: DataFrame, key: str, part: str, line: str) -> DataFrame:
    """Of each Arrow block the first row per key: a key with a third of all
    rows is one row a block before the shuffle."""
    def cut(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks:
            pos = pd.DataFrame({"k": b.column(b.schema.get_field_index(key)).to_pandas(),
                                "p": b.column(b.schema.get_field_index(part)).to_pandas(),
                                "l": b.column(b.schema.get_field_index(line)).to_numpy(zero_copy_only=False)})
            keep = pos.sort_values(["p", "l"], kind="stable").drop_duplicates("k").index.sort_values()
            yield b.take(pa.array(keep.to_numpy(), pa.int64()))
    return lines.mapInArrow(cut, lines.schema)


@contextlib.contextmanager
def _keyed_state(spark: SparkSession):
    """Keyed state of any kind needs the RocksDB store; a query keeps the
    settings that it was started with."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def stream_first_seen(lines: DataFrame, target: str, checkpoint: str, key: str = "url",
                      part: str = "part", line: str = "line", available_now: bool = True) -> StreamingQuery:
    """T2 with keyed state: rows of ``lines`` that are the first of their key
    when they arrive, as Parquet under ``target`` (exactly once by the file
    sink's log and the state's versions, replays included). A part that arrives
    late but stands before the row kept emits its row as well;
    :func:`first_seen_so_far` settles it. Null keys are one key, as in A5.
    ``part`` is a string, ``line`` a long, neither null; equal positions keep
    the row that came first. The number of state partitions is
    ``spark.sql.shuffle.partitions`` of the first start."""
    spark = lines.sparkSession
    for name, kind in ((part, T.StringType), (line, (T.LongType, T.IntegerType))):
        if not isinstance(lines.schema[name].dataType, kind):
            raise ValueError(f"column {name} must be a {'string' if name == part else 'whole number'}")
    ship_by_value(__name__)
    out = (first_of_block(lines, key, part, line).groupBy(key)
           .transformWithStateInPandas(FirstPosition(part, line), lines.schema, "Append", "None"))
    w = out.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    with _keyed_state(spark):
        return w.start()


def first_seen_so_far(spark: SparkSession, target: str, key: str = "url", part: str = "part",
                      line: str = "line") -> DataFrame:
    """The first row per key of all that :func:`stream_first_seen` emitted."""
    return dedup_first_seen(spark.read.parquet(target), [key], [part, line])


def json_part_lines(spark: SparkSession, source_dir: str,
                    schema: str = "question STRING, answer STRING, url STRING") -> DataFrame:
    """Streaming JSON-lines parts, read in byte ranges: each good line with its
    ``part`` (the file's path, numbers padded, so part_2 comes before part_10)
    and ``line``, which rises with the line's place in the file, whatever the
    splits. Bad lines are those that do not parse, are not objects, or lack
    ``url``; blank lines are none."""
    from curatio.sources.readers import classify_json_lines, number_order
    raw = spark.readStream.format("text").option("lineSep", "\n").load(source_dir)
    raw = raw.select(number_order(F.col("_metadata.file_path")).alias("part"),
                     F.col("_metadata.file_block_start").alias("line"), "value")
    raw = numbered_in_splits(raw).filter(F.length(F.trim("value")) > 0)
    out = classify_json_lines(raw, "value", schema, ["url"])
    return out.filter(~F.col("is_bad")).drop("value", "is_bad")


def numbered_in_splits(lines: DataFrame, part: str = "part", line: str = "line") -> DataFrame:
    """``line``, a split's first byte, plus the row's number in its split. A
    split has no more lines than bytes, so numbers rise over a file's splits and
    none occurs twice. No rows move: a split's rows follow each other in one task."""
    def number(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0                                        # the split under way, its rows so far
        for b in blocks:
            if not b.num_rows:
                continue
            names = b.column(b.schema.get_field_index(part)).to_pylist()
            start = b.column(b.schema.get_field_index(line)).to_numpy(zero_copy_only=False)
            place = np.empty(b.num_rows, np.int64)
            for i, at in enumerate(zip(names, start.tolist())):
                last, n = (last, n + 1) if at == last else (at, 0)
                place[i] = at[1] + n
            yield b.set_column(b.schema.get_field_index(line), line, pa.array(place))
    ship_by_value(__name__)
    return lines.mapInArrow(number, lines.schema)
