"""File sources.

All readers return DataFrames; nothing is loaded on the driver. The original's
JSON arrays and maps of arrays are read in byte ranges
(:mod:`curatio.sources.json_arrays`); the canonical storage of this library is
JSON lines / Parquet.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio import defaults as D
from curatio.operators.util import checked_broadcast
from curatio.sources import json_arrays

QA_DDL = "question STRING, answer STRING, url STRING"


def list_page_urls(spark: SparkSession, start_page: int, end_page: int,
                   template: str) -> DataFrame:
    """List-page URLs for the inclusive page range; ``template`` is a
    ``format_string`` pattern with one ``%d`` (e.g. ``.../list_%d.htm``)."""
    r = spark.range(start_page, end_page + 1)
    return r.select(F.col("id").cast("int").alias("page"),
                    F.format_string(template, F.col("id")).alias("url"))


def read_link_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of strings -> ``pos, url`` (order kept), read in byte
    ranges."""
    return json_arrays.read_strings(spark, path).select("pos", F.col("value").alias("url"))


def classify_json_lines(df: DataFrame, line_col: str, schema: str | T.StructType,
                        required: Sequence[str] = ("url",)) -> DataFrame:
    """S3 core: parse JSON lines; a line is bad when it does not parse as a
    whole (text after the object, or single quotes, make it bad), is not an
    object, or lacks a required key (a key present with a null value is
    fine). Adds the parsed fields and ``is_bad``."""
    keys = F.json_object_keys(F.col(line_col))
    # the line as the first of two elements of an array: the parser must get past
    # its end, to a mark that no line holds of itself
    mark = F.xxhash64(line_col).cast("string")
    whole = F.from_json(F.concat(F.lit("["), F.col(line_col), F.lit(',"'), mark, F.lit('"]')), "array<string>",
                        {"allowSingleQuotes": "false"})
    bad = keys.isNull() | F.coalesce((F.size(whole) != 2) | (F.get(whole, F.lit(1)) != mark), F.lit(True))
    for k in required:
        bad = bad | ~F.array_contains(keys, k)
    parsed = F.from_json(F.col(line_col), schema)
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not isinstance(st, T.StructType):
        raise ValueError("schema must be a struct")
    out = df.withColumn("is_bad", F.coalesce(bad, F.lit(True))).withColumn("_p", parsed)
    for f in st.fields:
        out = out.withColumn(f.name, F.when(~F.col("is_bad"), F.col("_p")[f.name]))
    return out.drop("_p")


def read_json_parts(spark: SparkSession, paths: Sequence[str] | str,
                    schema: str = QA_DDL, required: Sequence[str] = ("url",)) -> DataFrame:
    """S3 + U1: union JSONL part files; every line carries ``part`` (file
    path), ``part_no`` (position in the given list of paths), ``part_key``
    (the path with its numbers padded, so part_2 comes before part_10),
    ``block`` (split start) and ``line_id`` (increasing within a split),
    which together give (part, line) order. Returns good and bad lines with
    ``is_bad``; bad lines keep ``value`` for the log."""
    given = [] if isinstance(paths, str) else list(paths)
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths))
    raw = raw.select("value", F.col("_metadata.file_path").alias("part"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line_id"))
    place: dict = {}
    for k, p in enumerate(given):               # file names only: the scan lists them anyway
        for file in spark.read.text(p).inputFiles():
            place.setdefault(_one_slash(file), k)
    no = F.lit(0)
    if given:
        names = spark.createDataFrame(list(place.items()) or [("", 0)], "__file string, part_no int")
        names = checked_broadcast(names, known_rows=len(place), required=False)
        raw = raw.join(names, F.regexp_replace("part", "^file:/+", "file:/") == F.col("__file"), "left").drop("__file")
        no = F.coalesce("part_no", F.lit(len(given)))
    raw = raw.withColumn("part_no", no).withColumn("part_key", number_order("part"))
    return classify_json_lines(raw, "value", schema, required)


def _one_slash(uri: str) -> str:
    return re.sub("^file:/+", "file:/", uri)


def number_order(path):
    """A path with its numbers padded, so that part_2 comes before part_10."""
    return F.regexp_replace(F.regexp_replace(path, r"(\d+)", "0" * 19 + "$1"), r"\d*(\d{19})", "$1")


def input_position() -> list:
    """Columns that give the (part, line) order of a file scan, whatever the
    splits: select them right from the read."""
    return [number_order(F.col("_metadata.file_path")).alias("part"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_id")]


def merge_parts(parts: DataFrame, key: str = "url") -> DataFrame:
    """S3 + A5: good lines only, first seen per key in (part, line) order."""
    from curatio.operators.curate import dedup_first_seen
    good = parts.filter(~F.col("is_bad"))
    return dedup_first_seen(good, [key], ["part_no", "part_key", "block", "line_id"])


def read_json_array(spark: SparkSession, path: str, schema: str = QA_DDL, position: str | None = None) -> DataFrame:
    """A JSON array of objects, pretty-printed or not, read in byte ranges;
    with ``position`` also a column of that name which gives their (file,
    element) order."""
    rows = json_arrays.read_objects(spark, path, schema)
    at = [F.struct(number_order(F.col("file")).alias("part"), "no").alias(position)] if position else []
    return rows.select("r.*", *at)


def schema_gate(df: DataFrame, required: Sequence[str] = ("question", "answer"),
                mode: str = "raise"):
    """Every row needs the required fields. ``raise``: one aggregate
    count, error when any row fails. ``quarantine``: return (good, bad)."""
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    if mode == "quarantine":
        return df.filter(~bad), df.filter(bad)
    n_bad = df.agg(F.count_if(bad).alias("n")).first()["n"]
    if n_bad:
        raise ValueError(f"Invalid data format: {n_bad} rows lack one of {list(required)}")
    return df


def newest_file(spark: SparkSession, folder: str, prefix: str = D.RAW_PREFIX,
                suffix: str = D.RAW_SUFFIX, by: str = "mtime") -> str:
    """The newest matching file under ``folder`` - by modification
    time (``mtime``; Spark exposes no ctime) or by file name (``name``,
    descending). Raises FileNotFoundError when none matches. Only file
    metadata is read (one row per file, via the file index)."""
    order = F.col("modificationTime") if by == "mtime" else F.col("path")
    try:       # the folder's own files, not those of folders in it
        row = (spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{prefix}*{suffix}")
               .agg(F.max_by("path", order).alias("p")).first())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is None or row["p"] is None:
        raise FileNotFoundError(f"no {prefix}*{suffix} file in {folder}")
    return row["p"]


def read_classified(spark: SparkSession, path: str, schema: str = QA_DDL) -> DataFrame:
    """S7 + G2: a JSON object ``{category: [row, ...]}`` -> flat rows
    ``dept, dept_pos, pos, question, answer, url`` (category order and row
    order kept; an empty category gives no rows), read in byte ranges. A missing
    file raises FileNotFoundError, a malformed one ValueError."""
    return json_arrays.read_map(spark, path, schema)


def category_sizes(spark: SparkSession, path: str) -> DataFrame:
    """G1: sizes of the categories of a classified file, without parsing rows."""
    cats, _ = json_arrays.map_rows(spark, path)
    return cats.select("dept", F.col("dept_pos").cast("int").alias("dept_pos"),
                       (F.col("next") - F.col("first")).cast("long").alias("count"))
