"""JSON arrays and maps of arrays that split.

A file that is one JSON value has no record separator. Here it is read by the
text source with a structural character as its line separator (``}`` for arrays of objects,
``,`` for arrays of strings), so byte ranges of one file go to many tasks and no
row is larger than an element.

* Shape. Each split computes, for both states that it may start in (inside or
  outside of a string), its change of state and of depth, and how many
  separators it has at each depth. An escape can't cross a split, as
  neither separator may follow a backslash in a string. One row a split goes to
  the driver, which composes them in order: the state, the depth and the
  number of elements before each split.
* Elements. With its start known each split cuts its text where an element
  ends. What belongs to an element that began in an earlier split, or ends in
  a later one, is a fragment; only fragments are shuffled, two a split.

In a map of arrays the text before an element's own brace holds the keys opened
since the element before, so keys may be cut by splits like anything else."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatio.operators.util import checked_broadcast, ship_by_value
from curatio.session import cut_lineage

_ESCAPE = re.compile(r"\\.", re.S)
_OPEN, _CLOSE = "{[", "}]"


def _change(text: str) -> int:
    return sum(map(text.count, _OPEN)) - sum(map(text.count, _CLOSE))


def _sides(piece: str) -> tuple[int, int, int]:
    """(quotes, change of depth in the even and in the odd spans between them)."""
    spans = _ESCAPE.sub("", piece).split('"')
    return len(spans) - 1, sum(map(_change, spans[::2])), sum(map(_change, spans[1::2]))


@dataclass(frozen=True)
class Layout:
    separator: str           # ends an element, and lines of the text source
    depth: int               # depth after it where it ends an element

    @property
    def closes(self) -> int:
        return 1 if self.separator in _CLOSE else 0


OBJECTS, STRINGS, MAP = Layout("}", 1), Layout(",", 1), Layout("}", 2)


class _Scan:
    """State and depth along the pieces of a file, from a given start."""

    def __init__(self, layout: Layout, inside: bool, depth: int):
        self.layout, self.inside, self.depth = layout, inside, depth

    def piece(self, text: str) -> bool:
        """Reads a piece; does the separator after it stand outside of strings?"""
        quotes, even, odd = _sides(text)
        self.depth += odd if self.inside else even
        self.inside ^= quotes % 2 == 1
        if not self.inside:
            self.depth -= self.layout.closes
        return not self.inside


def _pieces(spark: SparkSession, path, layout: Layout) -> DataFrame:
    return (spark.read.option("lineSep", layout.separator).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_size").alias("bytes")))


def _by_split(batches):
    """((file, block, bytes of the file), pieces) of each batch's runs of one split."""
    for batch in batches:
        value, *key = (batch.column(c).to_pylist() for c in ("value", "file", "block", "bytes"))
        key, at = list(zip(*key)), 0
        for k in range(1, len(value) + 1):
            if k == len(value) or key[k] != key[at]:
                yield key[at], value[at:k]
                at = k


def _starts(pieces: DataFrame, layout: Layout) -> tuple[dict, list]:
    """(file, block) -> (inside, depth, elements before) of each split, and the
    files that aren't one complete value."""
    def shape(batches):
        key, scans, ends, size, lead = None, None, None, 0, ""

        def row():
            return pa.RecordBatch.from_pylist([{
                "file": key[0], "block": key[1], "bytes": key[2], "size": size, "lead": lead,
                **{f"inside{s}": scans[s].inside for s in (0, 1)}, **{f"depth{s}": scans[s].depth for s in (0, 1)},
                **{f"ends{s}": json.dumps(ends[s]) for s in (0, 1)}}], schema)

        for split, texts in _by_split(batches):
            if split != key:
                if key:
                    yield row()
                key, scans, ends = split, [_Scan(layout, bool(s), 0) for s in (0, 1)], [{}, {}]
                size, lead = 0, texts[0].lstrip("\ufeff \t\r\n")[:1]
            for text in texts:
                size += len(text.encode()) + 1
                for scan, at in zip(scans, ends):
                    if scan.piece(text):
                        at[scan.depth] = at.get(scan.depth, 0) + 1
        if key:
            yield row()

    kinds = {"file": "string", "block": "long", "bytes": "long", "size": "long", "lead": "string", "inside0": "boolean",
             "inside1": "boolean", "depth0": "long", "depth1": "long", "ends0": "string", "ends1": "string"}
    arrow = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(k, arrow[t]) for k, t in kinds.items()])
    rows = pieces.mapInArrow(shape, ", ".join(f"{k} {t}" for k, t in kinds.items())).collect()       # a row a split
    files: dict = {}
    for r in rows:
        files.setdefault(r["file"], []).append(r)
    out, broken = {}, []
    for file, splits in files.items():
        inside, depth, n, size = False, 0, 0, 0
        splits.sort(key=lambda r: r["block"])
        for r in splits:
            out[file, r["block"]] = inside, depth, n
            s = int(inside)
            n += json.loads(r[f"ends{s}"]).get(str(layout.depth - depth), 0)
            inside, depth, size = r[f"inside{s}"], depth + r[f"depth{s}"], size + r["size"]
        # what follows the last separator has been read as if one stood after it
        depth += layout.closes * (size > splits[0]["bytes"] and not inside)
        if inside or depth or splits[0]["lead"] != ("{" if layout is MAP else "["):
            broken.append(file)
    return out, sorted(broken)


def elements(spark: SparkSession, path, layout: Layout) -> DataFrame:
    """(file, no, text): every element with the text before it, numbered in
    file order; the last row of a file is what follows its last separator."""
    ship_by_value(__name__)
    pieces = _pieces(spark, path, layout)
    found, broken = _starts(pieces, layout)
    if broken and layout is MAP:
        raise ValueError(f"malformed file: {broken[0]}")
    starts = spark.sparkContext.broadcast(found)

    def cut(batches):
        key = scan = None
        held: list[str] = []
        whole = False                       # does the text held begin with the element?

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(
                (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))], ["file", "no", "block", "text", "whole"])

        for (file, block, _), texts in _by_split(batches):
            out = []
            if (file, block) != key:
                if held:
                    out.append((key[0], no, key[1], "".join(held), False))
                key, held = (file, block), []
                inside, depth, no = starts.value[key]
                scan = _Scan(layout, inside, depth)
                whole = block == 0
            for text in texts:
                outside = scan.piece(text)
                held += [text, layout.separator]
                if outside and scan.depth == layout.depth:
                    out.append((file, no, block, "".join(held), whole))
                    held, whole, no = [], True, no + 1
            yield rows(out)
        if held:
            yield rows([(key[0], no, key[1], "".join(held), False)])

    found = pieces.mapInArrow(cut, "file string, no long, block long, text string, whole boolean")
    pairs = F.array_sort(F.collect_list(F.struct("block", "text")))
    joined = (found.filter("NOT whole").groupBy("file", "no").agg(pairs.alias("p"))
              .select("file", "no", F.array_join(F.col("p.text"), "").alias("text")))
    return found.filter("whole").select("file", "no", "text").unionByName(joined)


def _own(text: str) -> tuple[str, str]:
    """(before, element): cut at the first brace outside of strings."""
    spans, at = re.split(r'("(?:[^"\\]|\\.)*")', text, flags=re.S), 0
    for k, s in enumerate(spans):
        if k % 2 == 0 and "{" in s:
            at += s.index("{")
            return text[:at], text[at:]
        at += len(s)
    return text, ""


def split_objects(df: DataFrame, layout: Layout) -> DataFrame:
    """(file, no, keys, element) of element texts: the keys opened before the
    element (of a map), in order, and its JSON; null for the rest of a file."""
    def run(batches):
        for batch in batches:
            keys, own = [], []
            for no, text in zip(batch.column("no").to_pylist(), batch.column("text").to_pylist()):
                if layout is MAP and no == 0:
                    text = text.lstrip("\ufeff \t\r\n")[1:]              # the map's own brace
                before, element = _own(text)
                names = re.findall(r'("(?:[^"\\]|\\.)*")\s*:', before, flags=re.S)
                keys.append([json.loads(n, strict=False) for n in names])
                own.append(element or None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("no"), pa.array(keys, pa.list_(pa.string())), pa.array(own, pa.string())],
                ["file", "no", "keys", "element"])

    return df.mapInArrow(run, "file string, no long, keys array<string>, element string")


def read_objects(spark: SparkSession, path, schema: str) -> DataFrame:
    """(file, no, r) of JSON arrays of objects, each in ``schema``."""
    rows = split_objects(elements(spark, path, OBJECTS), OBJECTS).filter("element IS NOT NULL")
    return rows.select("file", "no", F.from_json("element", schema).alias("r"))


def read_strings(spark: SparkSession, path) -> DataFrame:
    """(pos, value) of a JSON array of strings, in order."""
    rows = elements(spark, path, STRINGS)
    # the file's last element has its bracket with it, the first one, too
    text = F.regexp_replace(F.regexp_replace("text", r"^[\ufeff\s]*\[", ""), r",$", "")
    first = F.when(F.col("no") == 0, text).otherwise(F.regexp_replace("text", r",$", ""))
    ends = rows.groupBy("file").agg(F.max("no").alias("final"))
    rows = rows.withColumn("text", first).join(ends, "file")
    rows = rows.withColumn("text", F.when(F.col("no") == F.col("final"), F.regexp_replace("text", r"\]\s*,?\s*$", "")).otherwise(F.col("text")))
    rows = rows.filter(F.col("text").rlike(r"\S"))
    value = F.get(F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>"), F.lit(0))
    return rows.select(F.col("no").cast("int").alias("pos"), value.alias("value"))


def map_rows(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Of a map of arrays: categories (file, dept, dept_pos, first, next), which
    hold the elements from ``first`` up to ``next``, and elements (file, no, element)."""
    rows = cut_lineage(split_objects(elements(spark, path, MAP), MAP))
    opened = rows.select("file", "no", F.posexplode("keys").alias("k", "dept"))
    order = Window.partitionBy("file").orderBy("no", "k")                    # a row a category
    end = rows.groupBy("file").agg(F.count_if(F.col("element").isNotNull()).alias("end"))
    cats = opened.withColumn("dept_pos", F.row_number().over(order) - 1).withColumn("after", F.lead("no").over(order))
    cats = cats.join(end, "file").select("file", "dept", "dept_pos", F.col("no").alias("first"),
                                         F.coalesce("after", "end").alias("next"))
    return cats, rows.filter("element IS NOT NULL").select("file", "no", "element")


def read_map(spark: SparkSession, path, schema: str) -> DataFrame:
    """(dept, dept_pos, pos, fields of ``schema``) of a map of arrays."""
    cats, rows = map_rows(spark, path)
    c = checked_broadcast(cats.withColumnRenamed("file", "cat_file"), what="categories")
    j = rows.join(c, (F.col("file") == F.col("cat_file")) & (F.col("no") >= F.col("first")) & (F.col("no") < F.col("next")))
    return j.select("dept", "dept_pos", (F.col("no") - F.col("first")).cast("int").alias("pos"),
                    F.from_json("element", schema).alias("r")).select("dept", "dept_pos", "pos", "r.*")
