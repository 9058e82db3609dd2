"""Keyword hits of large lexicons (J1, J2, K2, K4) in one pass over each text.

An Aho-Corasick automaton of the lexicon's keywords reads a text once, whatever
the number of keywords. Its occurrences give each keyword's first position and
count without overlap; sorted by start, the occurrences in a keyword's context
window are a slice, so its related keywords are counted without testing every
keyword of the category against the window.

Whole categories are packed into blocks of about ``block_keywords`` keywords; each
block is one pass. A category's keywords are met together by J2, so a category
larger than a block is a block of its own, and sets the memory of a worker
(about 150 bytes a letter of its keywords). The texts stay where they are: a pass
sends one text column to the workers and gets ids and numbers back.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from functools import reduce
from typing import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.operators.util import ship_by_value

FOUND = "array<struct<pair int, cnt long, pos int, n_related long>>"
_FOUND_PA = pa.struct([("pair", pa.int32()), ("cnt", pa.int64()), ("pos", pa.int32()), ("n_related", pa.int64())])


class KeywordAutomaton:
    """Over (category, keyword) rows; a keyword listed twice in a category counts
    twice as a related one."""

    def __init__(self, rows: Sequence[tuple[str, str]]):
        import ahocorasick
        self.times = Counter(rows)
        self.pairs = sorted(self.times)                        # what ``pair`` numbers
        self.of_word: dict[str, list[tuple[int, str]]] = {}
        for n, (dept, word) in enumerate(self.pairs):
            self.of_word.setdefault(word, []).append((n, dept))
        self.machine = ahocorasick.Automaton()
        for word in self.of_word:
            self.machine.add_word(word, word)
        self.machine.make_automaton()

    def find(self, text: str, radius: int) -> list[tuple[int, int, int, int]]:
        """(pair, count, first position, related keywords) of each pair in the text."""
        first: dict[str, int] = {}
        count: dict[str, int] = {}
        free: dict[str, int] = {}                              # where the next one may start without overlap
        seen: list[tuple[int, int, str]] = []
        for last, word in self.machine.iter(text):
            start = last + 1 - len(word)
            seen.append((start, last + 1, word))
            if word not in first:
                first[word], count[word], free[word] = start, 1, last + 1
            elif start >= free[word]:
                count[word] += 1
                free[word] = last + 1
        seen.sort()
        starts = [s for s, _, _ in seen]
        out = []
        for word, pos in first.items():
            low, high = max(pos - radius, 0), min(pos + len(word) + radius, len(text))
            near = {w for _, end, w in seen[bisect_left(starts, low):bisect_left(starts, high)] if end <= high and w != word}
            for pair, dept in self.of_word[word]:
                out.append((pair, count[word], pos, sum(self.times.get((dept, w), 0) for w in near)))
        return out


def blocks_of(keywords: DataFrame, block_keywords: int) -> list[list[str]]:
    """Categories packed into blocks, the large ones first."""
    sizes = sorted(((r["n"], r["dept"]) for r in keywords.groupBy("dept").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    blocks: list[list[str]] = []
    room = 0
    for n, dept in sizes:
        if not blocks or n > room:
            blocks.append([])
            room = block_keywords
        blocks[-1].append(dept)
        room -= n
    return blocks


def found_in(text: Column, rows, radius: int) -> Column:
    """The block's hits of a text. ``rows``: a Spark broadcast of the block's
    (category, keyword) rows; each task builds the automaton once."""
    @F.arrow_udf(FOUND)
    def find(blocks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = KeywordAutomaton(rows.value)
        for block in blocks:
            ends, hits = [0], []
            for value in block:
                hits += machine.find(value.as_py(), radius) if value.is_valid else []
                ends.append(len(hits))
            cols = list(zip(*hits)) or [(), (), (), ()]
            values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _FOUND_PA)], fields=list(_FOUND_PA))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    return find(text)


def sweep_hits(texts: DataFrame, keys: Sequence[str], text_col: str, keywords: DataFrame, radius: int,
               block_keywords: int = 100_000) -> DataFrame:
    """keys, ``_t`` (the text), dept, dept_ord, kw_ord, keyword, weight, cnt, pos,
    n_related of every (text, keyword) where the keyword occurs. A lexicon of more
    than one block reads the texts once a block. Texts null or empty have no hits;
    an empty lexicon gives no rows."""
    ship_by_value(__name__)
    spark = texts.sparkSession
    parts = []
    for depts in blocks_of(keywords, block_keywords):
        rows = [(r["dept"], r["keyword"], r["dept_ord"], r["kw_ord"], r["weight"]) for r in keywords.filter(
            F.col("dept").isin(depts)).select("dept", "keyword", "dept_ord", "kw_ord", "weight").collect()]
        if not rows:
            continue
        pair = {p: n for n, p in enumerate(sorted({r[:2] for r in rows}))}
        table = spark.createDataFrame([(pair[r[:2]], *r) for r in rows],
                                      "pair int, dept string, keyword string, dept_ord int, kw_ord int, weight double")
        shared = spark.sparkContext.broadcast([r[:2] for r in rows])
        hits = (texts.select(*keys, F.col(text_col).alias("_t"))
                .withColumn("_found", found_in(F.col("_t"), shared, radius)).filter(F.size("_found") > 0)
                .select(*keys, "_t", F.inline("_found")))
        small = len(rows) <= block_keywords
        parts.append(hits.join(F.broadcast(table) if small else table, "pair").drop("pair"))
    if not parts:
        empty = texts.select(*keys, F.col(text_col).alias("_t")).limit(0)
        return empty.select("*", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cnt", "long"), ("pos", "int"), ("n_related", "long"), ("dept", "string"), ("keyword", "string"),
            ("dept_ord", "int"), ("kw_ord", "int"), ("weight", "double"))])
    return reduce(DataFrame.unionByName, parts)
