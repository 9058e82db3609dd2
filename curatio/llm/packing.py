"""Best-fit packing into sequences of several permitted lengths.

A document's words, and one separator after them, are laid into bins. Pieces
longer than the largest permitted length are cut at it. Pieces, longest first,
go to the open bin that they fill best; where none has room, the bin size of
least cost is opened: its cost, spread over what could still come into it. Each
choice of the largest size that may be opened is tried, and the cheapest whole
packing stays. Finally each bin is cut down to the smallest permitted length
that holds its contents.

Scale: pieces are dealt by hash to shards of bounded size (a parameter), which
are packed apart; each is one group of a few thousand narrow rows, so neither
texts nor a whole corpus meet in a task. A hot source or a group of copies
spreads over the shards, as the hash takes id and piece.

Defined results: null texts and texts without words have no piece: one row with
``n_words`` 0 and null bin; null ids are packed like others; rows that repeat
are pieces of their own; ties go by id, then piece; an empty table gives no
rows; extra columns are ignored."""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.operators.util import ship_by_value


@dataclass(frozen=True)
class PackRules:
    lengths: tuple[int, ...] = (256, 512, 1024, 2048, 4096)
    separator: int = 1                 # after each document
    bin_cost: float = 32.0             # of a bin, beside one for each place in it
    shard_pieces: int = 2048


def _cost(size: int, rules: PackRules) -> float:
    return size + rules.bin_cost


def _smallest(length: int, sizes) -> int:
    return next(s for s in sizes if s >= length)


def _best_fit(lengths: list[int], rules: PackRules, largest: int) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, its offset, contents of each bin) of pieces given
    longest first. Sizes over ``largest`` open only for pieces that need them."""
    sizes = sorted(rules.lengths)
    left = sum(lengths)
    room: list[tuple[int, int]] = []            # (free places, bin), sorted
    used, capacity, where, offset = [], [], [], []
    for n in lengths:
        at = bisect.bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fits = [s for s in sizes if s >= n and (s <= largest or s == _smallest(n, sizes))]
            # the cost of a place that can be filled with what is left
            size = min(fits, key=lambda s: (_cost(s, rules) / min(s, left), s))
            free, b = size, len(used)
            used.append(0)
            capacity.append(size)
        where.append(b)
        offset.append(used[b])
        used[b] += n
        left -= n
        if free - n > 0:
            bisect.insort(room, (free - n, b))
    return where, offset, used


def pack_pieces(lengths: list[int], rules: PackRules) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset, size of its bin) of each piece, pieces longest first: the
    cheapest packing over the choices of the largest size that may open."""
    sizes, best = sorted(rules.lengths), None
    for largest in sizes:
        where, offset, used = _best_fit(lengths, rules, largest)
        final = [_smallest(u, sizes) for u in used]                # downsized to the contents
        cost = sum(_cost(s, rules) for s in final)
        if best is None or cost < best[0]:
            best = (cost, where, offset, final)
    _, where, offset, final = best
    return where, offset, [final[b] for b in where]


def pieces_of(docs: DataFrame, rules: PackRules, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, piece, start_word, n_places, salt): the pieces of each text."""
    n = F.coalesce(F.regexp_count(docs[text_col], F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    top = max(rules.lengths)
    src = docs.select(docs[id_col].alias("id"), n.alias("n_words"), F.xxhash64(docs[text_col]).alias("salt"))
    src = src.withColumn("places", F.when(F.col("n_words") > 0, F.col("n_words") + rules.separator).otherwise(0))
    last = F.greatest(F.lit(0), F.ceil(F.col("places") / top) - 1)
    return (src.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
            .withColumn("start_word", F.col("piece") * top)
            .withColumn("n_places", F.least(F.lit(top), F.col("places") - F.col("start_word"))))


def pack(docs: DataFrame, rules: PackRules | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, n_words of the text, piece (from 0), start_word,
    n_places (words and separator), bin_id, bin_offset, bin_size."""
    rules = rules or PackRules()
    ship_by_value(__name__)
    pieces = pieces_of(docs, rules, id_col, text_col)
    # number of shards: pieces are counted by one aggregate
    shards = max(1, -(-pieces.count() // rules.shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "salt"), F.lit(shards)))
    id_type = pieces.schema["id"].dataType.simpleString()

    names = ["id", "n_words", "piece", "start_word", "n_places"]

    def one(key, table):
        table = table.sort_by([("n_places", "descending"), ("id", "ascending"), ("piece", "ascending"),
                               ("salt", "ascending")])
        lengths = [n for n in table.column("n_places").to_pylist() if n > 0]      # empty ones stand last
        where, offset, size = pack_pieces(lengths, rules) if lengths else ([], [], [])
        first, none = key[0].as_py() << 32, [None] * (table.num_rows - len(lengths))
        cols = [[first + b for b in where] + none, offset + none, size + none]
        return pa.table([table.column(c) for c in names] + [pa.array(c, pa.int64()) for c in cols],
                        names=names + ["bin_id", "bin_offset", "bin_size"])

    packed = dealt.groupBy("shard").applyInArrow(
        one, f"id {id_type}, n_words long, piece long, start_word long, n_places long, "
             "bin_id long, bin_offset long, bin_size long")
    return packed.withColumnRenamed("id", id_col)
