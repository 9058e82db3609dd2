"""Hard negatives by coordinate pruning over length buckets.

Scores are integer inner products of quantised vectors. A search asks, for each
query vector, for the k best rows of the same (or of another) label whose score
lies within a range.

* Buckets. Rows are ordered into buckets by length (a factor of 0.9 each; small
  neighbours are joined) and buckets are dealt into blocks of bounded size,
  longest first. A query goes only to the blocks whose longest vector can
  reach the score that it needs.
* Lists. In a block each coordinate has a list of the rows sorted by its value,
  relative to the row's length. The score needed bounds the angle between query
  and row, and so the value that the row has at each of the query's largest
  coordinates (its focus). The rows in the shortest of the ranges are kept if
  they lie in all others, and only these are scored. Where the ranges leave most
  of a block, as they do in many dimensions, it is scored whole, in one matrix
  product for many queries.
* Bands. The queries of one anchor differ in their ranges of scores alone: they
  stand in one block, and its rows are scored once for all of them.
* Rounds. Every query first meets the longest block; its k-th score there is
  what the other blocks must reach. Blocks give k rows a query at most.

Queries come in blocks, too, and each pair of blocks is one group, so a task
holds a bounded number of rows whatever the table's size. Rows that the ranges
leave out can't be in the result: nothing is approximate.

Defined results: rows whose label, id or vector is null, or whose vector holds
a null or non-finite component, take no part; a shorter vector counts as filled
up with zeros; scaled components beyond 2**62 are held there, and scores at the
range of a long; rows that repeat id, label and vector count once; a row with
the anchor's id is not another row; ties go to the smaller id; an empty table
gives no rows; extra columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.scratch import Scratch
from curatio.operators.util import ship_by_value

_SHRINK = 0.9
_ZERO = -(1 << 20)               # bucket of vectors without length
_MOST = 1 << 62
#: Vectors that meet a whole block in one matrix product.
_TOGETHER = 128


@dataclass(frozen=True)
class MiningRules:
    scale: float = 256.0         # components are floor(scale * x)
    positives: int = 5
    negatives: int = 10
    low_percent: int = 30        # a negative's score, in hundredths of the positive's
    high_percent: int = 90
    focus: int = 6               # coordinates whose ranges are intersected
    block: int = 8192            # rows of a block
    queries: int = 4096          # queries of a block


def quantised(df: DataFrame, scale: float) -> DataFrame:
    """(id, label, v, length, bucket): v holds the scaled components as 64-bit
    integers; only rows that take part."""
    def run(batches):
        for batch in batches:
            col = batch.column("vec")
            size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = pc.fill_null(pc.list_flatten(col).cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            end = np.cumsum(size)
            begin = end - size
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.clip(np.nan_to_num(np.floor(scale * x)), -float(_MOST), float(_MOST)).astype(np.int64)
            rows = np.flatnonzero(bad[end] == bad[begin])
            v = [q[begin[i]:end[i]] for i in rows]
            length = np.array([float(np.sqrt((a.astype(np.float64) ** 2).sum())) for a in v])
            with np.errstate(divide="ignore"):
                bucket = np.where(length > 0, np.floor(np.log(length) / -np.log(_SHRINK)), _ZERO)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), batch.column("label").take(pa.array(rows)),
                 pa.array([a.tobytes() for a in v], pa.binary()), pa.array(length, pa.float64()),
                 pa.array(bucket.astype(np.int64))], ["id", "label", "v", "length", "bucket"])

    src = df.filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").select("id", "label", "vec")
    return src.mapInArrow(run, "id long, label int, v binary, length double, bucket long")


@dataclass(frozen=True)
class Plan:
    """Blocks in order of length: for each bucket (block of its first rows,
    number of blocks), and each block's longest vector."""
    first: dict
    longest: list

    @staticmethod
    def of(rows: DataFrame, rules: MiningRules) -> "Plan":
        # lengths span some 800 factors of two, so a few thousand buckets at most
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("most")).collect()
        first, longest, run, held, most = {}, [], [], 0, 0.0
        ordered = sorted(sizes, key=lambda r: -r["bucket"])
        for k, r in enumerate(ordered):
            run.append(r["bucket"])
            held += r["n"]
            most = max(most, r["most"])
            if held >= rules.block // 2 or k == len(ordered) - 1:
                blocks = -(-held // rules.block)
                first |= {b: (len(longest), blocks) for b in run}
                longest += [most] * blocks
                run, held, most = [], 0, 0.0
        return Plan(first, longest)

    def deal(self, rows: DataFrame) -> DataFrame:
        table = rows.sparkSession.createDataFrame([(b, f, n) for b, (f, n) in self.first.items()],
                                                  "bucket long, first long, blocks long")
        return (rows.join(F.broadcast(table), "bucket")
                .withColumn("block", F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("blocks")))
                .select("id", "label", "v", "length", "block"))

    def last_block(self, length: Column, need: Column) -> Column:
        """The last block whose longest vector can give the score needed."""
        steps = sorted({m: k for k, m in enumerate(self.longest)}.items(), reverse=True)
        most, last = (F.array(*[F.lit(float(s[k])) for s in steps]) for k in (0, 1))
        able = F.size(F.filter(most, lambda m: m * length * F.lit(1 + 1e-9) >= need))
        return F.when(need <= 0, F.lit(len(self.longest) - 1)).otherwise(
            F.when(able > 0, F.get(last, able - 1)).otherwise(F.lit(-1))).cast("long")


def _matrix(values) -> np.ndarray:
    """Vectors of 64-bit integers, filled up with zeros to one width."""
    v = [np.frombuffer(x.as_buffer(), np.int64) for x in values]
    out = np.zeros((len(v), max([len(a) for a in v], default=0)), np.int64)
    for i, a in enumerate(v):
        out[i, :len(a)] = a
    return out


def _score(v: np.ndarray, q: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products; ``top`` bounds the components' products."""
    if top * max(1, v.shape[1]) < 2.0 ** 52:
        return (v.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if top * max(1, v.shape[1]) < 2.0 ** 62:
        return v @ q
    exact = v.astype(object) @ q.astype(object)
    return np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in exact], np.int64)


class Block:
    """Rows of a block with lists sorted by coordinate, made on first use."""

    def __init__(self, ids, labels, v, lengths, width, focus):
        self.ids, self.labels, self.lengths, self.focus = ids, labels, lengths, focus
        self.v = np.pad(v, ((0, 0), (0, width - v.shape[1])))
        self.top = float(np.abs(self.v).max(initial=0))
        unit = np.where(lengths > 0, lengths, 1.0)
        self.unit = np.asfortranarray(self.v / unit[:, None])
        self.lists: dict[int, tuple] = {}
        self.rows_of: dict[tuple, np.ndarray] = {}
        # the scores of rows without length are zero, whatever the angle
        self.least, self.most = (float(f(lengths)) for f in (np.min, np.max))
        self.plain: dict[type, np.ndarray] = {}

    def scored(self, q) -> np.ndarray | None:
        """Scores of all rows for each vector of ``q``; None where neither kind
        of float holds every partial sum exactly."""
        bound = self.top * float(np.abs(q).max(initial=0)) * max(1, q.shape[1])
        kind = np.float32 if bound < 2.0 ** 23 else np.float64 if bound < 2.0 ** 52 else None
        if kind is None:
            return None
        if kind not in self.plain:
            self.plain[kind] = np.ascontiguousarray(self.v.T.astype(kind))
        return q.astype(kind) @ self.plain[kind]

    def labelled(self, label, same):
        """Rows of a label, or of all others."""
        if (label, same) not in self.rows_of:
            self.rows_of[label, same] = np.flatnonzero((self.labels == label) == same)
        return self.rows_of[label, same]

    def sorted_by(self, f):
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def feasible(self, q, length, low, high):
        """Rows whose score may lie within [low, high], by their values at the
        focus coordinates of the query; ``low`` and ``high`` may be None."""
        everything = np.arange(len(self.ids))
        if length == 0 or self.least == 0 or low is None and high is None:
            return everything
        slack = 1e-7
        cos = lambda s, least, most: s / (length * (most if s > 0 else least))
        wide = 0.0 if high is None else np.arccos(np.clip(cos(high, self.most, self.least) + slack, -1, 1))
        c = -1.0 if low is None else cos(low, self.least, self.most) - slack
        if c > 1:
            return everything[:0]
        narrow = np.arccos(np.clip(c, -1, 1))         # the angle lies within [wide, narrow]
        unit = q / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:self.focus]
        own = np.arccos(np.clip(unit[focus], -1, 1))
        near = np.maximum(np.maximum(own - narrow, wide - own), 0)
        far = np.minimum(np.minimum(own + narrow, 2 * np.pi - own - wide), np.pi)
        lower, upper = np.cos(np.maximum(far, near)) - slack, np.cos(near) + slack
        spans = []
        for f, lo, up in zip(focus, lower, upper):
            order, values = self.sorted_by(int(f))
            spans.append((int(np.searchsorted(values, lo)), int(np.searchsorted(values, up, "right")), order))
        a, b, order = min(spans, key=lambda s: s[1] - s[0])
        if b - a > 0.75 * len(order):                 # not worth the others
            return everything
        rows = order[a:b]
        for f, lo, up in zip(focus, lower, upper):
            x = self.unit[rows, f]
            rows = rows[(x >= lo) & (x <= up)]
        return rows

    def best(self, q, lengths, keys, same, bands, k):
        """For each vector, with its (label, own) and bands (low, high), the k
        best (score, id) of the rows that fit each band."""
        out = []
        for a in range(0, len(q), _TOGETHER):
            left = [self._left(q[i], lengths[i], keys[i][0], same, bands[i]) for i in range(a, min(a + _TOGETHER, len(q)))]
            most = [j for j, rows in enumerate(left) if 4 * len(rows) > len(self.ids)]
            whole = self.scored(q[[a + j for j in most]]) if most else None
            whole = {} if whole is None else dict(zip(most, whole))
            for j, rows in enumerate(left):
                i = a + j
                s = whole[j][rows] if j in whole else _score(self.v[rows], q[i], self.top * float(np.abs(q[i]).max(initial=0)))
                low = min((b[0] for b in bands[i]), default=None) if all(b[0] is not None for b in bands[i]) else None
                ok = self.ids[rows] != keys[i][1]
                if low is not None:
                    ok &= s >= low
                s, ids = s[ok].astype(np.int64), self.ids[rows[ok]]
                out.append([self._first(s, ids, *band, k) for band in bands[i]])
        return out

    def _left(self, q, length, label, same, bands):
        lows, highs = zip(*bands)
        rows = self.feasible(q, length, None if None in lows else min(lows), None if None in highs else max(highs))
        if len(rows) == len(self.ids):
            return self.labelled(label, same)
        return rows[(self.labels[rows] == label) == same]

    @staticmethod
    def _first(s, ids, low, high, k):
        if low is not None or high is not None:
            ok = np.ones(len(s), bool)
            if low is not None:
                ok &= s >= low
            if high is not None:
                ok &= s <= high
            s, ids = s[ok], ids[ok]
        if len(s) > k:                      # with all ties of the last place
            cut = np.partition(s, len(s) - k)[len(s) - k]
            s, ids = s[s >= cut], ids[s >= cut]
        found = []
        for x in sorted(zip((-s).tolist(), ids.tolist())):
            if not found or x != found[-1]:
                found.append(x)
            if len(found) == k:
                break
        return [(-a, b) for a, b in found]


def search(rows: DataFrame, plan: Plan, queries: DataFrame, same: bool, k: int, rules: MiningRules,
           scratch: Scratch, name: str) -> DataFrame:
    """(q, id, score): the k best rows of each query (q, own, label, v, length,
    low, high), of its label or (``same`` false) of another."""
    parts = max(1, -(-queries.count() // rules.queries))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("own", "label", "v"), F.lit(parts)))

    def probe(left, right):
        if not left.num_rows or not right.num_rows:
            return out([])
        v, q = _matrix(left.column("v")), _matrix(right.column("v"))
        width = max(v.shape[1], q.shape[1])
        block = Block(*(left.column(c).to_numpy() for c in ("id", "label")), v, left.column("length").to_numpy(),
                      width, rules.focus)
        q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
        cols = [right.column(c).to_pylist() for c in ("q", "own", "label", "v", "low", "high")]
        asked = {}                                       # the bands of each anchor
        for i, (key, own, label, vector, low, high) in enumerate(zip(*cols)):
            asked.setdefault((label, own, vector), []).append((i, key, (low, high)))
        first = [rows[0][0] for rows in asked.values()]
        best = block.best(q[first], right.column("length").to_numpy()[first], [a[:2] for a in asked], same,
                          [[band for *_, band in rows] for rows in asked.values()], k)
        found = [(key, r, s) for rows, each in zip(asked.values(), best) for (_, key, _), b in zip(rows, each) for s, r in b]
        return out(found)

    def out(found):
        return pa.table([pa.array([f[j] for f in found], pa.int64()) for j in range(3)], names=["q", "id", "score"])

    def met(asked, blocks):
        mine = blocks.select("id", "label", "v", "length", "block",
                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
        return (mine.groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
                .applyInArrow(probe, "q long, id long, score long"))

    longest = scratch.put(met(queries.withColumn("block", F.lit(0).cast("long")), rows.filter("block = 0")), f"{name}-first")
    reach = longest.groupBy("q").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    asked = queries.join(reach.select("q", "kth"), "q", "left").withColumn("low", F.greatest("low", "kth"))
    asked = asked.withColumn("last", F.when(F.col("low").isNull(), F.lit(len(plan.longest) - 1).cast("long"))
                             .otherwise(plan.last_block(F.col("length"), F.col("low"))))
    asked = asked.filter("last >= 1").withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), "last")))
    found = longest.unionByName(met(asked, rows.filter("block > 0")))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return scratch.put(found.withColumn("place", place).filter(F.col("place") <= k), name)


def hard_negatives(vectors: DataFrame, anchors: Column, rules: MiningRules | None = None, id_col: str = "vec_id",
                   vec_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """Per anchor (rows where ``anchors`` holds), positive and rank: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score."""
    rules = rules or MiningRules()
    ship_by_value(__name__)
    scratch = Scratch(vectors.sparkSession, "negatives")
    label = vectors["label"] if label is None else label
    src = vectors.select(vectors[id_col].cast("long").alias("id"), label.cast("int").alias("label"),
                         vectors[vec_col].alias("vec"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    rows = scratch.put(quantised(src, rules.scale).distinct(), "rows")
    plan = Plan.of(rows, rules)
    marked = quantised(src.filter("anchor"), rules.scale).distinct()
    if not plan.longest:
        plan = Plan({}, [0.0])
    rows = scratch.put(plan.deal(rows), "dealt")
    none = F.lit(None).cast("long")
    asked = scratch.put(marked.select(F.monotonically_increasing_id().alias("q"), F.col("id").alias("own"), "label", "v",
                                      "length", none.alias("low"), none.alias("high")), "anchors")
    best = search(rows, plan, asked, True, rules.positives, rules, scratch, "positives")
    score = F.col("score").cast("decimal(25,0)")
    banded = (asked.drop("low", "high").join(best.filter("score >= 0"), "q")
              .withColumn("low", _div(score * rules.low_percent + 99)).withColumn("high", _div(score * rules.high_percent)))
    banded = scratch.put(banded.select(F.monotonically_increasing_id().alias("q"), "own", "label", "v", "length", "low",
                                       "high", F.col("id").alias("positive"), "score"), "bands")
    found = search(rows, plan, banded.drop("positive", "score"), False, rules.negatives, rules, scratch, "found")
    scratch.drop("rows", "dealt", "anchors", "positives", "positives-first", "found-first")
    return (found.withColumnsRenamed({"score": "negative_score", "id": "negative_id"})
            .join(banded.select("q", "own", "positive", "score"), "q")
            .select(F.col("own").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("place").alias("rank"),
                    "negative_id", F.col("score").alias("positive_score"), "negative_score"))


def _div(hundredths: Column) -> Column:
    return F.floor(hundredths / F.lit(100).cast("decimal(3,0)")).cast("long")
