"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns (role and text); its key is a sum
of two 64-bit hashes of (turn, position), so keys of all prefixes are running
sums (:mod:`curatio.llm.running`) and a conversation may be of any length.

* Tour. Nodes are numbered in the order (parent, smallest member), so that the
  next sibling has the next number. Each node has an arc that enters it and one
  that leaves it; a node needs its first and last child, and only first and
  last children need their parent, so a node with many children is no hot key.
* Ranking. The tour is a linked list. In each round the arcs whose random
  priority is less than that of both neighbours leave the list (a third on
  average) and hand their length to the one before; when ``base`` arcs are left, one
  task ranks them, and the rounds are undone in reverse. All rounds together
  move about six times as many rows as there are arcs.
* Sums. In tour order, running sums of leaves and savings at the arcs of a node
  give those of its subtree as a difference.

Defined results: rows without a conversation id belong to none; null role or
text counts as empty; turns are ordered by ``turn`` (null first), ties by a
hash of role and text; repeated rows are turns of their own; an empty table
gives no rows; extra columns are ignored. A digest over the members that end at
a node is sequential by its nature: the ids are sorted and joined to pieces in
all tasks, and one task then hashes the pieces of a node as they stream by."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.llm.running import running
from curatio.llm.scratch import Scratch
from curatio.operators.util import ship_by_value

WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class TrieRules:
    every: int = 20          # conversation c takes over first turns of c - c % every
    most: int = 4            # so many turns: crc32(c) % most
    base: int = 4096         # arcs of a list that one task ranks
    piece: int = 4096        # ids joined to one piece of a digest's input


def _turns(conv: DataFrame) -> DataFrame:
    """(c, turn, t1, t2, words): narrow rows, two hashes for role and text."""
    role, text = (F.coalesce(conv[c], F.lit("")) for c in ("role", "text"))
    return conv.filter(conv["conv_id"].isNotNull()).select(
        conv["conv_id"].cast("long").alias("c"), conv["turn"].alias("turn"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit("second"), text, role).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.lit(1).cast("long").alias("one"),
        F.monotonically_increasing_id().alias("row"))


def rebuilt(conv: DataFrame, rules: TrieRules, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(c, j, t1, t2, words, last) of every rebuilt turn, and (c, d) of every
    conversation, whose rebuilt length is d."""
    rows = running(_turns(conv), ["c", "turn", "t1", "t2", "row"], ["one"], scratch, "turns", group="c")
    rows = rows.select("c", F.col("one_before").alias("i"), "t1", "t2", "words")
    # the few first turns of a conversation that others may take over
    head = F.array_sort(F.collect_list(F.when(F.col("i") < rules.most - 1, F.struct("i", "t1", "t2", "words"))))
    convs = scratch.put(rows.groupBy("c").agg((F.max("i") + 1).alias("n"), head.alias("head")), "convs")
    own = F.col("c") % rules.every == 0
    h = F.when(own, 0).otherwise(F.crc32(F.col("c").cast("string").cast("binary")) % rules.most)
    base = convs.select(F.col("c").alias("b"), F.col("head").alias("base"), F.col("n").alias("base_n"))
    starts = (convs.withColumn("h", h.cast("long")).withColumn("b", F.when(~own, F.col("c") - F.col("c") % rules.every))
              .join(base, "b", "left")
              .withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0)))))
    starts = scratch.put(starts.select(
        "c", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("d"),
        F.when(F.col("m") > 0, F.slice("base", F.lit(1), F.col("m").cast("int"))).alias("base")), "starts")
    later = (rows.join(starts.select("c", "h", "m", "d"), "c").filter("i >= h")
             .select("c", (F.col("i") - F.col("h") + F.col("m")).alias("j"), "t1", "t2", "words", "d"))
    taken = (starts.filter("m > 0").select("c", "d", F.posexplode("base").alias("j", "x"))
             .select("c", F.col("j").cast("long").alias("j"), "x.t1", "x.t2", "x.words", "d"))
    turns = later.unionByName(taken).withColumn("last", F.col("j") == F.col("d") - 1).drop("d")
    return turns, starts.select("c", "d")


def trie_nodes(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Nodes (k1, k2, p1, p2, depth, conv_id, n_convs, words), and (k1, k2, c)
    of every conversation with the node that it ends at."""
    hashed = turns.select("c", "j", "words", "last", F.xxhash64("t1", "j").alias("a"),
                          F.xxhash64("j", "t2").alias("b"))
    at = scratch.put(running(hashed, ["c", "j"], ["a", "b"], scratch, "prefixes", group="c").select(
        "c", (F.col("j") + 1).alias("depth"), "words", "last", F.col("a_upto").alias("k1"), F.col("b_upto").alias("k2"),
        F.col("a_before").alias("p1"), F.col("b_before").alias("p2")), "at")
    zero = F.lit(0).cast("long")
    root = (convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id")).filter("n_convs > 0")
            .select(zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("p1"),
                    F.lit(None).cast("long").alias("p2"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("words")))
    nodes = at.groupBy("k1", "k2").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("depth").alias("depth"), F.min("c").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words")).unionByName(root)
    ends = at.filter("last").select("k1", "k2", "c").union(
        convs.filter("d = 0").select(zero.alias("k1"), zero.alias("k2"), "c"))
    return nodes, ends


def euler_arcs(nodes: DataFrame) -> DataFrame:
    """(arc, prev, next) of numbered nodes (id, parent's key p1 and p2, first
    and last child fc and lc): arc ``2 id`` enters a node, ``2 id + 1`` leaves it."""
    up = (nodes.filter("fc IS NOT NULL")
          .select(F.explode(F.array_distinct(F.array("fc", "lc"))).alias("id"), F.col("id").alias("parent"),
                  F.col("fc").alias("first"), F.col("lc").alias("final")))
    n = nodes.select("id", "fc", "lc", F.col("p1").isNull().alias("root")).join(up, "id", "left")
    i, parent = F.col("id"), F.col("parent")
    enter = F.struct((2 * i).alias("arc"),
                     F.when(~F.col("root"), F.when(i == F.col("first"), 2 * parent).otherwise(2 * i - 1)).alias("prev"),
                     F.coalesce(2 * F.col("fc"), 2 * i + 1).alias("next"))
    leave = F.struct((2 * i + 1).alias("arc"), F.coalesce(2 * F.col("lc") + 1, 2 * i).alias("prev"),
                     F.when(~F.col("root"), F.when(i == F.col("final"), 2 * parent + 1).otherwise(2 * i + 2)).alias("next"))
    return n.select(F.explode(F.array(enter, leave)).alias("a")).select("a.*")


def _leaves(k: int) -> Column:
    """Arcs that leave the list in round k: no two neighbours, and never an end."""
    p = lambda c: F.xxhash64(F.col(c), F.lit(k))
    return F.col("prev").isNotNull() & F.col("next").isNotNull() & (p("arc") < p("prev")) & (p("arc") < p("next"))


def list_rank(arcs: DataFrame, rules: TrieRules, scratch: Scratch) -> DataFrame:
    """(arc, after): how many arcs of the one list (arc, prev, next) come after."""
    lists = [scratch.put(arcs.withColumn("w", F.lit(1).cast("long")), "list-0")]
    while (left := lists[-1].count()) > rules.base:
        k, rows = len(lists) - 1, lists[-1]
        none = F.lit(None).cast("long")
        row = lambda a, p, n, p2, n2, w: F.struct(a.alias("arc"), p.alias("prev"), n.alias("next"), p2.alias("p2"),
                                                  n2.alias("n2"), w.alias("w"))
        arc, prev, nxt, w = (F.col(c) for c in ("arc", "prev", "next", "w"))
        told = F.when(_leaves(k), F.array(row(prev, none, none, none, nxt, w),
                                          row(nxt, none, none, prev, none, F.lit(0).cast("long")))
                      ).otherwise(F.array(row(arc, prev, nxt, none, none, w)))
        new = (rows.select(F.explode(told).alias("m")).select("m.*").groupBy("arc")
               .agg(F.coalesce(F.max("p2"), F.max("prev")).alias("prev"),
                    F.coalesce(F.max("n2"), F.max("next")).alias("next"), F.sum("w").alias("w")))
        lists.append(scratch.put(new, f"list-{k + 1}"))

    def rank(batches):
        rows = {a: (p, w, n) for b in batches for a, p, w, n in zip(*(b.column(c).to_pylist() for c in ("arc", "prev", "w", "next")))}
        found, arc, after = [], next((a for a, r in rows.items() if r[2] is None), None), 0
        while arc is not None:
            found.append((arc, after))
            arc = rows[arc][0]
            if arc is not None:
                after += rows[arc][1]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["arc", "after"])

    ranked = scratch.put(lists[-1].coalesce(1).mapInArrow(rank, "arc long, after long"), "ranked")
    for k in range(len(lists) - 2, -1, -1):
        gone = lists[k].filter(_leaves(k)).select("arc", "next", "w").join(
            ranked.select(F.col("arc").alias("next"), "after"), "next").select("arc", (F.col("after") + F.col("w")).alias("after"))
        wider = scratch.put(ranked.union(gone), f"ranked-{k}")
        scratch.drop("ranked" if k == len(lists) - 2 else f"ranked-{k + 1}")
        ranked = wider
    scratch.drop(*[f"list-{k}" for k in range(len(lists))])
    return ranked


def end_digests(ends: DataFrame, rules: TrieRules) -> DataFrame:
    """(k1, k2, sha): SHA-256 of the ascending decimal ids that end at a node,
    joined by commas."""
    def pieces(batches):
        key, ids = None, []
        for batch in batches:
            out = []
            for *k, c in zip(*(batch.column(x).to_pylist() for x in ("k1", "k2", "c"))):
                if k != key or len(ids) >= rules.piece:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = k, []
                ids.append(c)
            yield table(out)
        if ids:
            yield table([(*key, ids[0], ",".join(map(str, ids)))])

    def table(rows):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                          ["k1", "k2", "c", "ids"])

    def digest(batches):
        key, sha = None, None
        for batch in batches:
            out = []
            for *k, ids in zip(*(batch.column(x).to_pylist() for x in ("k1", "k2", "ids"))):
                if k == key:
                    sha.update(b",")
                else:
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                sha.update(ids.encode())
            yield digests(out)
        if key:
            yield digests([(*key, sha.hexdigest())])

    def digests(rows):
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["k1", "k2", "sha"])

    cut = (ends.repartitionByRange("k1", "k2", "c").sortWithinPartitions("k1", "k2", "c")
           .mapInArrow(pieces, "k1 long, k2 long, c long, ids string"))
    return (cut.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "c")
            .mapInArrow(digest, "k1 long, k2 long, sha string"))


def prefix_trie(conv: DataFrame, rules: TrieRules | None = None) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves and saved_tokens of its subtree, ends_sha256."""
    rules = rules or TrieRules()
    ship_by_value(__name__)
    scratch = Scratch(conv.sparkSession, "trie")
    turns, convs = rebuilt(conv, rules, scratch)
    nodes, ends = trie_nodes(turns, convs, scratch)
    nodes = scratch.put(nodes, "nodes")
    digests = scratch.put(end_digests(ends, rules), "digests")
    scratch.drop("turns-local", "prefixes-local", "at", "convs", "starts")
    # siblings stand together, ordered by their smallest member
    nodes = running(nodes.withColumn("one", F.lit(1).cast("long")), ["p1", "p2", "conv_id"], ["one"], scratch, "numbers")
    nodes = nodes.withColumnRenamed("one_before", "id").drop("one", "one_upto")
    kids = (nodes.filter("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
            .agg(F.min("id").alias("fc"), F.max("id").alias("lc"), F.count(F.lit(1)).alias("n_children")))
    nodes = scratch.put(nodes.join(kids, ["k1", "k2"], "left"), "numbered")
    scratch.drop("nodes", "numbers-local")
    ranks = list_rank(euler_arcs(nodes), rules, scratch)
    leaf = F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")
    zero = F.lit(0).cast("long")
    weights = nodes.select(F.explode(F.array(
        F.struct((2 * F.col("id")).alias("arc"), leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("save")),
        F.struct((2 * F.col("id") + 1).alias("arc"), zero.alias("leaf"), zero.alias("save")))).alias("a")).select("a.*")
    tour = weights.join(ranks, "arc").select("arc", "leaf", "save", (-F.col("after")).alias("at"))
    sums = (running(tour, ["at"], ["leaf", "save"], scratch, "tour").groupBy(F.expr("arc div 2").alias("id"))
            .agg((F.max("leaf_upto") - F.min("leaf_before")).alias("n_leaves"),
                 (F.max("save_upto") - F.min("save_before")).alias("saved_tokens")))
    parent = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(sums, "id").join(digests, ["k1", "k2"], "left").join(parent, ["p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs",
                    F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256")))
