"""Approximate nearest neighbours by learned partitions.

Fit (on a bounded, documented sample of distinct vectors, those with the
smallest hashes): the sample's exact neighbour graph is cut into balanced parts
- a recursive split by the graph's smooth direction, then moves that raise the
number of neighbours in the same part within a size limit - and a small network
learns to tell a vector's part. The number of parts that a query probes is the
smallest that finds the wanted share of neighbours of sample rows held back
from training.

Index: every vector goes to its most probable part. Search: each query goes to
its most probable parts; in each, blocks of bounded size are scanned exactly
(Euclidean distance in double precision on the original vectors), and the ten
nearest of all blocks stay.

Scale: equal vectors meet first in a map-side aggregate that keeps the ``k + 1``
smallest ids, which is all that ties can ask for, so a vector that a third of
the rows hold is one index row. Large parts are split into blocks by hash.

Defined results: vectors that are null, empty, zero, of another length than
most of the sample's, or that hold a null, NaN or infinite component take no
part; a null id is no query and no candidate; rows that repeat an id count
once per distinct vector; ties go to the smaller id; fewer candidates than
``k`` are all returned; an empty table gives no rows; extra columns are
ignored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.scratch import Scratch
from curatio.operators.util import ship_by_value


@dataclass(frozen=True)
class AnnRules:
    k: int = 10
    sample: int = 6000          # vectors that the partition is learned from
    held_back: int = 300        # of these, for the number of probes
    parts: int = 16
    graph_k: int = 10
    hidden: int = 64
    epochs: int = 30
    recall: float = 0.97        # wanted on the held-back vectors
    block: int = 4096           # index rows scanned together
    query_block: int = 512
    seed: int = 11


def usable(v: Column) -> Column:
    """Not null, and every component finite, and not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """Exact k nearest rows of each row, itself excluded, in blocks."""
    out, sq = [], (x * x).sum(1)
    for i in range(0, len(x), 512):
        d = sq[None] - 2 * x[i:i + 512] @ x.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out.append(np.argpartition(d, k, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(graph: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """Parts of nearly equal size with many graph edges inside."""
    n, rng = len(graph), np.random.default_rng(seed)
    part = np.zeros(n, np.int64)
    groups = [np.arange(n)]
    while len(groups) < parts:
        groups.sort(key=len)
        g = groups.pop()
        # smooth direction: random values averaged over neighbours again and again
        where = np.full(n, -1)
        where[g] = np.arange(len(g))
        local = where[graph[g]]
        v = rng.normal(size=(len(g), 8))
        for _ in range(40):
            near = np.where(local[..., None] >= 0, v[local], 0)
            new = v + near.sum(1)
            np.add.at(new, local[local >= 0], np.repeat(v, (local >= 0).sum(1), axis=0))
            v, _ = np.linalg.qr(new - new.mean(0))
        order = np.argsort(v[:, 0], kind="stable")
        groups += [g[order[:len(g) // 2]], g[order[len(g) // 2:]]]
    for p, g in enumerate(groups):
        part[g] = p
    size, limit = np.bincount(part, minlength=parts), int(1.15 * n / parts) + 1
    for _ in range(5):
        votes = np.zeros((n, parts))
        for j in range(graph.shape[1]):
            votes[np.arange(n), part[graph[:, j]]] += 1
            np.add.at(votes, (graph[:, j], part), 1)
        gain = votes.max(1) - votes[np.arange(n), part]
        for i in np.argsort(-gain, kind="stable"):
            to = int(votes[i].argmax())
            if gain[i] > 0 and size[to] < limit:
                size[part[i]] -= 1
                size[to] += 1
                part[i] = to
    return part


def _forward(x: np.ndarray, m: dict) -> np.ndarray:
    h = np.maximum((x - m["mean"]) / m["scale"] @ m["w1"] + m["b1"], 0)
    return h @ m["w2"] + m["b2"]


def learn(x: np.ndarray, rules: AnnRules) -> dict:
    """Partition, classifier and probes of a sample (rows in a fixed order)."""
    parts = max(1, min(rules.parts, len(x) // 64))
    model = {"parts": parts, "probes": 1, "dim": x.shape[1], "mean": x.mean(0), "scale": x.std() + 1e-9,
             "w1": np.zeros((x.shape[1], 1)), "b1": np.zeros(1), "w2": np.zeros((1, parts)), "b2": np.zeros(parts)}
    if parts == 1:
        return model
    held = min(rules.held_back, len(x) // 5)
    test, x = x[:held], x[held:]
    part = balanced_parts(_neighbours(x, rules.graph_k), parts, rules.seed)
    rng = np.random.default_rng(rules.seed)
    z = (x - model["mean"]) / model["scale"]
    p = {"w1": rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], rules.hidden)), "b1": np.zeros(rules.hidden),
         "w2": rng.normal(0, rules.hidden ** -0.5, (rules.hidden, parts)), "b2": np.zeros(parts)}
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for epoch in range(rules.epochs):
        for at in np.array_split(rng.permutation(len(z)), max(1, len(z) // 128)):
            h = np.maximum(z[at] @ p["w1"] + p["b1"], 0)
            o = h @ p["w2"] + p["b2"]
            o = np.exp(o - o.max(1, keepdims=True))
            o /= o.sum(1, keepdims=True)
            o[np.arange(len(at)), part[at]] -= 1
            o /= len(at)
            dh = (o @ p["w2"].T) * (h > 0)
            g = {"w2": h.T @ o, "b2": o.sum(0), "w1": z[at].T @ dh, "b1": dh.sum(0)}
            step += 1
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                p[k] -= 0.004 * (1 - 0.9 * epoch / rules.epochs) * (m1[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    model.update(p)
    # probes: held-back vectors as queries on the rest
    home = _forward(x, model).argmax(1)
    d = (x * x).sum(1)[None] - 2 * test @ x.T
    want = home[np.argpartition(d, rules.k, axis=1)[:, :rules.k]]
    rank = np.argsort(np.argsort(-_forward(test, model), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(rank, want, 1)
    for probes in range(1, parts + 1):
        model["probes"] = probes
        if (needed < probes).mean() >= rules.recall:
            break
    return model


def fit(vectors: DataFrame, rules: AnnRules, vec_col: str = "embedding") -> dict | None:
    """Learn from the distinct usable vectors with the smallest hashes
    (``rules.sample`` of them reach the driver); None if there is none."""
    v = F.col(vec_col)
    rows = (vectors.filter(usable(v)).select(v.cast("array<double>").alias("v"))
            .select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(3 * rules.sample)
            .dropDuplicates(["h"]).orderBy("h").limit(rules.sample).collect())
    if not rows:
        return None
    dims = [len(r.v) for r in rows]
    dim = max(set(dims), key=lambda d: (dims.count(d), -d))
    return learn(np.array([r.v for r in rows if len(r.v) == dim]), rules)


def search(vectors: DataFrame, queries: Column, rules: AnnRules | None = None, id_col: str = "vec_id",
           vec_col: str = "embedding", model: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score for the rows where ``queries`` holds."""
    rules = rules or AnnRules()
    ship_by_value(__name__)
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    src = vectors.filter(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
    model = model or fit(vectors, rules, vec_col)
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)
    k, dim = rules.k, model["dim"]
    src = src.withColumn("__q", queries).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.col("__q").alias("q")) \
        .filter(F.size("v") == dim)
    scratch = Scratch(spark, "ann")

    # equal vectors are one index row with their k + 1 smallest ids
    one = src.select("v", "id").distinct().withColumn("h", F.xxhash64("v"))
    top = Window.partitionBy("h", "v").orderBy("id")
    classes = (one.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k + 1)
               .groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")))

    def place(batches):
        for pdf in batches:
            x = np.stack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, dim))
            yield pd.DataFrame({"part": _forward(x, shared.value).argmax(1), "h": pdf["h"], "v": pdf["v"], "ids": pdf["ids"]})

    index = scratch.put(classes.select("h", "v", "ids").mapInPandas(
        place, "part int, h long, v array<double>, ids array<long>"), "index")
    sizes = {r.part: r.n for r in index.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {p: -(-n // rules.block) for p, n in sizes.items()}

    def route(batches):
        for pdf in batches:
            x = np.stack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, dim))
            order = np.argsort(-_forward(x, shared.value), axis=1, kind="stable")
            rows = []
            for i, v, ranked in zip(pdf["id"], pdf["v"], order):
                full = [p for p in ranked if p in blocks]
                rows += [(int(p), b, i, v) for p in full[:shared.value["probes"]] for b in range(blocks[p])]
            yield pd.DataFrame(rows, columns=["part", "block", "id", "v"])

    asked = (src.filter("q").select("id", "v").distinct()
             .mapInPandas(route, "part int, block int, id long, v array<double>"))
    counts = F.create_map(*[F.lit(x) for p, b in sorted(blocks.items()) for x in (p, b)])
    held = index.withColumn("block", F.pmod("h", F.element_at(counts, F.col("part"))).cast("int"))

    def scan(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x = np.stack(left["v"].to_numpy())
            ids = left["ids"].to_numpy()
            for qid, qv in zip(right["id"].to_numpy(), right["v"].to_numpy()):
                d = np.sqrt(((x - qv) ** 2).sum(axis=1))
                # every class that could reach the k nearest, ties included
                cut = np.partition(d, min(k, len(d) - 1))[min(k, len(d) - 1)]
                found = sorted((d[i], int(c)) for i in np.flatnonzero(d <= cut) for c in ids[i] if c != qid)
                out += [(int(qid), c, float(s)) for s, c in found[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    near = held.groupBy("part", "block").cogroup(asked.groupBy("part", "block")).applyInPandas(
        scan, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
