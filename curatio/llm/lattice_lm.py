"""Document probability under a subword lattice.

A text is its words (runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased) and one end.
A unigram distribution over the pieces of an existing vocabulary gives each
word the total weight of its segmentations (:mod:`curatio.llm.lattice`), and the
document the product. The distribution starts from the vocabulary's own scores
and is fitted to the training documents by expected counts; the set of pieces
is never changed. An add-one word model over the same training
documents stands beside it.

* Every distinct word of the corpus is one row, with its count in training
  documents and its marginal: the recursion runs once a word, not once an
  occurrence, and what is gathered grows with the corpus.
* The most frequent words (a bounded list) go to the tasks as sorted arrays,
  and their occurrences are scored where they are read. All other words of a
  document, once each, meet the table of words in a join; no word there is in more
  than a small share of the occurrences, so none is a hot key.

Words of a chunk are told apart by 64-bit hashes, across chunks by themselves.
Defined results: null or empty text is the end alone; a null id is in no held-out
part; repeated rows and ties are scored alike; without training documents all
counts are 0 and pieces have their prior alone; an empty table gives no rows;
extra columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.llm import lattice
from curatio.llm import textnum as tn
from curatio.llm.scratch import Scratch
from curatio.operators.util import ship_by_value

U = np.uint64
CHUNK = 4 << 20


@dataclass(frozen=True)
class LatticeRules:
    vocabulary: bytes            # a SentencePiece model file
    rounds: int = 2              # of expected counts
    prior: float = 0.1           # added to the expected count of each piece
    frequent: int = 262_144      # words scored without a join (6 MB broadcast)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray          # natural log probabilities of the pieces
    end: float


def _words(part: pa.RecordBatch, hasher: tn.Hasher):
    buf, offsets = tn.as_bytes(part.column("text"))
    low = tn.lower_ascii(buf)
    start, end, row = tn.runs(low, offsets, tn.NOT_SPACE)
    return low, start, end, row, hasher.ranges(low, start, end)


def _strings(low: np.ndarray, start, end) -> list[str]:
    raw = low.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(start.tolist(), end.tolist())]


def word_table(docs: DataFrame) -> DataFrame:
    """(word, n, c): occurrences in all documents and in training documents of
    (text, train)."""
    def run(batches):
        hasher = tn.Hasher()
        for batch in batches:
            for part in tn.chunks(batch, "text", CHUNK):
                low, start, end, row, h = _words(part, hasher)
                train = part.column("train").to_numpy(zero_copy_only=False).astype(bool)
                _, first, at, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                c = np.bincount(at, train[row], minlength=len(n)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_strings(low, start[first], end[first]), pa.string()), pa.array(n.astype(np.int64)), pa.array(c)],
                    ["word", "n", "c"])

    return (docs.select("text", "train").mapInArrow(run, "word string, n long, c long")
            .groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c")))


def fit(words: DataFrame, n_docs: int, rules: LatticeRules) -> Model:
    """Piece weights by expected counts over the training words (word, c)."""
    pieces = lattice.Pieces(rules.vocabulary)
    weights, end = pieces.first_weights(), 0.0
    spark, model = words.sparkSession, rules.vocabulary
    for _ in range(rules.rounds):
        shared = spark.sparkContext.broadcast(weights)

        def expect(batches):
            grid, uses = lattice.Lattice(lattice.Pieces(model), shared.value), 0.0
            for batch in batches:
                n = batch.column("c").to_numpy(zero_copy_only=False).astype(np.float64)
                uses = uses + grid.run(batch.column("word").to_pylist(), n)[1]
            at = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.atleast_1d(uses)[at], pa.float64())], ["piece", "uses"])

        got = (words.filter("c > 0").select("word", "c").mapInArrow(expect, "piece long, uses double")
               .groupBy("piece").agg(F.sum("uses").alias("uses")).collect())            # a row a piece
        uses = np.full(pieces.size, -np.inf)
        uses[pieces.used] = rules.prior
        for r in got:
            uses[r["piece"]] += r["uses"]
        total = uses[pieces.used].sum() + n_docs + rules.prior
        weights = np.full(pieces.size, -np.inf)
        weights[pieces.used] = np.log(uses[pieces.used] / total)
        end = float(np.log((n_docs + rules.prior) / total))
    return Model(weights, end)


def with_marginals(words: DataFrame, fitted: Model, rules: LatticeRules) -> DataFrame:
    """(word, n, c, lp): the log10 marginal of each word."""
    shared, model = words.sparkSession.sparkContext.broadcast(fitted.weights), rules.vocabulary

    def run(batches):
        grid = lattice.Lattice(lattice.Pieces(model), shared.value)
        for batch in batches:
            lp, _ = grid.run(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lp / np.log(10))], ["word", "n", "c", "lp"])

    return words.select("word", "n", "c").mapInArrow(run, "word string, n long, c long, lp double")


def _frequent(words: DataFrame, most: int):
    """Sorted hashes of the most frequent words, as many as fit, with counts
    and marginals."""
    levelled = words.withColumn("level", F.floor(8 * F.log2("n")).cast("int"))
    room, cut = most, None
    for level, n in sorted(levelled.groupBy("level").count().collect(), reverse=True):
        room -= n
        if room < 0:
            break
        cut = level
    if cut is None:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0)
    top = levelled.filter(F.col("level") >= cut).select("word", "c", "lp").toPandas()
    raw = [w.encode() for w in top["word"]]
    size = np.array([len(r) for r in raw], np.int64)
    end = np.cumsum(size + 1) - 1
    h = tn.Hasher().ranges(np.frombuffer(b" ".join(raw), np.uint8), end - size, end)
    order = np.argsort(h)
    return h[order], top["c"].to_numpy(np.int64)[order], top["lp"].to_numpy(np.float64)[order]


def _scored(docs: DataFrame, words: DataFrame, rules: LatticeRules) -> DataFrame:
    """(id, held_out, n_words, logs, known, lp, rest): sums over the frequent
    words, and the other words with their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(words, rules.frequent))

    def run(batches):
        hasher, (keys, c, lp) = tn.Hasher(), shared.value
        logs = np.log10(c + 1.0)
        for batch in batches:
            for part in tn.chunks(batch, "text", CHUNK):
                low, start, end, row, h = _words(part, hasher)
                n = part.num_rows
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                total = lambda x: np.bincount(row[hit], x[at[hit]], minlength=n).astype(float)
                rest = np.flatnonzero(~hit)
                order = rest[np.lexsort((h[rest], row[rest]))]
                new = np.ones(len(order), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
                first = order[new]
                times = np.diff(np.append(np.flatnonzero(new), len(order)))
                items = pa.StructArray.from_arrays(
                    [pa.array(_strings(low, start[first], end[first]), pa.string()), pa.array(times.astype(np.int64))],
                    ["word", "n"])
                cut = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("held_out"), pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                     pa.array(total(logs) if len(keys) else np.zeros(n)),
                     pa.array((total((c > 0).astype(float)) if len(keys) else np.zeros(n)).astype(np.int64)),
                     pa.array(total(lp) if len(keys) else np.zeros(n)), pa.ListArray.from_arrays(pa.array(cut), items)],
                    ["id", "held_out", "n_words", "logs", "known", "lp", "rest"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", "held_out").mapInArrow(
        run, f"id {kind}, held_out boolean, n_words long, logs double, known long, lp double, "
             "rest array<struct<word: string, n: bigint>>")


def score_documents(docs: DataFrame, held_out: Column, rules: LatticeRules, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score (of
    the word model), score (log10 of the marginal probability). Documents where
    ``held_out`` is not true are trained on."""
    ship_by_value(__name__, "curatio.llm.textnum", "curatio.llm.lattice")
    scratch = Scratch(docs.sparkSession, "lattice")
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"),
                      F.coalesce(held_out, F.lit(False)).alias("held_out"))
    n_docs = src.filter("NOT held_out").count()
    words = scratch.put(word_table(src.withColumn("train", ~F.col("held_out"))), "words")
    seen = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n, v = seen["n"] + n_docs, seen["v"] + (n_docs > 0)
    model = fit(words, n_docs, rules)
    words = scratch.put(with_marginals(words, model, rules), "marginals")
    rows = scratch.put(_scored(src, words, rules).withColumn("key", F.monotonically_increasing_id()), "scored")
    rest = (rows.select("key", F.explode("rest").alias("r")).select("key", "r.word", F.col("r.n").alias("k"))
            .join(words.select("word", "c", "lp"), "word").groupBy("key")
            .agg(F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("logs2"),
                 F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known2"),
                 F.sum(F.col("k") * F.col("lp")).alias("lp2")))
    zero = F.lit(0).cast("long")
    tokens = F.col("n_words") + 1
    rest_of = lambda c, z: F.coalesce(F.col(c), z)
    out = rows.drop("rest").join(rest, "key", "left").select(
        F.col("id").alias(id_col), "held_out", tokens.alias("n_tokens"),
        (F.col("known") + rest_of("known2", zero) + int(n_docs > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + rest_of("logs2", F.lit(0.0)) + float(np.log10(n_docs + 1.0))
         - tokens * float(np.log10(n + v + 1.0))).alias("base_score"),
        (F.col("lp") + rest_of("lp2", F.lit(0.0)) + float(model.end / np.log(10))).alias("score"))
    return out
