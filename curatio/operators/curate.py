"""Gates, de-duplication, quality filter, per-category cap, running ids,
conversation records and conversion statistics (X7, P3, P4, A5, J6, N1,
N2, G4, J7, A6, A7)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio import defaults as D
from curatio.functions.text import ustrip
from curatio.operators.util import checked_broadcast, measured_broadcast
from curatio.session import cut_lineage


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- predicates

def extraction_gate(question, answer, min_question: int = D.EXTRACT_MIN_QUESTION,
                    min_answer: int = D.EXTRACT_MIN_ANSWER) -> Column:
    """Raw lengths (no strip) at extraction: q >= 2, a >= 11 by default."""
    q, a = _c(question), _c(answer)
    return (F.length(q) >= min_question) & (F.length(a) >= min_answer)


def reject_mask(text, terms: Sequence[str]) -> Column:
    """True when the text contains any reject term (case-sensitive)."""
    t = _c(text)
    hit = F.lit(False)
    for term in terms:
        hit = hit | t.contains(term)
    return F.coalesce(hit, F.lit(False))


def quality_mask(question, answer, min_question: int = D.QUALITY_MIN_QUESTION,
                 min_answer: int = D.QUALITY_MIN_ANSWER,
                 reject_terms: Sequence[str] = D.REJECT_TERMS) -> Column:
    """P3 + P4: stripped lengths (Unicode whitespace) and no reject term in
    the answer. Null question or answer is invalid."""
    q, a = _c(question), _c(answer)
    ok = (F.length(ustrip(q)) >= min_question) & (F.length(ustrip(a)) >= min_answer)
    return F.coalesce(ok & ~reject_mask(a, reject_terms), F.lit(False))


# ------------------------------------------------------------------- dedup

def dedup_first_seen(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence) -> DataFrame:
    """Keep the first row per key in ``order_cols`` order.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before
    the exchange, so a hot key is cut to one row per map partition before
    it is shuffled. Null keys are one group (as a seen-set treats None).

    A 64-bit hash of the key leads the partition spec: the groups are the
    same (the hash is a function of the key), but the sorts compare the
    hash first, so long keys with shared prefixes (near-copy texts) are
    compared in full only on equal hashes."""
    w = Window.partitionBy(F.xxhash64(*key_cols), *key_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def drop_seen(df: DataFrame, seen: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Rows whose key was not seen in an earlier run (left anti join;
    null keys compare equal, as a seen-set holds None)."""
    s = seen.select(*[F.col(k).alias(f"_seen_{k}") for k in key_cols])
    cond = None
    for k in key_cols:
        c = df[k].eqNullSafe(s[f"_seen_{k}"])
        cond = c if cond is None else cond & c
    return df.join(s, cond, "left_anti")


# --------------------------------------------------------------------- cap

def sample_hash(key, seed: int = D.CAP_SEED) -> Column:
    """Deterministic per-row draw: md5(seed | key) as lower-case hex; a null
    key draws like an empty one."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(_c(key).cast("string"), F.lit(""))))


def cap_per_group(df: DataFrame, group_col: str, key_col: str,
                  cap: int | None = D.CAP_PER_CATEGORY, seed: int = D.CAP_SEED,
                  bucket_chars: int = 5) -> DataFrame:
    """Keep exactly ``min(n, cap)`` rows per group - the rows with the
    smallest ``md5(seed|key)`` - and every row when ``cap`` is falsy.

    Skew-proof and exact without a per-group window over all rows:
      1. count rows per (group, hash-prefix bucket) - map-side combined,
         at most groups x 16**bucket_chars rows;
      2. a running sum over the buckets of each group finds the bucket
         where the cap is crossed and how many rows it still needs;
      3. rows below that bucket are kept as they are; only rows *in* it
         (about n / 16**bucket_chars per group) are ranked by a window."""
    if not cap:
        return df
    h = sample_hash(key_col, seed)
    x = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, bucket_chars))
    counts = x.groupBy(group_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(group_col).orderBy("_b")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = counts.withColumn("_cum", F.sum("_n").over(w))
    cut = cum.filter((F.col("_cum") > cap) & (F.col("_cum") - F.col("_n") <= cap)).select(
        F.col(group_col).alias("_g"), F.col("_b").alias("_cut_b"),
        (F.lit(cap) - (F.col("_cum") - F.col("_n"))).alias("_need"))
    cut = measured_broadcast(cut)       # at most one row a group
    j = x.join(cut, x[group_col].eqNullSafe(cut["_g"]), "left")
    below = j.filter(F.col("_cut_b").isNull() | (F.col("_b") < F.col("_cut_b")))
    edge = j.filter(F.col("_b") == F.col("_cut_b"))
    we = Window.partitionBy(group_col).orderBy("_h", key_col)
    edge = edge.withColumn("_r", F.row_number().over(we)).filter(
        F.col("_r") <= F.col("_need")).drop("_r")
    cols = df.columns
    return below.select(*cols).unionByName(edge.select(*cols))


# -------------------------------------------------------------- running ids

def running_index(df: DataFrame, order_cols: Sequence, out_col: str = "n") -> DataFrame:
    """Dense 0-based index over the whole table in ``order_cols`` order.

    A range-partitioned sort (balanced by sampling, so one hot group is
    spread over many tasks) is checkpointed to the shared checkpoint folder
    with its in-partition position; per-partition counts (one row per
    partition) give each partition's offset. No single-partition window
    over the rows."""
    s = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    s = cut_lineage(s)
    s = s.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_loc", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offs = measured_broadcast(offs.select("_pid", "_off"))
    out = s.join(offs, "_pid").withColumn(out_col, F.col("_off") + F.col("_loc"))
    return out.drop("_mid", "_pid", "_loc", "_off")


def first_appearance_rank(df: DataFrame, group_col: str, order_cols: Sequence[str],
                          out_col: str = "group_rank") -> DataFrame:
    """A3 category order: rank of each group by its first row in input
    order (one small aggregate row per group, joined back - broadcast behind
    a count of it). ``df`` is read twice: pass a materialized
    table when it is expensive to recompute."""
    first = df.groupBy(group_col).agg(F.min(F.struct(*order_cols)).alias("_first"))
    ranked = first.withColumn(out_col, F.row_number().over(Window.orderBy("_first")) - 1)
    ranked = measured_broadcast(ranked.select(F.col(group_col).alias("_g"), out_col))
    return df.join(ranked, F.col(group_col).eqNullSafe(F.col("_g"))).drop("_g")


def running_ids(df: DataFrame, group_col: str, order_cols: Sequence[str],
                id_col: str = "id") -> DataFrame:
    """``"{group}_{n}"`` where ``n`` counts from 0 across all groups in
    output order: groups by first appearance, rows in input order.

    Only the group and the order columns are sorted and written; the rows
    take their numbers by a join on them, which moves no row as long as the
    numbers are few enough to broadcast (a cap per category bounds them), and
    shuffles the rows once beyond that. Rows that repeat a key are told apart by
    a hash of all their columns; nothing but these meets in a window. ``df`` is
    read twice: pass a written table when it is expensive to recompute."""
    keys = [group_col, *(c for c in order_cols if c != group_col)]
    narrow = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")))
    ranked = first_appearance_rank(narrow, group_col, order_cols, "group_rank")
    each = ranked.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    idx = running_index(each, ["group_rank", *order_cols, "_copy"], "n")
    names = [f"_key{i}" for i in range(len(keys))]

    def on_keys(left, right):
        cond = F.lit(True)
        for k, name in zip(keys, names):
            cond = cond & left[k].eqNullSafe(right[name])
        return cond

    def renamed(table, *more):
        return table.select(*[F.col(k).alias(name) for k, name in zip(keys, names)], *more)

    repeated = measured_broadcast(renamed(narrow.filter("_copies > 1"), F.lit(True).alias("_again")))
    rows = df.withColumn("_copy", F.lit(0).cast("long"))
    if not repeated.isEmpty():
        told = df.join(repeated, on_keys(df, repeated), "left").drop(*names)
        content = [c for c, t in df.dtypes if "map<" not in t and t != "variant"]
        window = Window.partitionBy(*keys).orderBy(F.xxhash64(*content))
        again = told.filter("_again").withColumn("_copy", F.row_number().over(window).cast("long") - 1)
        once = told.filter("_again IS NULL").withColumn("_copy", F.lit(0).cast("long"))
        rows = once.unionByName(again).drop("_again")
    numbers = measured_broadcast(renamed(idx, F.col("_copy").alias("_nth"), "group_rank", "n"))
    out = rows.join(numbers, on_keys(rows, numbers) & (rows["_copy"] == numbers["_nth"])).drop(*names, "_nth", "_copy")
    return out.withColumn(id_col, F.concat(F.col(group_col), F.lit("_"), F.col("n").cast("string")))


# -------------------------------------------------------- records and stats

def conversation_records(df: DataFrame, id_col: str = "id", question_col: str = "question",
                         answer_col: str = "answer", roles=D.CONVERSATION_ROLES,
                         prompts: DataFrame | None = None, group_col: str | None = None) -> DataFrame:
    """G4 (+ optional J7): ``id, conversations ARRAY<STRUCT<from, value>>``.

    With ``prompts`` (group, prompt) a system turn is prepended for groups
    that have one (broadcast left join; off by default as in the original)."""
    user, assistant = roles
    turns = [F.struct(F.lit(user).alias("from"), F.col(question_col).alias("value")),
             F.struct(F.lit(assistant).alias("from"), F.col(answer_col).alias("value"))]
    if prompts is not None and group_col is not None:
        p = checked_broadcast(prompts.select(F.col(prompts.columns[0]).alias("_pg"),
                                             F.col(prompts.columns[1]).alias("_prompt")),
                              what="prompts", required=False)
        df = df.join(p, df[group_col] == p["_pg"], "left")
        sys_turn = F.struct(F.lit("system").alias("from"), F.col("_prompt").alias("value"))
        conv = F.when(F.col("_prompt").isNotNull(), F.array(sys_turn, *turns)).otherwise(F.array(*turns))
        return df.select(id_col, conv.alias("conversations"))
    return df.select(id_col, F.array(*turns).alias("conversations"))


def conversion_stats(df: DataFrame, group_col: str, valid_col: str,
                     cap: int | None = D.CAP_PER_CATEGORY) -> DataFrame:
    """A6 + A7: per group original / filtered / final counts plus a grand
    total row (``is_total``), in ONE pass over the rows: a rollup (group
    rows and the total from the same partial aggregates). The total's
    ``final`` is the sum of the per-group capped counts - a window over the
    tiny rollup output (one row per group), never over rows. A one-row
    anchor left-joined to that output keeps a zero total row for an empty
    corpus."""
    r = df.rollup(group_col).agg(F.count(F.lit(1)).alias("original"),
                                 F.count_if(F.col(valid_col)).alias("filtered"),
                                 F.grouping_id().alias("_gid"))
    anchor = df.sparkSession.range(1).select(F.lit(1).alias("_k"))
    r = anchor.join(r.withColumn("_k", F.lit(1)), "_k", "left")
    is_group = F.coalesce(F.col("_gid") == 0, F.lit(False))
    capped = F.least(F.col("filtered"), F.lit(cap)) if cap else F.col("filtered")
    r = r.withColumn("_fg", F.when(is_group, capped))
    total_final = F.sum("_fg").over(Window.partitionBy(F.lit(1)))
    return r.select(group_col, (~is_group).alias("is_total"),
                    F.coalesce(F.col("original"), F.lit(0)).cast("long").alias("original"),
                    F.coalesce(F.col("filtered"), F.lit(0)).cast("long").alias("filtered"),
                    F.when(is_group, F.col("_fg"))
                    .otherwise(F.coalesce(total_final, F.lit(0))).cast("long").alias("final"))
