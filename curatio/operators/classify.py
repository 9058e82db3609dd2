"""Blend, exclusion rules and labelling.

Scoring a text needs only that text and the (small) lexicon, so the whole
classification is one narrow projection per row - no exchange at all:

    QA rows -> composite text -> clean                      (codegen)
      x lexicon row, x prototype row (broadcast, one row)   (narrow)
      per category: hits, related boost, similarity, blend  (higher-order fns)
      winner, exclusions, arg-max, fallback                 (same stage)

The lexicon row is ``array<struct<dept_ord, dept, kws: array<struct<kw_ord,
kw, weight>>>>`` in category order (a literal from the size-checked
parameter table), so sums run in lexicon order as in the original and the
related-keyword boost is a repeated multiplication; the prototype row is a
``map<dept, (proto, norm)>`` bounded by the categories. A hot category or
key cannot skew anything: no row moves. Categories are ranked on the raw
scores; keywords are summed in lexicon order, so a score does not depend on
the layout of the rows.

:func:`apply_exclusions` and :func:`pick_labels` do the same on a long
``(keys, dept, score)`` table (one window and one aggregate, both keyed by
the text keys) for scores computed elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio import defaults as D
from curatio.functions.text import clean_text, composite_text
from curatio.functions.vectors import norm
from curatio.operators.lexicon import Lexicon, _bcast_categories, _bcast_keywords
from curatio.operators.util import checked_broadcast


@dataclass
class ClassifyParams:
    similarity_weight: float = D.SIMILARITY_WEIGHT
    keyword_weight: float = D.KEYWORD_WEIGHT
    fallback: str = D.FALLBACK_CATEGORY
    exclusions: Sequence[tuple[str, str]] = field(default_factory=lambda: list(D.EXCLUSION_RULES))
    exclusion_factor: float = D.EXCLUSION_FACTOR
    answer_prefix: int | None = D.ANSWER_PREFIX_CHARS     # None: the whole answer
    context_radius: int = D.CONTEXT_RADIUS
    early_factor: float = D.EARLY_FACTOR
    related_factor: float = D.RELATED_FACTOR
    question_mark: str = D.QUESTION_MARK


def classification_text(qa: DataFrame, question_col: str = "question",
                        answer_col: str = "answer", out_col: str = "ctext",
                        answer_prefix: int | None = D.ANSWER_PREFIX_CHARS) -> DataFrame:
    """P2 + C0-C6: cleaned composite text used for scoring (the output rows
    keep the original question and answer)."""
    return qa.withColumn(out_col, clean_text(
        composite_text(question_col, answer_col, answer_prefix)))


KW_TYPE = "array<struct<kw_ord:int,kw:string,weight:double>>"
LEX_TYPE = T.StructType([T.StructField("__cl_lex", T.ArrayType(T.StructType([
    T.StructField("dept_ord", T.IntegerType()), T.StructField("dept", T.StringType()),
    T.StructField("kws", T.ArrayType(T.StructType([
        T.StructField("kw_ord", T.IntegerType()), T.StructField("kw", T.StringType()),
        T.StructField("weight", T.DoubleType())])))])))])
PMAP_TYPE = "map<string,struct<proto:array<float>,proto_norm:double>>"


def lexicon_row(lex: Lexicon) -> DataFrame:
    """The whole lexicon as ONE row, column ``__cl_lex``: categories in order,
    each with its keywords in order. The lexicon is a parameter table of
    checked size (at most MAX_BROADCAST_ROWS keywords), so it is read once
    on the driver and becomes a one-row literal table: no Spark stage. It is
    built once per Lexicon and reused by every query that scores with it."""
    if lex.row is not None:
        return lex.row
    _bcast_keywords(lex)  # size check (counted when unknown)
    kws = lex.keywords.select("dept", "kw_ord", "keyword", "weight").collect()
    cats = sorted((r.dept_ord, r.dept) for r in lex.categories.select("dept", "dept_ord").collect())
    by_dept: dict = {}
    for r in kws:
        by_dept.setdefault(r.dept, []).append((r.kw_ord, r.keyword, float(r.weight)))
    arr = [(o, d, sorted(by_dept.get(d, []))) for o, d in cats]
    lex.row = lex.keywords.sparkSession.createDataFrame([(arr,)], LEX_TYPE)
    return lex.row


def prototype_row(prototypes: DataFrame | None, spark, lex: Lexicon | None = None) -> DataFrame:
    """Prototypes as ONE row, column ``__cl_pmap``: dept -> (proto, norm), the
    norm computed once per prototype (one small aggregate). With ``lex``
    only the lexicon's categories are kept (a left semi join), so the row
    is bounded by the size-checked category table; a category must have at
    most one prototype (a duplicate key fails the map)."""
    if prototypes is None:
        return spark.range(1).select(F.lit(None).cast(PMAP_TYPE).alias("__cl_pmap"))
    if lex is not None:
        _bcast_categories(lex)  # size check
        prototypes = prototypes.join(lex.categories.select("dept"), "dept", "left_semi")
    p = prototypes.select("dept", F.struct(F.col("proto").cast("array<float>").alias("proto"),
                                           norm("proto").alias("proto_norm")).alias("v"))
    return p.agg(F.map_from_entries(F.collect_list(F.struct("dept", "v"))).alias("__cl_pmap"))


def _num(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _str(x: str) -> str:
    return "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"


def question_end(t: Column, question_mark: str = D.QUESTION_MARK) -> Column:
    """K3: position of the question mark, else half the length."""
    qm = F.position(F.lit(question_mark), t) - 1
    return F.when(qm >= 0, qm).otherwise(F.floor(F.length(t) / 2).cast("int"))


def row_scores_sql(t: str, vec: str, p: ClassifyParams) -> str:
    """V1 + K2-K5 + V5 for one text, as one SQL expression over the columns
    ``t`` (clean text), ``vec`` (embedding), ``__cl_vn`` (its norm), ``__cl_tlen``,
    ``__cl_qend``, ``__cl_lex`` and ``__cl_pmap``. Result: one struct per category
    ``(dept, dept_ord, similarity, kw_score)``, keywords summed in lexicon
    order; the related-keyword boost is a repeated multiplication."""
    r, eps = int(p.context_radius), _num(D.COSINE_EPS)
    start = f"greatest(h.pos - {r}, 0)"
    ctx = f"substr({t}, {start} + 1, least(__cl_tlen, h.pos + length(h.kw) + {r}) - {start})"
    base = (f"CAST((__cl_tlen - length(replace({t}, h.kw, ''))) / length(h.kw) AS BIGINT) * h.w"
            f" * (CASE WHEN h.pos < __cl_qend THEN {_num(p.early_factor)} ELSE {_num(1.0)} END)")
    hit = (f"aggregate(filter(c.kws, q -> q.kw != h.kw AND contains({ctx}, q.kw)), {base},"
           f" (b, q) -> b * {_num(p.related_factor)})")
    hits = (f"transform(filter(c.kws, k -> contains({t}, k.kw)),"
            f" k -> named_struct('kw', k.kw, 'w', k.weight, 'pos', position(k.kw, {t}) - 1))")
    kw_score = f"aggregate({hits}, {_num(0.0)}, (acc, h) -> acc + {hit})"
    pr = "try_element_at(__cl_pmap, c.dept)"
    dot = (f"aggregate(zip_with({vec}, {pr}.proto, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE)),"
           f" {_num(0.0)}, (a, v) -> a + v)")
    sim = (f"coalesce({dot} / (greatest(__cl_vn, {eps}) * greatest({pr}.proto_norm, {eps})),"
           f" {_num(0.0)})")
    return (f"transform(__cl_lex, c -> named_struct('dept', c.dept, 'dept_ord', c.dept_ord,"
            f" 'similarity', {sim}, 'kw_score', {kw_score}))")


def blend_sql(p: ClassifyParams) -> str:
    return (f"transform(__cl_s0, s -> named_struct('dept', s.dept, 'dept_ord', s.dept_ord,"
            f" 'similarity', s.similarity, 'kw_score', s.kw_score, 'score',"
            f" {_num(p.similarity_weight)} * s.similarity + {_num(p.keyword_weight)} * s.kw_score))")


def argmax_sql(arr: str, field: str) -> str:
    """First category with the highest ``field`` (ties -> lowest dept_ord):
    struct(r, o, dept)."""
    return (f"array_max(transform({arr}, s -> named_struct('r', s.{field},"
            f" 'o', -s.dept_ord, 'dept', s.dept)))")


def adjust_sql(p: ClassifyParams) -> str:
    """V6: the winner ``__cl_w`` halves the scores of the categories it excludes."""
    rules = sorted(set((str(a), str(b)) for a, b in p.exclusions))
    if rules:
        arr = "array(" + ", ".join(f"named_struct('w', {_str(a)}, 'e', {_str(b)})"
                                   for a, b in rules) + ")"
        ex = f"array_contains({arr}, named_struct('w', __cl_w, 'e', s.dept))"
    else:
        ex = "false"
    return (f"transform(transform(__cl_s, s -> named_struct('s', s, 'ex', {ex})),"
            f" z -> named_struct('dept', z.s.dept, 'dept_ord', z.s.dept_ord,"
            f" 'similarity', z.s.similarity, 'kw_score', z.s.kw_score, 'raw_score', z.s.score,"
            f" 'excluded', z.ex, 'score', CASE WHEN z.ex THEN z.s.score * {_num(p.exclusion_factor)}"
            f" ELSE z.s.score END))")


def _scored(rows: DataFrame, text_col: str, lex: Lexicon, vec_col: str | None,
            prototypes: DataFrame | None, p: ClassifyParams) -> DataFrame:
    """Adds ``__cl_adj`` (adjusted score array), ``label``, ``best_score``.
    Each stage is its own projection column, so every per-row array is
    computed once (Catalyst does not inline an expensive column that is
    used more than once). The per-row chain is written as SQL expressions:
    the same plan, parsed once in the JVM."""
    lexrow = checked_broadcast(lexicon_row(lex), known_rows=1, what="lexicon row")
    prow = checked_broadcast(prototype_row(prototypes, rows.sparkSession, lex), known_rows=1,
                             what="prototype row")
    vec = F.col(vec_col) if vec_col else F.lit(None).cast("array<float>")
    t = F.col(text_col)
    j = (rows.crossJoin(lexrow).crossJoin(prow)
         .withColumns({"__cl_v": vec, "__cl_tlen": F.length(t), "__cl_qend": question_end(t, p.question_mark)})
         .withColumn("__cl_vn", norm("__cl_v")))
    j = j.withColumn("__cl_s0", F.expr(row_scores_sql(f"`{text_col}`", "__cl_v", p)))
    j = j.withColumn("__cl_s", F.expr(blend_sql(p)))
    j = j.withColumn("__cl_w", F.expr(argmax_sql("__cl_s", "score") + ".dept"))
    j = j.withColumn("__cl_adj", F.expr(adjust_sql(p)))
    j = j.withColumn("__cl_best", F.expr(argmax_sql("__cl_adj", "score")))
    j = j.withColumns({"label": F.when(F.col("__cl_best.r") > 0, F.col("__cl_best.dept"))
                       .otherwise(F.lit(p.fallback)), "best_score": F.col("__cl_best.r")})
    return j.drop("__cl_s0", "__cl_s", "__cl_lex", "__cl_pmap", "__cl_v", "__cl_vn",
                  "__cl_tlen", "__cl_qend", "__cl_w", "__cl_best")


def category_scores(texts: DataFrame, keys: Sequence[str], text_col: str, lex: Lexicon,
                    vec_col: str | None = None, prototypes: DataFrame | None = None,
                    params: ClassifyParams | None = None) -> DataFrame:
    """V5 + V6 in long form: keys, dept, dept_ord, similarity, kw_score,
    raw_score, excluded, score (adjusted) - one row per (text, category),
    generated narrowly from each text's score array."""
    p = params or ClassifyParams()
    s = _scored(texts.select(*keys, text_col, *([vec_col] if vec_col else [])),
                text_col, lex, vec_col, prototypes, p)
    # inline_outer: a non-outer explode makes the optimizer infer a
    # size(__cl_adj) > 0 filter and push it below, recomputing the whole score
    # chain inside the join condition; the arrays are never empty anyway
    return s.select(*keys, F.inline_outer("__cl_adj"))


def _rule_table(spark, rules: Sequence[tuple[str, str]]) -> DataFrame:
    rules = sorted(set((str(a), str(b)) for a, b in rules))
    df = spark.createDataFrame(rules, "x_winner string, x_excluded string")
    return checked_broadcast(df, known_rows=len(rules), what="exclusion rules")


def apply_exclusions(scores: DataFrame, keys: Sequence[str],
                     params: ClassifyParams | None = None) -> DataFrame:
    """V6 + J4: the arg-max category (ties -> lowest ``dept_ord``) halves
    the scores of the categories it excludes. Adds ``winner``,
    ``excluded`` and ``adj_score``."""
    p = params or ClassifyParams()
    w = Window.partitionBy(*keys)
    s = scores.withColumn("winner", F.max_by("dept", F.struct("score", -F.col("dept_ord"))).over(w))
    if not p.exclusions:
        return s.withColumn("excluded", F.lit(False)).withColumn("adj_score", F.col("score"))
    rules = _rule_table(scores.sparkSession, p.exclusions)
    j = s.join(rules, (F.col("winner") == F.col("x_winner"))
               & (F.col("dept") == F.col("x_excluded")), "left")
    return (j.withColumn("excluded", F.col("x_winner").isNotNull())
            .drop("x_winner", "x_excluded")
            .withColumn("adj_score", F.when(F.col("excluded"), F.col("score") * p.exclusion_factor)
                        .otherwise(F.col("score"))))


def pick_labels(adjusted: DataFrame, keys: Sequence[str],
                params: ClassifyParams | None = None) -> DataFrame:
    """A2 + P5: arg-max of the adjusted scores (ties to the first category
    in lexicon order); the fallback category when the best is not > 0."""
    p = params or ClassifyParams()
    agg = adjusted.groupBy(*keys).agg(
        F.max_by("dept", F.struct("adj_score", -F.col("dept_ord"))).alias("top"),
        F.max("adj_score").alias("best_score"))
    return agg.select(*keys, F.when(F.col("best_score") > 0, F.col("top"))
                      .otherwise(F.lit(p.fallback)).alias("label"), "best_score")


def classify(qa: DataFrame, keys: Sequence[str], lex: Lexicon,
             vec_col: str | None = None, prototypes: DataFrame | None = None,
             params: ClassifyParams | None = None, question_col: str = "question",
             answer_col: str = "answer", with_scores: bool = False) -> DataFrame:
    """V8: label every QA row. Returns the input rows plus ``label`` and
    ``best_score`` (plus ``scores``, the adjusted per-category array, when
    ``with_scores``). Narrow: the rows are never shuffled."""
    p = params or ClassifyParams()
    out_cols = ("label", "best_score", "scores")
    qa = qa.drop(*[c for c in out_cols if c in qa.columns])  # re-labelling replaces
    cols = qa.columns
    rows = classification_text(qa, question_col, answer_col, "__cl_ctext", p.answer_prefix)
    out = _scored(rows, "__cl_ctext", lex, vec_col, prototypes, p)
    extra = [F.col("__cl_adj").alias("scores")] if with_scores else []
    return out.select(*cols, "label", "best_score", *extra)
