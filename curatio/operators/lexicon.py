"""Category lexicon and weighted keyword scoring.

A lexicon is a small dimension table ``dept, dept_ord, kw_ord, keyword,
weight``; texts are streamed against it with broadcast joins, so the text
side is never shuffled by the scoring itself.

Score of a keyword ``k`` of category ``d`` in text ``t`` (when ``k in t``)::

    count(t, k) * weight(k)
        * early_factor   if first_pos(k) < question_end(t)
        * related_factor ** #{other keywords of d inside the context window
                             [pos - r, pos + len(k) + r) of the first hit}

and the category score is the sum over its keywords (0 when none hits).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio import defaults as D
from curatio.functions.text import count_occurrences, slice0
from curatio.operators.sweep import sweep_hits
from curatio.operators.util import checked_broadcast

#: Keywords from which on texts are read once by an automaton (``method="auto"``)
#: instead of once a keyword; results are the same.
SWEEP_FROM = 1_000


@dataclass
class Lexicon:
    """``keywords``: dept, dept_ord, kw_ord, keyword, weight.
    ``categories``: dept, dept_ord - every category, also those without
    keywords (they still compete through similarity and get score 0)."""
    keywords: DataFrame
    categories: DataFrame
    n_keywords: int | None = None
    n_categories: int | None = None
    row: DataFrame | None = None  # one-row form, built once (see classify.lexicon_row)


LEXICON_SCHEMA = T.StructType([
    T.StructField("dept", T.StringType(), False),
    T.StructField("dept_ord", T.IntegerType(), False),
    T.StructField("kw_ord", T.IntegerType(), True),
    T.StructField("keyword", T.StringType(), True),
])


def keyword_weight(keyword: Column, markers: Sequence[str] = D.WEIGHT_MARKERS,
                   long_min_len: int = D.WEIGHT_LONG_MIN_LEN,
                   long_factor: float = D.WEIGHT_LONG_FACTOR,
                   marker_factor: float = D.WEIGHT_MARKER_FACTOR,
                   base: float = D.WEIGHT_BASE) -> Column:
    """K1: base, x long_factor when longer than ``long_min_len``, x
    marker_factor when it contains any marker."""
    w = F.lit(base).cast("double")
    w = w * F.when(F.length(keyword) > long_min_len, F.lit(long_factor)).otherwise(F.lit(1.0))
    if markers:
        has = F.lit(False)
        for m in markers:
            has = has | keyword.contains(m)
        w = w * F.when(has, F.lit(marker_factor)).otherwise(F.lit(1.0))
    return w


def _finish(spark: SparkSession, rows: DataFrame, n_kw: int | None, n_cat: int | None,
            normalize_keywords: bool, cats: DataFrame | None = None, **weight_kw) -> Lexicon:
    kw = rows.filter(F.col("keyword").isNotNull() & (F.length("keyword") > 0))
    if normalize_keywords:
        kw = kw.withColumn("keyword", F.lower("keyword"))
    kw = kw.withColumn("weight", keyword_weight(F.col("keyword"), **weight_kw))
    if cats is None:
        cats = rows.groupBy("dept").agg(F.min("dept_ord").alias("dept_ord"))
    return Lexicon(kw, cats, n_kw, n_cat)


def lexicon_from_dict(spark: SparkSession, mapping: dict[str, Sequence[str]],
                      normalize_keywords: bool = False, **weight_kw) -> Lexicon:
    """Lexicon from an ordered ``{category: [keyword, ...]}`` parameter.

    Keywords are matched as given (the original does not lower-case them
    while it lower-cases the text); ``normalize_keywords=True`` lower-cases."""
    rows = []
    for d_ord, (dept, kws) in enumerate(mapping.items()):
        if not kws:
            rows.append((dept, d_ord, None, None))
        for k_ord, kw in enumerate(kws):
            rows.append((dept, d_ord, k_ord, kw))
    df = spark.createDataFrame(rows, LEXICON_SCHEMA)
    n_kw = sum(len(v) for v in mapping.values())
    cats = spark.createDataFrame([(d, i) for i, d in enumerate(mapping)],
                                 "dept string, dept_ord int")
    return _finish(spark, df, n_kw, len(mapping), normalize_keywords, cats, **weight_kw)


def read_lexicon(spark: SparkSession, path: str, normalize_keywords: bool = False,
                 **weight_kw) -> Lexicon:
    """Lexicon from a JSON object file ``{"category": ["kw", ...], ...}``;
    key order is the category order."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string,array<string>>")
    ent = raw.select(F.posexplode(F.map_entries(m)).alias("dept_ord", "e"))
    rows = ent.select(F.col("e.key").alias("dept"), F.col("dept_ord").cast("int"),
                      F.posexplode_outer("e.value").alias("kw_ord", "keyword"))
    rows = rows.select("dept", "dept_ord", F.col("kw_ord").cast("int"), "keyword")
    return _finish(spark, rows, None, None, normalize_keywords, **weight_kw)


def _bcast_keywords(lex: Lexicon) -> DataFrame:
    return checked_broadcast(lex.keywords, known_rows=lex.n_keywords, what="lexicon")


def _bcast_categories(lex: Lexicon) -> DataFrame:
    return checked_broadcast(lex.categories, known_rows=lex.n_categories, what="categories")


def _by_sweep(lex: Lexicon, method: str) -> bool:
    if method not in ("auto", "join", "sweep"):
        raise ValueError("method is auto, join or sweep")
    if method != "auto":
        return method == "sweep"
    n = lex.n_keywords if lex.n_keywords is not None else lex.keywords.limit(SWEEP_FROM + 1).count()
    return n > SWEEP_FROM


def hit_columns(text: Column, keyword: Column, weight: Column,
                context_radius: int = D.CONTEXT_RADIUS,
                early_factor: float = D.EARLY_FACTOR,
                question_mark: str = D.QUESTION_MARK,
                cnt: Column | None = None, pos: Column | None = None) -> dict[str, Column]:
    """Per (text, keyword) hit: count, first position, question end, early
    flag, context window and the score before the related-keyword boost.
    ``cnt`` and ``pos`` are taken as given if a pass has found them."""
    cnt = count_occurrences(text, keyword) if cnt is None else cnt
    pos = F.position(keyword, text) - 1 if pos is None else pos
    qm = F.position(F.lit(question_mark), text) - 1
    qend = F.when(qm >= 0, qm).otherwise(F.floor(F.length(text) / 2).cast("int"))
    early = pos < qend
    start = F.greatest(pos - context_radius, F.lit(0))
    end = F.least(F.length(text), pos + F.length(keyword) + context_radius)
    base0 = (cnt * weight * F.when(early, F.lit(early_factor)).otherwise(F.lit(1.0)))
    return {"cnt": cnt, "pos": pos, "qend": qend, "early": early,
            "context": slice0(text, start, end), "base0": base0}


def keyword_hits(texts: DataFrame, keys: Sequence[str], text_col: str, lex: Lexicon,
                 method: str = "auto", **hit_kw) -> DataFrame:
    """J1 + K2/K3: one row per (text, keyword) where the keyword occurs.

    ``join``: broadcast nested-loop join of the streamed texts against the lexicon
    with a ``contains`` condition; ``sweep``: one pass of an automaton over each
    text, for lexicons of any size; ``auto`` takes the join up to ``SWEEP_FROM``
    keywords. A keyword in two categories gives two rows."""
    if _by_sweep(lex, method):
        return _swept(texts, keys, text_col, lex, **hit_kw).drop("n_related")
    t = texts.select(*keys, F.col(text_col).alias("_t"))
    lx = _bcast_keywords(lex)
    j = t.join(lx, F.col("_t").contains(F.col("keyword")), "inner")
    cols = hit_columns(F.col("_t"), F.col("keyword"), F.col("weight"), **hit_kw)
    return j.select(*keys, "dept", "dept_ord", "kw_ord", "keyword", "weight",
                    *[c.alias(n) for n, c in cols.items()])


def _swept(texts: DataFrame, keys: Sequence[str], text_col: str, lex: Lexicon, **hit_kw) -> DataFrame:
    """The columns of :func:`keyword_hits` and ``n_related``."""
    h = sweep_hits(texts, keys, text_col, lex.keywords, hit_kw.get("context_radius", D.CONTEXT_RADIUS))
    cols = hit_columns(F.col("_t"), F.col("keyword"), F.col("weight"), **hit_kw, cnt=F.col("cnt"), pos=F.col("pos"))
    return h.select(*keys, "dept", "dept_ord", "kw_ord", "keyword", "weight",
                    *[c.alias(n) for n, c in cols.items()], "n_related")


def related_hits(texts: DataFrame, keys: Sequence[str], text_col: str, lex: Lexicon,
                 related_factor: float = D.RELATED_FACTOR, method: str = "auto", **hit_kw) -> DataFrame:
    """J1 + J2: hits with their related keywords counted and boosted, by
    :func:`with_related`, or in the pass that finds the hits (``sweep``)."""
    if not _by_sweep(lex, method):
        return with_related(keyword_hits(texts, keys, text_col, lex, "join", **hit_kw), keys, lex, related_factor)
    return _swept(texts, keys, text_col, lex, **hit_kw).withColumn(
        "base", F.col("base0") * F.pow(F.lit(related_factor), F.col("n_related")))


def with_related(hits: DataFrame, keys: Sequence[str], lex: Lexicon,
                 related_factor: float = D.RELATED_FACTOR) -> DataFrame:
    """J2 + K4: count the other keywords of the same category inside each
    hit's context window (broadcast hash join on the category, containment
    as residual), then apply ``related_factor ** n``.

    The count aggregates over keys that include the text keys, so it reuses
    the text partitioning and adds no exchange."""
    r = _bcast_keywords(lex).select(F.col("dept").alias("r_dept"),
                                    F.col("keyword").alias("r_kw"))
    j = hits.join(r, (F.col("dept") == F.col("r_dept"))
                  & (F.col("r_kw") != F.col("keyword"))
                  & F.col("context").contains(F.col("r_kw")), "left")
    group = [*keys, "dept", "dept_ord", "kw_ord"]
    carry = [c for c in hits.columns if c not in group]
    agg = j.groupBy(*group).agg(*[F.any_value(c).alias(c) for c in carry],
                                F.count("r_kw").alias("n_related"))
    return agg.withColumn(
        "base", F.col("base0") * F.pow(F.lit(related_factor), F.col("n_related")))


def keyword_scores(texts: DataFrame, keys: Sequence[str], text_col: str, lex: Lexicon,
                   related_factor: float = D.RELATED_FACTOR, method: str = "auto", **hit_kw) -> DataFrame:
    """A1/K5: score of every (text, category), 0 for categories without a hit.

    ``join``: texts x categories (broadcast, one row per category) -> left join
    with the category's keywords on containment -> related boost -> sum.
    ``sweep``: hits of one pass, and a zero row per key and category, are summed
    together; only keys, category and number are shuffled, never a text."""
    if _by_sweep(lex, method):
        hits = related_hits(texts, keys, text_col, lex, related_factor, "sweep", **hit_kw)
        zero = texts.select(*keys).crossJoin(_bcast_categories(lex)).withColumn("base", F.lit(0.0))
        group = [*keys, "dept", "dept_ord"]
        return (hits.select(*group, "base").unionByName(zero.select(*group, "base"))
                .groupBy(*group).agg(F.sum("base").alias("kw_score")))
    return _category_scores(
        texts.select(*keys, F.col(text_col).alias("_t")).crossJoin(_bcast_categories(lex)),
        keys, lex, related_factor, **hit_kw)


def _category_scores(base: DataFrame, keys: Sequence[str], lex: Lexicon,
                     related_factor: float, carry: Sequence[str] = (), **hit_kw) -> DataFrame:
    """``base`` has keys, dept, dept_ord, _t and ``carry`` columns, one row
    per (text, category). Returns keys, dept, dept_ord, carry, kw_score."""
    lx = _bcast_keywords(lex).select(F.col("dept").alias("l_dept"), "kw_ord", "keyword", "weight")
    j = base.join(lx, (F.col("dept") == F.col("l_dept"))
                  & F.col("_t").contains(F.col("keyword")), "left")
    cols = hit_columns(F.col("_t"), F.col("keyword"), F.col("weight"), **hit_kw)
    hits = j.select(*keys, "dept", "dept_ord", *carry, "kw_ord", "keyword",
                    cols["context"].alias("context"), cols["base0"].alias("base0"))
    rel = with_related(hits, keys, lex, related_factor)
    out = rel.groupBy(*keys, "dept", "dept_ord").agg(
        *[F.any_value(c).alias(c) for c in carry],
        F.coalesce(F.sum("base"), F.lit(0.0)).alias("kw_score"))
    return out
