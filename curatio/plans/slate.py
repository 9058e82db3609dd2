"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole driver tables. Column names match :mod:`curatio.plans.oracle`."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.functions.text import clean_text, composite_text, ustrip
from curatio.functions.vectors import cosine
from curatio.operators import classify as C
from curatio.operators import curate as K
from curatio.operators import lexicon as L
from curatio.operators import pages as P
from curatio.operators import report as R
from curatio.operators import similarity as V
from curatio.operators.seen import SeenKeys
from curatio.plans import scenario as S
from curatio.sources.tables import qa_from_conversations, qa_from_documents, table
from curatio.sources.readers import classify_json_lines, schema_gate
from curatio.operators.util import checked_broadcast, ship_by_value, spread
from curatio.session import checkpoint_dir, cut_lineage

KEYS = S.QA_KEYS



def _tasks(spark) -> int | None:
    """Tasks for the CPU-heavy narrow steps (the session setting
    ``curatio.input.partitions``); unset: as the files are read."""
    n = spark.conf.get("curatio.input.partitions", None)
    return int(n) if n else None


_LEXICONS: dict = {}


def _lex(spark, mapping=None) -> L.Lexicon:
    """The scenario lexicon, built once per session (a job's parameter)."""
    mapping = mapping or S.TEST_LEXICON
    key = (spark.sparkContext.applicationId, repr(mapping))
    if key not in _LEXICONS:
        _LEXICONS[key] = L.lexicon_from_dict(spark, mapping, markers=S.TEST_MARKERS)
    return _LEXICONS[key]


def _params(**kw) -> C.ClassifyParams:
    base = dict(fallback=S.TEST_FALLBACK, exclusions=S.TEST_EXCLUSIONS)
    base.update(kw)
    return C.ClassifyParams(**base)


def _qa(spark, d) -> DataFrame:
    return qa_from_conversations(table(spark, d, "conversations"))


def _qa_vectors(spark, d, qa: DataFrame | None = None, key: str = "conv_id") -> DataFrame:
    """QA rows with an embedding: vector ``key mod |embeddings|``.
    The count is a one-row aggregate, broadcast without a driver trip."""
    emb = table(spark, d, "embeddings")
    qa = spread(qa if qa is not None else _qa(spark, d), _tasks(spark))
    # a global aggregate has exactly one row: a proven size
    n = checked_broadcast(emb.agg(F.count(F.lit(1)).alias("_n")), known_rows=1, what="count")
    qa = qa.crossJoin(n) \
        .withColumn("_vk", F.pmod(key, "_n")).drop("_n")
    vec = emb.select(F.col("vec_id").alias("_vk"), "embedding")
    return qa.join(vec, "_vk", "left").drop("_vk")


def _protos(spark, d, lex: L.Lexicon) -> DataFrame:
    """Prototype of category ``dept_ord = i``: exemplar vector of label i."""
    ex = V.exemplar_prototypes(table(spark, d, "embeddings"), "vec_id", "embedding", "label")
    return lex.categories.join(ex, F.col("dept_ord") == F.col("label")).select("dept", "proto")


def _texts(spark, d) -> DataFrame:
    return C.classification_text(_qa(spark, d), "question", "answer", "ctext")


def _classified(spark, d, **kw) -> DataFrame:
    lex = _lex(spark)
    return C.classify(_qa_vectors(spark, d), KEYS, lex, "embedding",
                      _protos(spark, d, lex), _params(**kw))


def _r6(c):
    return F.round(c, 6)


# ------------------------------------------------------------------ pages

def q_page_links(spark: SparkSession, d: str) -> DataFrame:
    return P.page_links(table(spark, d, "pages"), S.PAGE_LINK_SELECTOR, S.PAGE_LINK_SUBSTRING,
                        partitions=_tasks(spark))


def q_page_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Every anchor of the selector, document order and duplicates kept (no
    substring filter)."""
    return P.page_links(table(spark, d, "pages"), S.PAGE_LINK_SELECTOR, None, partitions=_tasks(spark))


def q_page_qa(spark: SparkSession, d: str) -> DataFrame:
    return P.page_qa(table(spark, d, "pages"), S.PAGE_QUESTION_SELECTOR, S.PAGE_ANSWER_SELECTOR,
                     partitions=_tasks(spark))


def q_latest_capture(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    cap = ev.select(F.col("user_id").alias("url"), "event_id",
                    F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
                    F.lit(None).cast("string").alias("error"))
    out = P.deciding_captures(cap, attempt_col="event_id")
    return out.select("url", "event_id", (F.col("try_no") - 1).cast("long").alias("attempt"))


# ------------------------------------------------------------- sources

def q_bad_rows_split(spark: SparkSession, d: str) -> DataFrame:
    # the stored objects, and by the kind of event each way of being bad:
    # text or closing brackets after the object, not an object, cut short, key missing
    kind, p = F.col("event_type"), F.col("props")
    tail = F.element_at(F.array(*[F.lit(x) for x in (" trailing", "]", "] junk", "]]", "],[1")]),
                        (F.col("event_id") % 5 + 1).cast("int"))
    line = (F.when(kind == "click", F.concat(p, tail))
            .when(kind == "error", F.concat(F.lit("["), p, F.lit("]")))
            .when(kind == "purchase", F.substr(p, F.lit(1), F.length(p) - 1))
            .when(kind == "signup", F.replace(p, F.lit('"k"'), F.lit('"j"'))).otherwise(p))
    ev = table(spark, d, "events").select("event_id", line.alias("line"))
    out = classify_json_lines(ev, "line", "k BIGINT", required=["k"])
    return out.select("event_id", F.col("k"), "is_bad")


def q_dedup_first_seen(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return K.dedup_first_seen(docs, ["text"], ["doc_id"]).select("doc_id", "lang", "source", "n_chars")


def q_unseen_questions(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the later half of the crawl whose text the earlier half
    does not hold."""
    docs = table(spark, d, "documents")
    half = docs.agg(F.expr("max(doc_id) div 2").alias("half"))
    run = docs.select("doc_id", "lang", "text").join(F.broadcast(half))         # one row
    earlier, later = run.filter("doc_id <= half"), run.filter("doc_id > half")
    return K.drop_seen(later, earlier, ["text"]).select("doc_id", "lang")


def q_unseen_by_index(spark: SparkSession, d: str) -> DataFrame:
    """J6 by an index of keys: the earlier half's text digests are added to a new
    index in the shared folder, the later half is looked up there."""
    docs = table(spark, d, "documents")
    half = docs.agg(F.expr("max(doc_id) div 2").alias("half"))
    run = docs.select("doc_id", "lang", F.sha2("text", 256).alias("digest")).join(F.broadcast(half))     # one row
    index = SeenKeys(spark, f"{checkpoint_dir(spark).rstrip('/')}/seen-{uuid.uuid4().hex}", "digest STRING", buckets=64)
    index.add(run.filter("doc_id <= half"))
    return index.unseen(run.filter("doc_id > half")).select("doc_id", "lang")


def q_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """User turns with the answer that follows; those without one are
    quarantined."""
    conv = table(spark, d, "conversations")
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    q = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    good, bad = schema_gate(q.join(a, ["conv_id", "turn"], "left"), mode="quarantine")
    return good.select(*KEYS, F.lit(False).alias("is_bad")).unionByName(
        bad.select(*KEYS, F.lit(True).alias("is_bad")))


def q_decoded_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages as bytes of the crawl's charset, decoded."""
    @F.pandas_udf("binary")
    def body(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else t.encode("gb18030"))

    pg = spread(table(spark, d, "pages").select("page_id", "html"), _tasks(spark))
    return pg.select("page_id", body("html").alias("body")).select(
        "page_id", P.decode_body("body", spark=spark).alias("html"))


# ---------------------------------------------------------------- text

def q_clean_text(spark: SparkSession, d: str) -> DataFrame:
    pg = spread(table(spark, d, "pages"), _tasks(spark))
    return pg.select("page_id",
                     clean_text(F.concat_ws(" ", "url", "html")).alias("cleaned"),
                     F.length(ustrip("html")).cast("long").alias("stripped_len"))


def q_composite_text(spark: SparkSession, d: str) -> DataFrame:
    qa = _qa(spark, d)
    comp = composite_text("question", "answer")
    return qa.select(*KEYS, comp.alias("composite"), clean_text(comp).alias("ctext"))


# ------------------------------------------------------------- lexicon

def q_keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    h = L.keyword_hits(_texts(spark, d), KEYS, "ctext", _lex(spark))
    return h.select(*KEYS, "dept", "keyword", F.col("cnt").cast("long").alias("cnt"),
                    F.col("pos").cast("long").alias("pos"), "early", _r6("base0").alias("base0"))


def q_keyword_context(spark: SparkSession, d: str) -> DataFrame:
    lex = _lex(spark)
    h = L.with_related(L.keyword_hits(_texts(spark, d), KEYS, "ctext", lex), KEYS, lex)
    return h.select(*KEYS, "dept", "keyword", F.col("n_related").cast("long").alias("n_related"),
                    _r6("base").alias("base"))


def q_keyword_sweep(spark: SparkSession, d: str) -> DataFrame:
    h = L.related_hits(_texts(spark, d), KEYS, "ctext", _lex(spark), method="sweep")
    return h.select(*KEYS, "dept", "keyword", F.col("cnt").cast("long").alias("cnt"), F.col("pos").cast("long").alias("pos"),
                    "early", F.col("n_related").cast("long").alias("n_related"), _r6("base").alias("base"))


def q_keyword_sweep_scores(spark: SparkSession, d: str) -> DataFrame:
    s = L.keyword_scores(_texts(spark, d), KEYS, "ctext", _lex(spark), method="sweep")
    return s.select(*KEYS, "dept", _r6("kw_score").alias("kw_score"))


def q_keyword_scores(spark: SparkSession, d: str) -> DataFrame:
    s = L.keyword_scores(_texts(spark, d), KEYS, "ctext", _lex(spark))
    return s.select(*KEYS, "dept", _r6("kw_score").alias("kw_score"))


# ----------------------------------------------------------- similarity

def q_cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    emb = table(spark, d, "embeddings")
    pairs = emb.select(F.col("vec_id").alias("a_id"), (F.col("vec_id") + 1).alias("b_id"))
    s = V.pair_similarity(pairs, emb, emb, "a_id", "b_id", "vec_id", "embedding")
    return s.select("a_id", "b_id", _r6("similarity").alias("similarity"))


def q_prototype_scores(spark: SparkSession, d: str) -> DataFrame:
    emb = table(spark, d, "embeddings")
    protos = V.exemplar_prototypes(emb, "vec_id", "embedding", "label")
    protos = checked_broadcast(cut_lineage(protos), what="prototypes")
    j = emb.select("vec_id", "embedding").crossJoin(
        protos.select(F.col("label").alias("proto_label"), "proto"))
    return j.select("vec_id", "proto_label", _r6(cosine("embedding", "proto")).alias("similarity"))


def q_keyword_prototype_scores(spark: SparkSession, d: str) -> DataFrame:
    """V3 + V4: questions against the categories' keyword prototypes, both
    embedded by the model hook."""
    lex = _lex(spark)
    protos = checked_broadcast(V.keyword_prototypes(lex.keywords, lex.categories, S.letter_model),
                               known_rows=lex.n_categories, what="prototypes")
    qa = V.embed_with(spread(_qa(spark, d), _tasks(spark)), "question", "qv", S.letter_model)
    return qa.select(*KEYS, "qv").crossJoin(protos).select(
        *KEYS, "dept", _r6(cosine("qv", "proto")).alias("similarity"))


def q_blend_scores(spark: SparkSession, d: str) -> DataFrame:
    lex = _lex(spark)
    rows = C.classification_text(_qa_vectors(spark, d), "question", "answer", "ctext")
    a = C.category_scores(rows, KEYS, "ctext", lex, "embedding", _protos(spark, d, lex), _params())
    return a.select(*KEYS, "dept", _r6("similarity").alias("similarity"),
                    _r6("kw_score").alias("kw_score"), _r6("score").alias("score"), "excluded")


def q_classify(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).select(*KEYS, "label", _r6("best_score").alias("best_score"))


def q_classify_documents(spark: SparkSession, d: str) -> DataFrame:
    """The document corpus through the same chain: first line = question,
    the rest = answer (read whole), keyed by doc_id."""
    lex = _lex(spark)
    docs = qa_from_documents(table(spark, d, "documents")).select("doc_id", "question", "answer")
    out = C.classify(_qa_vectors(spark, d, docs, "doc_id"), ["doc_id"], lex, "embedding",
                     _protos(spark, d, lex), _params(answer_prefix=None))
    return out.select("doc_id", "label", _r6("best_score").alias("best_score"))


def q_classification_stats(spark: SparkSession, d: str) -> DataFrame:
    return R.stats_lines(_classified(spark, d), "label")


def q_classify_similarity(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d, keyword_weight=0.0).select(*KEYS, "label", _r6("best_score").alias("best_score"))


def q_classify_sparse(spark: SparkSession, d: str) -> DataFrame:
    lex = _lex(spark, S.SPARSE_LEXICON)
    out = C.classify(_qa(spark, d), KEYS, lex, None, None, _params())
    return out.select(*KEYS, "label", _r6("best_score").alias("best_score"))


# -------------------------------------------------------------- curation

def _valid(df: DataFrame) -> DataFrame:
    return df.withColumn("valid", K.quality_mask("question", "answer",
                                                 reject_terms=S.TEST_REJECT_TERMS))


def _final(spark, d) -> DataFrame:
    """Classified -> quality filter -> per-label cap -> running ids."""
    # the classified corpus is a table of its own (written once to the
    # shared checkpoint folder), read by the cap, rank and id steps
    v = _valid(cut_lineage(_classified(spark, d))).filter("valid")
    v = v.withColumn("qa_key", F.concat_ws("-", *[F.col(k).cast("string") for k in KEYS]))
    capped = K.cap_per_group(v, "label", "qa_key", S.TEST_CAP, S.TEST_SEED)
    return K.running_ids(capped, "label", KEYS, "id")


def q_quality_filter(spark: SparkSession, d: str) -> DataFrame:
    qa = _qa(spark, d)
    return qa.select(*KEYS,
                     F.length(ustrip("question")).cast("long").alias("q_len"),
                     F.length(ustrip("answer")).cast("long").alias("a_len"),
                     K.reject_mask("answer", S.TEST_REJECT_TERMS).alias("rejected"),
                     K.quality_mask("question", "answer",
                                    reject_terms=S.TEST_REJECT_TERMS).alias("valid"))


def q_cap_per_group(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return K.cap_per_group(docs, "lang", "doc_id", S.TEST_CAP, S.TEST_SEED)


def q_running_ids(spark: SparkSession, d: str) -> DataFrame:
    return _final(spark, d).select(*KEYS, "label", "id")


def q_conversations_out(spark: SparkSession, d: str) -> DataFrame:
    rec = K.conversation_records(_final(spark, d), "id", "question", "answer")
    return rec.select("id", F.to_json("conversations").alias("conversations"))


def q_prompted_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Records with the system turn of the label, for labels that have one."""
    prompts = spark.createDataFrame(S.TEST_PROMPTS, "g string, prompt string")
    rec = K.conversation_records(_final(spark, d), "id", "question", "answer", prompts=prompts, group_col="label")
    return rec.select("id", F.to_json("conversations").alias("conversations"))


def q_conversion_stats(spark: SparkSession, d: str) -> DataFrame:
    v = _valid(_classified(spark, d))
    return K.conversion_stats(v, "label", "valid", S.TEST_CAP)


def q_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.distribution(_classified(spark, d), "label")


def q_lang_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.distribution(table(spark, d, "documents"), "lang")


def q_group_rows(spark: SparkSession, d: str) -> DataFrame:
    # the classified corpus is read twice (rank aggregate + join back), so it
    # is a written table first: classification is narrow and has no
    # exchange that a second reader could reuse
    c = cut_lineage(_classified(spark, d).select(*KEYS, "label"))
    return K.first_appearance_rank(c, "label", KEYS, "group_rank").select(
        "label", F.col("group_rank").cast("long").alias("group_rank"), *KEYS)


QUERIES = {
    "page_links": q_page_links,
    "page_anchors": q_page_anchors,
    "page_qa": q_page_qa,
    "latest_capture": q_latest_capture,
    "bad_rows_split": q_bad_rows_split,
    "unseen_questions": q_unseen_questions,
    "unseen_by_index": q_unseen_by_index,
    "quarantine": q_quarantine,
    "decoded_pages": q_decoded_pages,
    "dedup_first_seen": q_dedup_first_seen,
    "clean_text": q_clean_text,
    "composite_text": q_composite_text,
    "keyword_hits": q_keyword_hits,
    "keyword_context": q_keyword_context,
    "keyword_scores": q_keyword_scores,
    "keyword_sweep": q_keyword_sweep,
    "keyword_sweep_scores": q_keyword_sweep_scores,
    "cosine_pairs": q_cosine_pairs,
    "prototype_scores": q_prototype_scores,
    "keyword_prototype_scores": q_keyword_prototype_scores,
    "blend_scores": q_blend_scores,
    "classify": q_classify,
    "classify_documents": q_classify_documents,
    "classification_stats": q_classification_stats,
    "classify_similarity": q_classify_similarity,
    "classify_sparse": q_classify_sparse,
    "quality_filter": q_quality_filter,
    "cap_per_group": q_cap_per_group,
    "running_ids": q_running_ids,
    "conversations_out": q_conversations_out,
    "prompted_conversations": q_prompted_conversations,
    "conversion_stats": q_conversion_stats,
    "distribution": q_distribution,
    "lang_distribution": q_lang_distribution,
    "group_rows": q_group_rows,
}

# the small functions above also run where the package isn't installed
ship_by_value(__name__, "curatio.plans.scenario")
