"""Registered queries of the operators, with production parameters over whole
tables, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.llm import (arc_warc, bpe_automaton, fertility, hard_negatives, jaccard_join, langid, lattice_lm,
                         learned_ann, licenses, line_dedup, link_trust, oracle, packing, prefix_trie)
from curatio.llm.scratch import drop, scratch_path
from curatio.sources.tables import table


def vocabulary(name: str) -> bytes:
    """A public tokenizer file; its folder is that of the installed package."""
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


def op2_url_trust(spark: SparkSession, d: str) -> DataFrame:
    return link_trust.judge_urls(table(spark, d, "pages"))


def op3_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, d, "documents"))


def op4_arc_to_warc(spark: SparkSession, d: str) -> DataFrame:
    rules = arc_warc.ArcRules()
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    arc_warc.write_arc(table(spark, d, "pages"), arc, rules)
    arc_warc.convert(spark, arc, warc, rules)
    drop(spark, arc)
    return arc_warc.read_warc(spark, warc).select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def fertility_rules() -> fertility.FertilityRules:
    return fertility.FertilityRules(vocabulary("piece_bpe_32k.model"))


def op5_fertility(spark: SparkSession, d: str) -> DataFrame:
    return fertility.quality_columns(table(spark, d, "documents"), fertility_rules())


def op6_learned_partitions(spark: SparkSession, d: str) -> DataFrame:
    return learned_ann.search(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_bpe_automaton(spark: SparkSession, d: str) -> DataFrame:
    return bpe_automaton.encode_documents(table(spark, d, "documents"), vocabulary("word_bpe_49k.json"), digests=True)


def op8_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, d, "documents"))


def op9_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    out = langid.predict(docs, langid.fit(docs))
    held = F.coalesce(langid.fold(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, d, "documents"), line_dedup.LineRules())


def op11_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    label = F.when(vectors["vec_id"] % 7 == 0, (vectors["label"] + 1) % 10).otherwise(vectors["label"])
    return hard_negatives.hard_negatives(vectors, vectors["vec_id"] % 100 == 0, label=label)


def op12_lattice_lm(spark: SparkSession, d: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lattice_lm.score_documents(table(spark, d, "documents"), held_out,
                                      lattice_lm.LatticeRules(vocabulary("piece_bpe_32k.model")))


def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, d, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_url_trust, op3_jaccard_join, op4_arc_to_warc, op5_fertility, op6_learned_partitions,
    op7_bpe_automaton, op8_license_scan, op9_language_id, op10_line_dedup, op11_hard_negatives, op12_lattice_lm,
    op13_prefix_trie)}

ORACLE_SQL: dict[str, str] = {
    "op3_jaccard_join": oracle.JACCARD, "op4_arc_to_warc": oracle.ARC_TO_WARC,
    "op11_hard_negatives": oracle.HARD_NEGATIVES, "op13_prefix_trie": oracle.PREFIX_TRIE}
