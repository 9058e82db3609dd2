"""Parquet tables and the QA relation derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table; the DataFrame (file listing and schema) is made once
    per session and path and reused - the same immutable logical scan."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def qa_from_conversations(conv: DataFrame, user_role: str = "user",
                          assistant_role: str = "assistant") -> DataFrame:
    """QA rows: each user turn with the assistant turn that directly follows.

    Equi-join on (conv_id, turn + 1) - one partner per user turn, never all
    pairs of a conversation. Output: conv_id, turn (the user turn),
    question, answer."""
    u = (conv.filter(F.col("role") == user_role)
         .select("conv_id", "turn", F.col("text").alias("question"),
                 (F.col("turn") + 1).alias("answer_turn")))
    a = (conv.filter(F.col("role") == assistant_role)
         .select(F.col("conv_id").alias("a_conv"), F.col("turn").alias("a_turn"),
                 F.col("text").alias("answer")))
    j = u.join(a, (u.conv_id == a.a_conv) & (u.answer_turn == a.a_turn), "inner")
    return j.select("conv_id", "turn", "question", "answer")


def qa_from_documents(docs: DataFrame) -> DataFrame:
    """Documents as QA rows: the first line is the question, the rest the
    answer (``source`` becomes the url). Used to run the curation operators
    on the document corpus."""
    text = F.col("text")
    nl = F.position(F.lit("\n"), text)
    return docs.select(
        "doc_id", "lang",
        F.when(nl > 0, F.substr(text, F.lit(1), nl - 1)).otherwise(text).alias("question"),
        F.when(nl > 0, F.substr(text, nl + 1, F.length(text))).otherwise(F.lit("")).alias("answer"),
        F.col("source").alias("url"))


__all__ = ["table", "qa_from_conversations", "qa_from_documents"]
