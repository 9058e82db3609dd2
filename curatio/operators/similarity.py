"""Embedding similarity (V1-V4; J3 is part of the row scoring in
:mod:`curatio.operators.classify`).

Texts carry an embedding column (``ARRAY<FLOAT>``), produced upstream by
any model; :func:`embed_with` applies a user model as an Arrow-batched
iterator pandas UDF (one model load per Python worker). Category
prototypes are a small table ``dept, proto``."""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio import defaults as D
from curatio.functions.vectors import cosine
from curatio.operators.util import ship_by_value


def pair_similarity(pairs: DataFrame, left: DataFrame, right: DataFrame,
                    left_key: str, right_key: str, id_col: str, vec_col: str,
                    eps: float = D.COSINE_EPS) -> DataFrame:
    """V1/V2: cosine similarity for every row of a pair table.

    ``pairs`` holds (left_key, right_key); both ends are looked up in the
    vector tables by equi-joins (Spark picks broadcast or shuffle)."""
    lv = left.select(F.col(id_col).alias(left_key), F.col(vec_col).alias("_va"))
    rv = right.select(F.col(id_col).alias(right_key), F.col(vec_col).alias("_vb"))
    j = pairs.join(lv, left_key).join(rv, right_key)
    return j.select(left_key, right_key, cosine("_va", "_vb", eps).alias("similarity"))


def exemplar_prototypes(vectors: DataFrame, id_col: str, vec_col: str, group_col: str) -> DataFrame:
    """One prototype per group: the vector with the lowest id in the group.

    ``min_by`` aggregates map-side, so a hot group costs one row per input
    partition in the shuffle."""
    return (vectors.groupBy(group_col)
            .agg(F.min_by(F.col(vec_col), F.col(id_col)).alias("proto"),
                 F.min(id_col).alias("proto_id")))


def embed_with(df: DataFrame, text_col: str, out_col: str,
               make_model: Callable[[], Callable[[pd.Series], Sequence[Sequence[float]]]]) -> DataFrame:
    """V4 hook: add ``out_col`` = model(text) with an iterator pandas UDF.

    ``make_model()`` runs once per Python worker and returns a function that
    maps a batch of texts to a batch of vectors."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for s in batches:
            yield pd.Series([list(map(float, v)) for v in model(s.fillna(""))])

    return df.withColumn(out_col, _embed(F.col(text_col)))


def keyword_prototypes(lexicon_keywords: DataFrame, categories: DataFrame,
                       make_model) -> DataFrame:
    """V3: prototype of a category = embedding of its keywords joined by a
    space in lexicon order (the empty string for a category without any)."""
    kws = (lexicon_keywords.groupBy("dept")
           .agg(F.sort_array(F.collect_list(F.struct("kw_ord", "keyword"))).alias("k")))
    text = categories.join(kws, "dept", "left").select(
        "dept", F.concat_ws(" ", F.coalesce(F.col("k.keyword"), F.array())).alias("proto_text"))
    return embed_with(text, "proto_text", "proto", make_model).select("dept", "proto")


ship_by_value(__name__)
