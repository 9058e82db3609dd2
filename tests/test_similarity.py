"""V1-V4: cosine, pair similarity, prototypes, the model hook, lexicon files."""

import json
import math
import os

import pytest

from curatio.operators.classify import ClassifyParams, classify
from curatio.operators.lexicon import lexicon_from_dict, read_lexicon
from curatio.operators.similarity import embed_with, exemplar_prototypes, keyword_prototypes, pair_similarity
from curatio.operators.util import ship_by_value

ship_by_value(__name__)  # the toy model below runs in the Python workers


def _cos(a, b):
    dot = sum(x * y for x, y in zip(a, b))
    na = max(math.sqrt(sum(x * x for x in a)), 1e-8)
    nb = max(math.sqrt(sum(y * y for y in b)), 1e-8)
    return dot / (na * nb)


def test_pair_similarity_and_exemplars(spark):
    vecs = [(0, [1.0, 0.0], 0), (1, [0.0, 2.0], 0), (2, [1.0, 1.0], 1), (3, [0.0, 0.0], 1)]
    df = spark.createDataFrame(vecs, "id long, v array<float>, g int")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (2, 3)], "a long, b long")
    got = {(r.a, r.b): r.similarity for r in pair_similarity(pairs, df, df, "a", "b", "id", "v").collect()}
    for (a, b), s in got.items():
        assert s == pytest.approx(_cos(vecs[a][1], vecs[b][1]))
    assert got[(2, 3)] == 0.0  # zero vector: norm floored, no division by zero
    ex = {r.g: (r.proto_id, list(r.proto)) for r in exemplar_prototypes(df, "id", "v", "g").collect()}
    assert ex == {0: (0, [1.0, 0.0]), 1: (2, [1.0, 1.0])}


def toy_model():
    """A stand-in text model: letter counts of a, e, i, o."""
    def embed(texts):
        return [[float(t.count(c)) for c in "aeio"] for t in texts]
    return embed


def test_model_hook_and_keyword_prototypes(spark):
    lex = lexicon_from_dict(spark, {"x": ["aaa", "ae"], "y": ["ooo"], "z": []})
    protos = {r.dept: list(r.proto) for r in keyword_prototypes(lex.keywords, lex.categories, toy_model).collect()}
    # prototype = embedding of the keywords joined by a space; empty string when none
    assert protos == {"x": [4.0, 1.0, 0.0, 0.0], "y": [0.0, 0.0, 0.0, 3.0], "z": [0.0, 0.0, 0.0, 0.0]}
    texts = spark.createDataFrame([(0, "oooo"), (1, "aaaa")], "id long, t string")
    emb = embed_with(texts, "t", "v", toy_model)
    assert {r.id: list(r.v) for r in emb.collect()} == {0: [0.0, 0.0, 0.0, 4.0], 1: [4.0, 0.0, 0.0, 0.0]}
    pr = keyword_prototypes(lex.keywords, lex.categories, toy_model)
    qa = embed_with(spark.createDataFrame([(0, "zzzz", "oooo oooo"), (1, "b", "aaaa aaaa")],
                                          "id long, question string, answer string"),
                    "answer", "v", toy_model)
    p = ClassifyParams(fallback="z", exclusions=[], keyword_weight=0.0)
    got = {r.id: r.label for r in classify(qa, ["id"], lex, "v", pr, p).collect()}
    assert got == {0: "y", 1: "x"}


def test_read_lexicon_file_equals_dict(spark, tmpdir_path):
    mapping = {"内科": ["头痛", "发烧病"], "外科": ["骨折"], "其他科": []}
    path = os.path.join(tmpdir_path, "lex.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(mapping, f, ensure_ascii=False)
    a, b = read_lexicon(spark, path), lexicon_from_dict(spark, mapping)
    rows = lambda lx: sorted(map(tuple, lx.keywords.select("dept", "dept_ord", "kw_ord", "keyword", "weight").collect()))
    assert rows(a) == rows(b)
    assert sorted(map(tuple, a.categories.collect())) == sorted(map(tuple, b.categories.collect()))
    qa = spark.createDataFrame([(0, "头痛发烧病怎么办", "多喝水休息一下吧朋友们"), (1, "骨折", "去医院看看吧朋友们好吗"),
                                (2, "无关", "完全无关的内容在这里啊")], "id long, question string, answer string")
    la = {r.id: r.label for r in classify(qa, ["id"], a).collect()}
    lb = {r.id: r.label for r in classify(qa, ["id"], b).collect()}
    assert la == lb == {0: "内科", 1: "外科", 2: "其他科"}
