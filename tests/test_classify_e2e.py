"""End to end: the row-form classification equals a direct Python statement
of the rules (clean -> keyword scores -> cosine -> blend -> exclusions ->
arg-max with fallback) on real texts with random vectors."""

import math
import random

import pyarrow.parquet as pq
import pytest

from conftest import SF001
from test_lexicon import brute_score
from test_text import py_clean

from curatio.operators.classify import ClassifyParams, classify
from curatio.operators.lexicon import lexicon_from_dict
from curatio.plans.scenario import TEST_EXCLUSIONS, TEST_LEXICON, TEST_MARKERS


def _cos(a, b):
    if a is None or b is None:
        return 0.0
    dot = sum(float(x) * float(y) for x, y in zip(a, b))
    na = max(math.sqrt(sum(float(x) ** 2 for x in a)), 1e-8)
    nb = max(math.sqrt(sum(float(y) ** 2 for y in b)), 1e-8)
    return dot / (na * nb)


def py_label(q, a, vec, protos, sim_w, kw_w, fallback="other"):
    text = py_clean(f"{q} {q} {a[:200]}".lower())
    depts = list(TEST_LEXICON)
    scores = [sim_w * _cos(vec, protos.get(d)) + kw_w * brute_score(text, TEST_LEXICON[d], TEST_MARKERS)
              for d in depts]
    r = list(scores)
    top = max(range(len(depts)), key=lambda i: (r[i], -i))
    adj = list(scores)
    for w, e in TEST_EXCLUSIONS:
        if depts[top] == w:
            adj[depts.index(e)] *= 0.5
    ra = list(adj)
    best = max(range(len(depts)), key=lambda i: (ra[i], -i))
    return (depts[best] if ra[best] > 0 else fallback), ra[best]


@pytest.mark.parametrize("sim_w,kw_w", [(0.7, 0.3), (0.7, 0.0), (0.0, 0.3)])
def test_row_classification_equals_python(spark, sim_w, kw_w):
    conv = pq.read_table(f"{SF001}/conversations.parquet").to_pylist()
    by = {(r["conv_id"], r["turn"]): r for r in conv}
    pairs = [(k[0], k[1], r["text"], by[(k[0], k[1] + 1)]["text"]) for k, r in by.items()
             if r["role"] == "user" and (k[0], k[1] + 1) in by and by[(k[0], k[1] + 1)]["role"] == "assistant"]
    rnd = random.Random(5)
    vecs = {(c, t): [rnd.uniform(-1, 1) for _ in range(4)] for c, t, _, _ in pairs}
    protos = {d: [rnd.uniform(-1, 1) for _ in range(4)] for d in list(TEST_LEXICON)[:4]}
    rows = [(c, t, q, a, vecs[(c, t)]) for c, t, q, a in pairs]
    qa = spark.createDataFrame(rows, "conv_id long, turn long, question string, answer string, v array<float>")
    # the Spark side sees FLOAT vectors: use the same rounding on the Python side
    import numpy as np
    vecs = {k: [float(np.float32(x)) for x in v] for k, v in vecs.items()}
    pr = spark.createDataFrame([(d, p) for d, p in protos.items()], "dept string, proto array<float>")
    protos = {d: [float(np.float32(x)) for x in p] for d, p in protos.items()}
    lex = lexicon_from_dict(spark, TEST_LEXICON, markers=TEST_MARKERS)
    p = ClassifyParams(similarity_weight=sim_w, keyword_weight=kw_w, fallback="other",
                       exclusions=TEST_EXCLUSIONS)
    got = {(r.conv_id, r.turn): (r.label, r.best_score)
           for r in classify(qa, ["conv_id", "turn"], lex, "v", pr, p).collect()}
    assert len(got) == len(pairs) > 0
    for c, t, q, a in pairs:
        want = py_label(q, a, vecs[(c, t)], protos, sim_w, kw_w)
        assert got[(c, t)][0] == want[0], (c, t)
        assert got[(c, t)][1] == pytest.approx(want[1], abs=1e-6)
