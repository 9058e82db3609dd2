"""The automaton pass against the join, a brute-force count, and plans without
moved texts."""

import random
import time

import pytest

from curatio.operators import lexicon as L
from curatio.operators.sweep import KeywordAutomaton, blocks_of

RADIUS = 10


def brute(text, lexicon):
    """(category, keyword) -> (count, position, related) by scanning the text for each keyword."""
    out = {}
    for dept, words in lexicon.items():
        for w in words:
            if w in text:
                pos = text.find(w)
                ctx = text[max(0, pos - RADIUS):min(len(text), pos + len(w) + RADIUS)]
                out[dept, w] = (text.count(w), pos, sum(o != w and o in ctx for o in words))
    return out


def random_lexicon(rng, letters="ab子é😀"):
    """Nested and overlapping keywords of few letters, some in two categories, some listed twice."""
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 5)))
    return {f"d{k}": [word() for _ in range(12)] for k in range(4)} | {"none": []}


def found(machine, text):
    return {machine.pairs[p]: (n, pos, rel) for p, n, pos, rel in machine.find(text, RADIUS)}


@pytest.mark.parametrize("seed", range(40))
def test_automaton_equals_brute_force(seed):
    rng = random.Random(seed)
    lexicon = random_lexicon(rng)
    machine = KeywordAutomaton([(d, w) for d, words in lexicon.items() for w in words])
    for _ in range(30):
        text = "".join(rng.choice("ab子é😀 ") for _ in range(rng.choice([0, 1, 5, 40, 120])))
        assert found(machine, text) == brute(text, lexicon)


TEXTS = ["", None, "aaaa", "abab子ab", "子" * 50 + "ab", "no hit?", "é😀" * 12, "ab? ab", "ab? ab", "x" * 30 + "b"]


def test_sweep_equals_join(spark):
    lex = L.lexicon_from_dict(spark, random_lexicon(random.Random(7)))
    texts = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "abba 子")], "id long, t string")
    for f in (L.keyword_hits, L.related_hits, L.keyword_scores):
        cols = None
        got = {}
        for method in ("join", "sweep"):
            df = f(texts, ["id"], "t", lex, method=method)
            cols = cols or sorted(df.columns)
            assert sorted(df.columns) == cols
            got[method] = sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                                  for r in df.select(*cols).collect()), key=repr)
        assert got["join"] == got["sweep"] and got["join"], f


def test_lexicon_of_many_blocks_equals_one(spark):
    lex = L.lexicon_from_dict(spark, random_lexicon(random.Random(8)))
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    assert len(blocks_of(lex.keywords, 13)) == 4 and len(blocks_of(lex.keywords, 5)) == 4
    assert len(blocks_of(lex.keywords, 1000)) == 1
    want = sorted(map(repr, L.sweep_hits(texts, ["id"], "t", lex.keywords, RADIUS).collect()))
    got = sorted(map(repr, L.sweep_hits(texts, ["id"], "t", lex.keywords, RADIUS, block_keywords=5).collect()))
    assert got == want and got


def test_empty_lexicon_and_empty_table(spark):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    none = L.lexicon_from_dict(spark, {"a": []})
    assert L.related_hits(texts, ["id"], "t", none, method="sweep").count() == 0
    assert [r.kw_score for r in L.keyword_scores(texts, ["id"], "t", none, method="sweep").collect()] == [0.0] * len(TEXTS)
    lex = L.lexicon_from_dict(spark, {"a": ["ab"]})
    assert L.related_hits(texts.limit(0), ["id"], "t", lex, method="sweep").count() == 0


def test_lexicon_over_the_broadcast_bound(spark):
    """120,000 keywords: the join refuses them, ``auto`` reads each text once."""
    lexicon = {f"d{k}": [f"w{k}-{i:05}" for i in range(40_000)] for k in range(3)}
    lex = L.lexicon_from_dict(spark, lexicon)
    texts = spark.createDataFrame([(k, f"x w{k}-{k * 7:05} w{k}-{k * 7 + 1:05} w0-39999") for k in range(3)], "id long, t string")
    with pytest.raises(ValueError):
        L.keyword_hits(texts, ["id"], "t", lex, method="join")
    got = {(r.id, r.keyword): (r.pos, r.n_related) for r in L.related_hits(texts, ["id"], "t", lex).collect()}
    assert len(got) == 9 and got[1, "w1-00007"] == (2, 1)
    assert got[0, "w0-00000"] == (2, 1) and got[0, "w0-00001"] == (11, 2)


def test_time_hardly_grows_with_the_lexicon():
    rng = random.Random(1)
    words = [f"{rng.randrange(10 ** 9):09}" for _ in range(100_000)]
    text = " ".join(rng.choice(words[:300]) for _ in range(20_000))
    spent = []
    for n in (300, 100_000):
        machine = KeywordAutomaton([("d", w) for w in words[:n]])
        start = time.perf_counter()
        machine.find(text, RADIUS)
        spent.append(time.perf_counter() - start)
    assert spent[1] < 10 * spent[0] + 0.5                        # 333 times the keywords


def test_no_text_is_shuffled(spark):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    lex = L.lexicon_from_dict(spark, {"a": ["ab", "子"], "b": ["a"]})
    hits = L.related_hits(texts, ["id"], "t", lex, method="sweep")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    score = L.keyword_scores(texts, ["id"], "t", lex, method="sweep")
    plan = score._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan
