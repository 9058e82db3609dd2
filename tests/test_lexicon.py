"""K1-K5, J1, J2, A1 against a brute-force scorer on literal edge cases."""

import pytest
from pyspark.sql import functions as F

from curatio.operators.lexicon import keyword_hits, keyword_scores, lexicon_from_dict, with_related


def weight(kw, markers):
    w = 1.0
    if len(kw) > 2:
        w *= 1.5
    if any(m in kw for m in markers):
        w *= 1.3
    return w


def brute_score(text, kws, markers):
    """Direct statement of the rule: count * weight, x1.5 when the first
    hit is before the question end, x1.2 per other keyword of the category
    in the +-10 window around the first hit."""
    total = 0.0
    for kw in kws:
        if kw not in text:
            continue
        s = text.count(kw) * weight(kw, markers)
        qend = text.find("?") if "?" in text else len(text) // 2
        pos = text.find(kw)
        if pos < qend:
            s *= 1.5
        ctx = text[max(0, pos - 10):min(len(text), pos + len(kw) + 10)]
        for other in kws:
            if other != kw and other in ctx:
                s *= 1.2
        total += s
    return total


LEX = {"psy": ["精神", "精神病", "aa"], "gyn": ["月经", "子宫", "HIV"], "rep": ["子宫", "精子"],
       "none": []}
MARKERS = ["病", "炎"]
TEXTS = [
    "精神病人的精神问题 精神",          # nested pair
    "aaaa",                          # non-overlapping count
    "xxxx月经",                       # first hit at the end
    "月经xxxxxxxx",                   # at 0
    "abcd子宫",                       # exactly len//2 = 3? (pos 4, len 6 -> qend 3)
    "abc子宫d",                       # pos 3, len 6 -> qend 3: not early
    "ab子宫def",                      # pos 2 < 3: early
    "hiv and HIV",                    # keyword is not lower-cased: HIV matches only literally
    "子宫 and 精子 in two categories",
    "nothing here",
    "",
    "q?子宫 after question mark",
    "子宫 before? mark",
    "精神" + "x" * 30 + "精神病",        # related keyword outside the window
]


@pytest.fixture(scope="module")
def lex(spark):
    return lexicon_from_dict(spark, LEX, markers=MARKERS)


def test_weights(spark, lex):
    got = {r.keyword: r.weight for r in lex.keywords.collect()}
    for kws in LEX.values():
        for kw in kws:
            assert got[kw] == pytest.approx(weight(kw, MARKERS))
    assert {r.dept: r.dept_ord for r in lex.categories.collect()} == {d: i for i, d in enumerate(LEX)}


def test_scores_match_brute_force(spark, lex):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    s = keyword_scores(texts, ["id"], "t", lex).collect()
    got = {(r.id, r.dept): r.kw_score for r in s}
    assert len(got) == len(TEXTS) * len(LEX)  # zero rows kept
    for i, t in enumerate(TEXTS):
        for dept, kws in LEX.items():
            assert got[(i, dept)] == pytest.approx(brute_score(t, kws, MARKERS)), (t, dept)


def test_hits_and_related(spark, lex):
    texts = spark.createDataFrame([(0, "精神病人的精神问题")], "id long, t string")
    h = with_related(keyword_hits(texts, ["id"], "t", lex), ["id"], lex)
    rows = {r.keyword: r for r in h.collect()}
    assert set(rows) == {"精神", "精神病"}
    assert rows["精神"].n_related == 1 and rows["精神病"].n_related == 1
    assert rows["精神"].cnt == 2 and rows["精神"].pos == 0


def test_keyword_in_two_categories(spark, lex):
    texts = spark.createDataFrame([(0, "子宫")], "id long, t string")
    h = keyword_hits(texts, ["id"], "t", lex)
    assert sorted(r.dept for r in h.collect()) == ["gyn", "rep"]


def test_normalize_keywords(spark):
    lx = lexicon_from_dict(spark, {"a": ["HIV"]}, normalize_keywords=True)
    texts = spark.createDataFrame([(0, "hiv")], "id long, t string")
    assert keyword_hits(texts, ["id"], "t", lx).count() == 1


def test_plan_streams_texts_against_broadcast_lexicon(spark, lex):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string").repartition("id")
    plan = keyword_scores(texts, ["id"], "t", lex)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan and "BroadcastHashJoin" in plan
    # one exchange only (the explicit repartition); the aggregates reuse it
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert F is not None


def test_row_scoring_matches_join_scoring_and_brute_force(spark, lex):
    from curatio.operators.classify import ClassifyParams, category_scores
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    p = ClassifyParams(fallback="none", exclusions=[])
    rows = category_scores(texts, ["id"], "t", lex, params=p).collect()
    got = {(r.id, r.dept): r.kw_score for r in rows}
    joined = {(r.id, r.dept): r.kw_score for r in keyword_scores(texts, ["id"], "t", lex).collect()}
    assert got.keys() == joined.keys()
    for (i, dept), v in got.items():
        assert v == pytest.approx(joined[(i, dept)])
        assert v == pytest.approx(brute_score(TEXTS[i], LEX[dept], MARKERS))
