"""The JVM cleaning chain equals Python ``re`` semantics."""

import random
import re

from pyspark.sql import functions as F

from curatio.functions.text import clean_text, composite_text, count_occurrences, first_pos, ustrip

# The original Python cleaning steps, used as the test oracle.
PY_STEPS = [
    (r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+", ""),
    (r"<[^>]+>", ""),
    (r"[^\w\s]", ""),
    (r"\d+", ""),
    (r"\s+", " "),
]


def py_clean(s: str) -> str:
    s = s.lower()
    for pat, rep in PY_STEPS:
        s = re.sub(pat, rep, s)
    return s.strip()


SAMPLES = [
    "see http://a.b/c头痛 and https://x.y/z<b>bold</b>",
    "url https://a.b/c~tilde and HTTP://UP.CASE/x#frag",
    "a<b 和 c>d",
    "头。痛，发烧！",
    "fullwidth １２ and ² and Ⅷ and ‿ and é accent",
    "ctl\u001f sep　ideo nbsp line\u0085nel\x0bvt",
    "  leading and trailing  ",
    "",
    "digits 123 ٣٤ mixed4you",
    "under_score snake_case __x__",
]


def _run(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def test_clean_matches_python(spark):
    got = _run(spark, SAMPLES, clean_text)
    assert got == [py_clean(s) for s in SAMPLES]


def test_clean_random_strings(spark):
    rnd = random.Random(7)
    alphabet = list("abcXYZ019 <>/:.?&%_-~#\"'\t\n") + ["头", "痛", "。", "１", "²", "　",
                                                      " ", "́", "Ⅷ", "http://", "https://"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    assert _run(spark, texts, clean_text) == [py_clean(s) for s in texts]


def test_long_url_does_not_overflow(spark):
    t = "x http://" + "a" * 200_000 + " y"
    assert _run(spark, [t], clean_text) == ["x y"]


def test_clean_is_idempotent(spark):
    once = _run(spark, SAMPLES, clean_text)
    assert _run(spark, once, clean_text) == once


def test_unicode_strip(spark):
    texts = ["　 abc ", "\t\n x \x1f", "   "]
    assert _run(spark, texts, ustrip) == [t.strip() for t in texts]


def test_composite_text(spark):
    df = spark.createDataFrame([("q", "a" * 300), (None, "ans")], "q string, a string")
    got = [r[0] for r in df.select(composite_text("q", "a")).collect()]
    assert got == ["q q " + "a" * 200, "  ans"]


def test_count_and_position(spark):
    df = spark.createDataFrame([("aaaa", "aa"), ("abcabc", "bc"), ("xyz", "q")], "t string, k string")
    rows = df.select(count_occurrences("t", "k").alias("c"),
                     first_pos(F.col("t"), F.col("k")).alias("p")).collect()
    assert [(r.c, r.p) for r in rows] == [("aaaa".count("aa"), 0), (2, 1), (0, -1)]


def test_clean_random_unicode(spark):
    """Code points from many blocks: Latin-1, combining marks, Greek,
    general punctuation and spaces, CJK, fullwidth forms, superscripts,
    roman numerals, control characters."""
    rnd = random.Random(11)
    ranges = [(0x20, 0x7e), (0x00, 0x1f), (0x80, 0xff), (0x300, 0x36f), (0x370, 0x3ff),
              (0x2000, 0x206f), (0x2150, 0x218f), (0x3000, 0x303f), (0x4e00, 0x4e80),
              (0xff00, 0xffef), (0x660, 0x669), (0x1680, 0x1680), (0x85, 0x85)]
    texts = []
    for _ in range(400):
        chars = []
        for _ in range(rnd.randint(0, 40)):
            lo, hi = rnd.choice(ranges)
            chars.append(chr(rnd.randint(lo, hi)))
        if rnd.random() < 0.3:
            chars.insert(rnd.randint(0, len(chars)), rnd.choice(["http://x.y/Z", "https://a.b?c=1&d", "<i>"]))
        texts.append("".join(chars))
    assert _run(spark, texts, clean_text) == [py_clean(s) for s in texts]


def test_clean_supplementary_planes(spark):
    """Code points beyond the BMP (UTF-16 surrogate pairs on the JVM): emoji
    (not word), CJK extension B (letters), math alphanumerics (letters) and
    math digits (decimal digits, removed by the digit step)."""
    rnd = random.Random(13)
    ranges = [(0x1F600, 0x1F64F), (0x20000, 0x2007F), (0x1D400, 0x1D47F), (0x1D7CE, 0x1D7FF),
              (0x10400, 0x1044F), (0x20, 0x7E), (0x3000, 0x3000)]
    texts = []
    for _ in range(300):
        texts.append("".join(chr(rnd.randint(*rnd.choice(ranges))) for _ in range(rnd.randint(0, 30))))
    assert _run(spark, texts, clean_text) == [py_clean(s) for s in texts]
    comp = _run(spark, ["\U0001F600" * 250], lambda c: composite_text(c, c))
    assert comp == ["\U0001F600" * 250 + " " + "\U0001F600" * 250 + " " + "\U0001F600" * 200]
