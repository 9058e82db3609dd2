"""Default parameters.

Every literal the original pipeline hard-codes is a parameter here; the
operators take them as arguments so a caller can swap any of them.  The
category keyword lexicon itself (312 keywords) is NOT shipped: it is an
input table, loaded with :func:`curatio.operators.lexicon.lexicon_from_dict`
or :func:`curatio.operators.lexicon.read_lexicon`.
"""

from __future__ import annotations

# --- Fixed values: these must equal the original pipeline's for the same
# --- results. Stated plainly, in their original order.

# Category names in lexicon order (this order is the tie-break order).
CATEGORY_ORDER = [
    "内科", "外科", "妇产科", "皮肤科", "性病科", "儿科", "五官科", "中医科",
    "精神科", "心理科", "传染科", "整形美容科", "老年科", "男科", "生殖科", "其他科",
]
# Label given when the best blended score is not positive.
FALLBACK_CATEGORY = "其他科"
# Exclusion rules: when the winner is the first, the second's score is halved.
EXCLUSION_RULES = [("儿科", "老年科"), ("男科", "妇产科"), ("精神科", "心理科"), ("内科", "外科")]
EXCLUSION_FACTOR = 0.5
# Keyword weight: 1.0, x1.5 when longer than 2 characters, x1.3 when the
# keyword contains one of the markers.
WEIGHT_BASE = 1.0
WEIGHT_LONG_MIN_LEN = 2
WEIGHT_LONG_FACTOR = 1.5
WEIGHT_MARKERS = ["病", "炎"]
WEIGHT_MARKER_FACTOR = 1.3
# Early-position boost, related-keyword boost and its context radius.
EARLY_FACTOR = 1.5
RELATED_FACTOR = 1.2
CONTEXT_RADIUS = 10
QUESTION_MARK = "?"
# Blend of embedding similarity and keyword score.
SIMILARITY_WEIGHT = 0.7
KEYWORD_WEIGHT = 0.3
COSINE_EPS = 1e-8
# Composite classification text: question, question, answer prefix.
ANSWER_PREFIX_CHARS = 200
# Quality filter (converter): minimum lengths after strip, reject terms.
QUALITY_MIN_QUESTION = 1
QUALITY_MIN_ANSWER = 10
REJECT_TERMS = ["咨询电话", "热线", "QQ群", "微信号"]
# Extraction gate (crawler): len(question) > 1 and len(answer) > 10.
EXTRACT_MIN_QUESTION = 2
EXTRACT_MIN_ANSWER = 11
# Per-category cap and seed of the converter.
CAP_PER_CATEGORY = 5000
CAP_SEED = 42
# Page selectors and the link filter of the crawler.
QUESTION_SELECTOR = ".clearfix h1"
ANSWER_SELECTOR = "#xywy_2024"
LINK_SELECTOR = ".ksAll-list .fl a"
LINK_SUBSTRING = "wenda"
# Capture rules: at most 3 attempts per URL, the first 200 decides.
MAX_ATTEMPTS = 3
OK_STATUS = 200
# Input/output file naming.
RAW_PREFIX = "xywy_qa_"
RAW_SUFFIX = ".json"
CLASSIFIED_PREFIX = "classified_qa_"
CLASSIFIED_SUFFIX = ".json"
STATS_LINE_FORMAT = "%s: %d条"
STATS_HEADER = "分类统计信息:"
CONVERSATION_ROLES = ("user", "assistant")
TOP_SLICES = 5
PAGE_CHARSET = "gb18030"
