"""Parameters of the registered queries over the driver's tables.

The tables hold en/de/fr/es prose, so the category lexicon used by the
checks is built from words of those languages (the medical lexicon of the
original is an input table a user supplies). ``THE`` is upper-case on
purpose: texts are lower-cased and keywords are not, so it never matches.
"""

TEST_LEXICON = {
    "en": ["the", "tion", "thtion", "ing"],
    "de": ["der", "und", "keit", "heit"],
    "fr": ["que", "eau", "ment", "les"],
    "es": ["ción", "ado", "los", "THE"],
    "other": [],
}
SPARSE_LEXICON = {"en": ["thtion"], "de": ["keit"], "fr": ["eau"], "es": ["ado"], "other": []}
TEST_MARKERS = ["ti", "ei"]
TEST_EXCLUSIONS = [("en", "de"), ("fr", "es")]
TEST_FALLBACK = "other"
# Reject terms are words of the data, so the filter has something to reject.
TEST_REJECT_TERMS = ["Nicht", "ción", "thtion"]
TEST_PROMPTS = [("en", "Answer in English."), ("de", "Antworte auf Deutsch.")]
TEST_CAP = 140
TEST_SEED = 42
QA_KEYS = ["conv_id", "turn"]
PAGE_QUESTION_SELECTOR = "article h1"
PAGE_ANSWER_SELECTOR = "article"
PAGE_LINK_SELECTOR = "nav a"
PAGE_LINK_SUBSTRING = "en"


def letter_model():
    """A deterministic stand-in for a text model: counts of four letters."""
    return lambda texts: [[float(t.count(c)) for c in "aeio"] for t in texts]
