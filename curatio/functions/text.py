"""String column functions (JVM-side, whole-stage-codegen friendly).

The cleaning chain reproduces Python ``re`` semantics with Java regex
classes written out explicitly, so the same patterns also run unchanged in
RE2-based engines (the SQL oracle):

* Python ``\\s`` (str patterns) is Unicode whitespace; Java's ``\\s`` is
  ASCII only, so whitespace is the explicit class :data:`WS`.
* Python ``\\w`` is letters, numbers and underscore: ``\\p{L}\\p{N}_``.
* Python ``\\d`` is decimal digits: ``\\p{Nd}``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace as Python's str.isspace() sees it.
WS = r"\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\p{Z}"
# URL pattern: the original alternation [a-zA-Z]|[0-9]|[$-_@.&+]|[!*(),]|%HH
# is exactly the class below ($-_ is the range U+0024..U+005F). The class
# form is linear; the alternation overflows the JVM stack on long URLs.
URL_RE = r"https?://[a-zA-Z!$-_]+"
TAG_RE = r"<[^>]+>"
NON_WORD_RE = r"[^\p{L}\p{N}_" + WS + r"]"
DIGITS_RE = r"\p{Nd}+"
WS_RUN_RE = r"[" + WS + r"]+"
STRIP_RE = r"^[" + WS + r"]+|[" + WS + r"]+$"


def _c(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(c)


def remove_urls(c) -> Column:
    return F.regexp_replace(_c(c), URL_RE, "")


def remove_tags(c) -> Column:
    return F.regexp_replace(_c(c), TAG_RE, "")


def remove_non_word(c) -> Column:
    return F.regexp_replace(_c(c), NON_WORD_RE, "")


def remove_digits(c) -> Column:
    return F.regexp_replace(_c(c), DIGITS_RE, "")


def collapse_ws(c) -> Column:
    return F.regexp_replace(_c(c), WS_RUN_RE, " ")


def ustrip(c) -> Column:
    """Strip Unicode whitespace at both ends (Python ``str.strip()``)."""
    return F.regexp_replace(_c(c), STRIP_RE, "")


def clean_text(c) -> Column:
    """lower -> URLs -> tags -> non-word -> digits -> whitespace runs -> strip.

    After the whitespace collapse every run is one U+0020, so ``trim``
    (spaces only) is an exact strip."""
    x = F.lower(_c(c))
    x = remove_urls(x)
    x = remove_tags(x)
    x = remove_non_word(x)
    x = remove_digits(x)
    x = collapse_ws(x)
    return F.trim(x)


def composite_text(question, answer, prefix_chars: int | None = 200) -> Column:
    """Classification text: question, question again, answer prefix (the
    whole answer when ``prefix_chars`` is None)."""
    q = F.coalesce(_c(question), F.lit(""))
    a = F.coalesce(_c(answer), F.lit(""))
    return F.concat_ws(" ", q, q, a if prefix_chars is None else F.substring(a, 1, prefix_chars))


def count_occurrences(text, needle) -> Column:
    """Non-overlapping occurrences (Python ``str.count``) of a non-empty needle."""
    t, k = _c(text), _c(needle)
    return ((F.length(t) - F.length(F.replace(t, k, F.lit("")))) / F.length(k)).cast("long")


def first_pos(text, needle) -> Column:
    """0-based first position, -1 when absent (Python ``str.find``)."""
    k = F.lit(needle) if isinstance(needle, str) else needle
    return F.position(k, _c(text)) - 1


def slice0(text, start, end) -> Column:
    """Python ``text[start:end]`` for 0-based column bounds, 0 <= start <= end."""
    return F.substr(_c(text), _c(start) + 1, _c(end) - _c(start))
