"""Pages -> links and QA rows (X1-X8, P1, U2), and captures.

Parsing runs per Arrow batch in ``mapInPandas`` (narrow: no shuffle; one
task per input split); every gate and filter after the parse is a JVM
expression."""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio import defaults as D
from curatio.functions.html import resolve, select_attr, select_texts
from curatio.operators.curate import extraction_gate
from curatio.operators.util import ship_by_value, spread

LINK_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("pos", T.IntegerType()),
    T.StructField("href", T.StringType()), T.StructField("link", T.StringType())])
QA_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()), T.StructField("url", T.StringType())])


def page_links(pages: DataFrame, selector: str = D.LINK_SELECTOR,
               substring: str | None = D.LINK_SUBSTRING, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html",
               partitions: int | None = None) -> DataFrame:
    """X1 + X2 + P1 + U2: one row per matching anchor, document order kept
    in ``pos``, duplicates kept; ``link`` is the href resolved against the
    page URL. Anchors without ``href`` are skipped (the original drops the
    whole page then). The substring filter runs in the JVM on ``link``
    (the browser attribute the original tests is the resolved URL)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for pid, url, html in zip(b[id_col], b[url_col], b[html_col]):
                for pos, href in enumerate(select_attr(html, selector, "href")):
                    if href is not None:
                        rows.append((pid, pos, href, resolve(url, href)))
            yield pd.DataFrame(rows, columns=["page_id", "pos", "href", "link"])

    out = spread(pages.select(id_col, url_col, html_col), partitions).mapInPandas(parse, LINK_SCHEMA)
    if substring:
        out = out.filter(F.col("link").contains(substring))
    return out


def page_qa(pages: DataFrame, question_selector: str = D.QUESTION_SELECTOR,
            answer_selector: str = D.ANSWER_SELECTOR, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html",
            min_question: int = D.EXTRACT_MIN_QUESTION,
            min_answer: int = D.EXTRACT_MIN_ANSWER,
            partitions: int | None = None) -> DataFrame:
    """question = text of the first question-selector match, answer =
    text of the first answer-selector match; both must exist, then the
    extraction length gate. Output: page_id, question, answer, url."""
    sels = {"q": question_selector, "a": answer_selector}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            qs, ans = [], []
            for html in b[html_col]:
                r = select_texts(html, sels)
                qs.append(r["q"])
                ans.append(r["a"])
            yield pd.DataFrame({"page_id": b[id_col], "question": qs, "answer": ans,
                                "url": b[url_col]})

    out = spread(pages.select(id_col, url_col, html_col), partitions).mapInPandas(parse, QA_SCHEMA)
    return out.filter(F.col("question").isNotNull() & F.col("answer").isNotNull()
                      & extraction_gate("question", "answer", min_question, min_answer))


# ---------------------------------------------------------------- captures

def decode_body(body_col: str = "body", charset: str = D.PAGE_CHARSET, spark=None):
    """Bytes -> text with the page charset, invalid bytes -> U+FFFD.

    JVM path (built-in ``decode``) when the session allows any Java charset
    with replacement of malformed input (``spark.sql.legacy.javaCharsets``
    and ``spark.sql.legacy.codingErrorAction`` both true); otherwise an Arrow
    pandas UDF with Python's codec (Spark's ``decode`` rejects GB18030 and
    raises on malformed bytes by default)."""
    if spark is not None:
        flags = [spark.conf.get(k, "false").lower() == "true"
                 for k in ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")]
        if all(flags):
            return F.decode(F.col(body_col), charset)

    @F.pandas_udf(T.StringType())
    def _decode(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else bytes(b).decode(charset, errors="replace"))

    return _decode(F.col(body_col))


def deciding_captures(captures: DataFrame, url_col: str = "url", attempt_col: str = "attempt",
                      status_col: str = "status", error_col: str = "error",
                      max_attempts: int = D.MAX_ATTEMPTS, ok_status: int = D.OK_STATUS,
                      retryable_errors=("client", "timeout")) -> DataFrame:
    """The capture that decides each URL.

    Attempts are taken in order, at most ``max_attempts``. A capture with
    ``status == ok`` and no error decides (kept); a non-ok status or a
    retryable error moves on; any other error ends the URL (dropped). URLs
    whose attempts run out are dropped. ``row_number() <= max_attempts`` is
    planned with a partial WindowGroupLimit, so a URL with a huge retry log
    is cut map-side. ``try_no`` is the 1-based position of the deciding
    capture among the URL's attempts."""
    w = Window.partitionBy(url_col).orderBy(attempt_col)
    first = (captures.withColumn("_try", F.row_number().over(w))
             .filter(F.col("_try") <= max_attempts))
    err = F.col(error_col)
    ok = (F.col(status_col) == ok_status) & err.isNull()
    fatal = err.isNotNull() & ~err.isin(*retryable_errors)
    # earliest deciding attempt of the URL: a second window over the same
    # partitioning (no join back, no further exchange)
    decider = F.min(F.when(ok | fatal, F.struct(F.col("_try").alias("t"), ok.alias("ok")))) \
        .over(Window.partitionBy(url_col))
    out = first.withColumn("_d", decider)
    out = out.filter((F.col("_try") == F.col("_d.t")) & F.col("_d.ok"))
    return out.drop("_d").withColumnRenamed("_try", "try_no")


ship_by_value("curatio.functions.html", __name__)
