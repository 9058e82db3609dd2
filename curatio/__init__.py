"""curatio: Spark-native curation of question/answer corpora.

Every operator is a function ``DataFrame -> DataFrame`` (or a small family
of them) built from the DataFrame API, so Catalyst plans the whole chain:
extract QA rows from stored pages, de-duplicate, clean text, score texts
against a category lexicon and category prototypes, label, filter for
quality, cap each category reproducibly, number the rows, emit conversation
records and report the category distribution.
"""

from curatio.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
__version__ = "0.1.0"
