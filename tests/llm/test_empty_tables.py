"""Every registered operator over tables without rows, and over documents of
nulls, empties, repeats and a very long text where they have no other such test."""

import os

import pytest
from pyspark.sql import functions as F

from curatio.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "embeddings", "pages", "conversations"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(os.path.join(d, f"{name}.parquet"))
    return d


@pytest.mark.parametrize("name", ["op4_arc_to_warc", "op5_fertility", "op7_bpe_automaton", "op8_license_scan"])
def test_empty_table_gives_no_rows(spark, empty, name):
    assert registry.QUERIES[name](spark, empty).count() == 0


def test_empty_documents_through_the_pipeline(spark, empty):
    import corpus_pipeline
    assert corpus_pipeline.run(spark, empty).count() == 0


@pytest.mark.parametrize("name", ["op5_fertility", "op8_license_scan", "op12_lattice_lm"])
def test_odd_documents_keep_their_rows(spark, tmp_path, name):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "no id at all"), (4, "word " * 60_000), (5, "the same"), (5, "the same"), (None, None)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES[name](spark, str(tmp_path))
    assert got.count() == len(rows)
    same = got.filter(F.col("doc_id") == 5).collect()
    assert len(same) == 2 and same[0] == same[1]
