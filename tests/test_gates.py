"""Gates judged in the writing pass: one computation of the input, and an earlier
output that stays when a gate refuses the new one."""

import os

import pytest
from pyspark.sql import functions as F

from curatio.sources import sinks as SK

QA = "question string, answer string, url string"


def qa(spark, *rows):
    return spark.createDataFrame(list(rows), QA)


def names(folder):
    return sorted(os.listdir(folder))


def test_rows_are_computed_once(spark, tmpdir_path):
    ran = spark.sparkContext.accumulator(0)

    def count(blocks):
        for b in blocks:
            ran.add(b.num_rows)
            yield b
    df = spark.range(1000).select(*[F.col("id").cast("string").alias(c) for c in ("question", "answer", "url")])
    assert SK.write_parts(df.mapInArrow(count, df.schema), os.path.join(tmpdir_path, "out"))
    assert ran.value == 1000
    assert spark.read.json(os.path.join(tmpdir_path, "out")).count() == 1000


def test_refused_output_leaves_the_earlier_one(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    assert SK.write_parts(qa(spark, ("q", "a", "u")), out)
    assert SK.write_parts(qa(spark).filter("false"), out) is False
    assert [r.url for r in spark.read.json(out).collect()] == ["u"]
    assert SK.write_parts(qa(spark, ("q2", "a2", "u2")), out)
    assert [r.url for r in spark.read.json(out).collect()] == ["u2"]
    assert SK.write_parts(qa(spark).filter("false"), os.path.join(tmpdir_path, "none")) is False
    assert names(tmpdir_path) == ["out"]                      # nothing staged or set aside is left


def test_schema_gate_while_writing(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "classified")
    good = qa(spark, ("q", "a", "u"), ("q", "b", None)).withColumn("label", F.lit("x"))
    SK.write_classified(good, out, required=("question", "answer"))
    bad = qa(spark, ("q", None, "u"), ("q", "b", "u")).withColumn("label", F.lit("y"))
    with pytest.raises(ValueError, match="1 rows lack"):
        SK.write_classified(bad, out, required=("question", "answer"))
    got = spark.read.parquet(out)
    assert got.count() == 2 and {r.label for r in got.collect()} == {"x"}
    SK.write_classified(bad, out)                             # without required columns all rows pass
    assert {r.label for r in spark.read.parquet(out).collect()} == {"y"}
    assert names(tmpdir_path) == ["classified"]


def test_failed_job_leaves_the_earlier_output(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    SK.write_parts(qa(spark, ("q", "a", "u")), out)
    broken = qa(spark, ("q", "a", "u")).withColumn("url", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        SK.write_parts(broken, out)
    assert spark.read.json(out).count() == 1 and names(tmpdir_path) == ["out"]


def test_links_modes(spark, tmpdir_path):
    links = spark.createDataFrame([(0, "u0")], "pos int, link string")
    out = os.path.join(tmpdir_path, "links")
    assert SK.write_links(links, out)
    assert SK.write_links(links, out, mode="append") and spark.read.json(out).count() == 2
    assert SK.write_links(links.filter("false"), out) is False and spark.read.json(out).count() == 2
