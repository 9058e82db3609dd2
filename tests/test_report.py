"""Distribution report."""

import pytest

from curatio.operators.report import distribution, stats_lines


def test_distribution_ties_and_top(spark):
    rows = [("a",)] * 3 + [("b",)] * 3 + [("c",)] * 1 + [("d",)] * 5 + [("e",)] * 2 + [("f",)] * 2
    df = spark.createDataFrame(rows, "g string")
    out = sorted(distribution(df, "g").collect(), key=lambda r: r["rank"])
    assert [r.g for r in out] == ["d", "a", "b", "e", "f", "c"]
    assert [r.is_top for r in out] == [True] * 5 + [False]
    assert sum(r.percentage for r in out) == pytest.approx(100.0, abs=1e-4)
    assert out[0].percentage == pytest.approx(5 * 100 / 16, abs=1e-6)


def test_fewer_than_five_and_empty(spark):
    df = spark.createDataFrame([("x",), ("y",)], "g string")
    out = distribution(df, "g").collect()
    assert all(r.is_top for r in out) and len(out) == 2
    empty = spark.createDataFrame([], "g string")
    assert distribution(empty, "g").collect() == []


def test_stats_lines(spark):
    df = spark.createDataFrame([("内科",), ("内科",), ("外科",)], "g string")
    assert sorted(r.value for r in stats_lines(df, "g").collect()) == ["内科: 2条", "外科: 1条"]


def test_stats_file_has_a_header_and_first_appearance_order(spark, tmpdir_path):
    from curatio.sources.sinks import write_stats
    rows = [(k, g) for k, g in enumerate("cabbcacd")]
    df = spark.createDataFrame(rows, "k long, g string").repartition(5)
    write_stats(df, f"{tmpdir_path}/s", "g", order_col="k")
    lines = [r.value for r in spark.read.text(f"{tmpdir_path}/s").coalesce(1).collect()]
    assert lines == ["分类统计信息:", "c: 3条", "a: 2条", "b: 2条", "d: 1条"]
    write_stats(df.limit(0), f"{tmpdir_path}/e", "g")
    assert [r.value for r in spark.read.text(f"{tmpdir_path}/e").collect()] == ["分类统计信息:"]
