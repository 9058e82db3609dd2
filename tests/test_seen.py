"""The index of seen keys against a plain set, over runs and sessions."""

import os
import random

import pytest
from pyspark.sql import functions as F

from curatio.operators.seen import SeenKeys


def batch(spark, keys):
    return spark.createDataFrame([(k, f"text {i}") for i, k in enumerate(keys)], "url string, text string")


def test_runs_equal_a_set(spark, tmpdir_path):
    rng = random.Random(4)
    path, seen = os.path.join(tmpdir_path, "it's an index"), set()
    for _ in range(3):
        keys = [rng.choice([None, "", "hot", f"u{rng.randrange(40)}"]) for _ in range(50)]
        index = SeenKeys(spark, path, buckets=4)
        df = batch(spark, keys)
        got = sorted((r.url, r.text) for r in index.unseen(df).fillna("null").collect())
        want = sorted(("null" if k is None else k, f"text {i}") for i, k in enumerate(keys) if k not in seen)
        assert got == want
        index.add(df)
        index.add(df)                                        # a repeated run adds nothing
        seen |= set(keys)
        assert sorted(map(repr, (r.url for r in spark.table(index.table).collect()))) == sorted(map(repr, seen))
    spark.sql(f"DROP TABLE {index.table}")                   # a new session doesn't know the table, the folder stays
    again = SeenKeys(spark, path, buckets=4)
    assert again.unseen(batch(spark, sorted(map(str, seen - {None})))).count() == 0


def test_other_bucket_number_is_refused(spark, tmpdir_path):
    SeenKeys(spark, tmpdir_path, buckets=4).add(batch(spark, ["a"]))
    with pytest.raises(ValueError, match="4 buckets"):
        SeenKeys(spark, tmpdir_path, buckets=8)


def test_several_key_columns_and_empty_tables(spark, tmpdir_path):
    index = SeenKeys(spark, tmpdir_path, "a STRING, b BIGINT", buckets=3)
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 1), ("x", None)], "p string, q long")
    assert index.unseen(df, ["p", "q"]).count() == 4
    index.add(df.limit(0), ["p", "q"])
    index.add(df.filter("q = 1"), ["p", "q"])
    assert sorted(map(tuple, index.unseen(df, ["p", "q"]).collect()), key=repr) == [("x", 2), ("x", None)]
    assert index.unseen(df.limit(0), ["p", "q"]).count() == 0


def test_history_is_not_shuffled(spark, tmpdir_path):
    index = SeenKeys(spark, tmpdir_path, buckets=16)
    index.add(spark.range(500).select(F.concat(F.lit("u"), "id").alias("url")))
    df = batch(spark, ["u1", "new"])
    lines = index.seen(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lines[join].index("SortMergeJoin")
    side = next(i for i in range(join + 1, len(lines)) if lines[i][depth:depth + 3] == "+- ")
    keys, history = "\n".join(lines[join:side]), "\n".join(lines[side:])
    assert "Bucketed: true" in history and "Exchange" not in history
    assert "Exchange hashpartitioning" in keys and "FileScan" not in keys
    assert [r.url for r in index.seen(df).collect()] == ["u1"]
