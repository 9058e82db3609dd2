"""Incremental page intake and exact first-seen dedup across batches."""

import json
import os
import random

import pytest
from conftest import SF001

from curatio.operators.curate import dedup_first_seen
from curatio.operators.pages import page_qa
from curatio.streaming.intake import (first_of_block, first_seen_so_far, json_part_lines, numbered_in_splits,
                                      stream_dedup, stream_first_seen, stream_page_qa)


def test_stream_page_qa_matches_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "pages")
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    pages.filter("page_id % 2 = 0").write.parquet(os.path.join(src, "a"))
    pages.filter("page_id % 2 = 1").write.parquet(os.path.join(src, "b"))
    out = os.path.join(tmpdir_path, "qa")
    q = stream_page_qa(spark, os.path.join(src, "*"), out, os.path.join(tmpdir_path, "ck"),
                       question_selector="article h1", answer_selector="article")
    q.awaitTermination(300)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = sorted(map(tuple, page_qa(pages, "article h1", "article").collect()))
    assert got == want and len(got) == pages.count()


def test_stream_dedup_first_seen_across_batches(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "parts")
    os.makedirs(src)
    with open(os.path.join(src, "part_0.jsonl"), "w") as f:
        f.write('{"question": "q1", "answer": "a1", "url": "u1"}\n')
        f.write('{"question": "q2", "answer": "dup", "url": "u1"}\n')
        f.write("garbage\n")
        f.write('{"question": "q3", "answer": "a3", "url": "u2"}\n')
    target = os.path.join(tmpdir_path, "merged")
    ck = os.path.join(tmpdir_path, "ck")
    stream_dedup(json_part_lines(spark, src), target, ck).awaitTermination(300)
    with open(os.path.join(src, "part_1.jsonl"), "w") as f:
        f.write('{"question": "q4", "answer": "late dup", "url": "u2"}\n')
        f.write('{"question": "q5", "answer": "a5", "url": "u3"}\n')
    stream_dedup(json_part_lines(spark, src), target, ck).awaitTermination(300)
    got = {r.url: r.answer for r in spark.read.parquet(target).collect()}
    assert got == {"u1": "a1", "u2": "a3", "u3": "a5"}


def test_dedup_batch_replay_is_idempotent(spark, tmpdir_path):
    """A micro-batch replayed after a failure (same batch id, partial output
    already written) gives the same result: its own folder is replaced and
    not counted as seen."""
    from curatio.streaming.intake import dedup_batch
    target = os.path.join(tmpdir_path, "merged")
    b0 = spark.createDataFrame([("p0", 0, "u1", "a1"), ("p0", 1, "u2", "a2")],
                               "part string, line long, url string, answer string")
    b1 = spark.createDataFrame([("p1", 0, "u2", "late"), ("p1", 1, "u3", "a3")],
                               "part string, line long, url string, answer string")
    dedup_batch(b0, 0, target)
    dedup_batch(b1.limit(1), 1, target)   # a partial first attempt of batch 1
    dedup_batch(b1, 1, target)            # the replay
    dedup_batch(b1, 1, target)            # and once more
    got = sorted((r.url, r.answer) for r in spark.read.parquet(target).collect())
    assert got == [("u1", "a1"), ("u2", "a2"), ("u3", "a3")]


def test_batch_reads_touched_buckets_only(spark, tmpdir_path):
    """A bucket that no key of the batch falls into isn't read: an unreadable
    file in it does no harm."""
    from curatio.streaming.intake import dedup_batch
    target = os.path.join(tmpdir_path, "merged")
    ddl = "part string, line long, url string, answer string"
    dedup_batch(spark.createDataFrame([("p", i, f"u{i}", "a") for i in range(40)], ddl), 0, target)
    one = spark.createDataFrame([("p", 0, "u3", "late"), ("p", 1, "u3", "again")], ddl)
    bucket = one.selectExpr("pmod(xxhash64(url), 64) b").first().b
    other = next(d for d in sorted(os.listdir(target)) if d.startswith("bucket=") and d != f"bucket={bucket}")
    broken = os.path.join(target, other, "batch_id=7")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    dedup_batch(one, 1, target)
    got = spark.read.option("basePath", target).parquet(os.path.join(target, f"bucket={bucket}")).filter("url = 'u3'")
    assert [r.answer for r in got.collect()] == ["a"]


def write_part(folder, k, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"part_{k}.jsonl"), "w") as f:
        f.writelines(line + "\n" for line in rows)


def qa_line(question, url):
    return json.dumps({"question": question, "answer": "a", "url": url})


def test_keyed_state_gives_the_batch_result_with_late_parts(spark, tmpdir_path):
    """Parts come out of order and in several runs; the result is that of one
    pass over all parts in number order. Null urls are one key."""
    src, target, ck = (os.path.join(tmpdir_path, n) for n in ("parts", "seen", "ck"))
    rng = random.Random(5)
    parts = {k: [qa_line(f"q{k}-{i}", rng.choice([None, "hot", f"u{rng.randrange(12)}"])) for i in range(15)] + ["garbage", ""]
             for k in (1, 2, 10)}
    want = {}
    for k in (1, 2, 10):
        for line in parts[k][:15]:
            row = json.loads(line)
            want.setdefault(row["url"], row["question"])
    emitted = 0
    for k in (10, 1, 2):
        write_part(src, k, parts[k])
        stream_first_seen(json_part_lines(spark, src), target, ck).awaitTermination(300)
        rows = spark.read.parquet(target).count()
        assert rows >= emitted
        emitted = rows
    stream_first_seen(json_part_lines(spark, src), target, ck).awaitTermination(300)      # nothing new: nothing emitted
    assert spark.read.parquet(target).count() == emitted <= 2 * len(want)
    got = {r.url: r.question for r in first_seen_so_far(spark, target).collect()}
    assert got == want
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("RocksDBStateStoreProvider") is False


def test_keyed_state_reads_no_history(spark, tmpdir_path):
    """What an earlier run emitted isn't read by the next: it may be unreadable."""
    src, target, ck = (os.path.join(tmpdir_path, n) for n in ("parts", "seen", "ck"))
    write_part(src, 0, [qa_line("q0", "u0"), qa_line("q1", "u1")])
    stream_first_seen(json_part_lines(spark, src), target, ck).awaitTermination(300)
    old = {f for f in os.listdir(target) if f.endswith(".parquet")}
    for f in old:
        with open(os.path.join(target, f), "w") as out:
            out.write("not parquet")
    write_part(src, 1, [qa_line("late", "u1"), qa_line("q2", "u2")])
    stream_first_seen(json_part_lines(spark, src), target, ck).awaitTermination(300)
    new = [os.path.join(target, f) for f in os.listdir(target) if f.endswith(".parquet") and f not in old]
    assert [r.question for r in spark.read.parquet(*new).collect()] == ["q2"]


def test_keyed_state_refuses_odd_positions(spark, tmpdir_path):
    lines = spark.readStream.schema("part long, line long, url string").json(tmpdir_path)
    with pytest.raises(ValueError):
        stream_first_seen(lines, tmpdir_path, tmpdir_path)


def test_hot_key_is_one_row_a_block_before_the_shuffle(spark):
    rows = [("p", i, "hot" if i % 3 else f"u{i}", str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "part string, line long, url string, answer string").coalesce(1)
    got = first_of_block(df, "url", "part", "line")
    assert got.filter("url = 'hot'").count() == 1 and got.count() == 101
    want = dedup_first_seen(df, ["url"], ["part", "line"])
    assert sorted(map(tuple, dedup_first_seen(got, ["url"], ["part", "line"]).collect())) == sorted(map(tuple, want.collect()))


def test_line_numbers_rise_whatever_the_splits(spark, tmpdir_path):
    """A part of many splits (cuts within and at the ends of lines, blank lines,
    letters of several bytes) has its lines numbered in their order."""
    from pyspark.sql import functions as F
    rng = random.Random(9)
    lines = ["é" * rng.randrange(0, 9) + f"#{i}" if rng.random() < .8 else "" for i in range(400)]
    path = os.path.join(tmpdir_path, "part_0.jsonl")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for cut in ("37", "64", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
            raw = spark.read.option("lineSep", "\n").text(path).select(
                F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("line"), "value")
            if cut != "1000000":
                assert raw.select("line").distinct().count() > 20
            got = numbered_in_splits(raw).collect()
            assert len({r.line for r in got}) == len(lines)
            assert [r.value for r in sorted(got, key=lambda r: r.line)] == lines
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
