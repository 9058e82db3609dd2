"""S1-S8 readers and W1-W7 writers round-trip on literal fixtures."""

import json
import os
import time

import pytest

from curatio.sources import readers as RD
from curatio.sources import sinks as SK


def test_list_page_urls(spark):
    rows = RD.list_page_urls(spark, 1, 3, "https://list.example/list_all_%d.htm").collect()
    assert [r.url for r in rows] == [f"https://list.example/list_all_{i}.htm" for i in (1, 2, 3)]


def test_read_link_list(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "links.json")
    with open(p, "w") as f:
        json.dump(["u1", "u2", "u1"], f, indent=2)
    got = [(r.pos, r.url) for r in RD.read_link_list(spark, p).orderBy("pos").collect()]
    assert got == [(0, "u1"), (1, "u2"), (2, "u1")]


def test_bad_lines_and_merge(spark, tmpdir_path):
    p0 = os.path.join(tmpdir_path, "part_0.jsonl")
    p1 = os.path.join(tmpdir_path, "part_1.jsonl")
    with open(p0, "w") as f:
        f.write('{"question": "q1", "answer": "a1", "url": "u1"}\n')
        f.write("not json\n")
        f.write('{"question": "q2", "answer": "a2"}\n')
        f.write("[1]\n")
        f.write('{"question": "q3", "answer": "a3", "url": null}\n')
        f.write('{"question": "q4", "answer": "dup same part", "url": "u1"}\n')
    with open(p1, "w") as f:
        f.write('{"question": "q5", "answer": "other part", "url": "u1"}\n')
        f.write('{"question": "q6", "answer": "a6", "url": null}\n')
        f.write('{"question": "q7", "answer": "a7", "url": "u2"}\n')
    parts = RD.read_json_parts(spark, [p0, p1])
    assert parts.filter("is_bad").count() == 3
    merged = {r.url: r.answer for r in RD.merge_parts(parts).collect()}
    assert merged == {"u1": "a1", None: "a3", "u2": "a7"}


def test_schema_gate(spark):
    df = spark.createDataFrame([("q", "a"), (None, "a")], "question string, answer string")
    with pytest.raises(ValueError):
        RD.schema_gate(df)
    good, bad = RD.schema_gate(df, mode="quarantine")
    assert good.count() == 1 and bad.count() == 1


def test_json_array_and_newest(spark, tmpdir_path):
    for i, name in enumerate(["xywy_qa_1.json", "xywy_qa_2.json"]):
        p = os.path.join(tmpdir_path, name)
        with open(p, "w") as f:
            json.dump([{"question": f"q{i}", "answer": "a", "url": "u"}], f, indent=2)
        os.utime(p, (time.time() + i * 10, time.time() + i * 10))
    newest = RD.newest_file(spark, tmpdir_path, "xywy_qa_", ".json")
    assert newest.endswith("xywy_qa_2.json")
    assert RD.newest_file(spark, tmpdir_path, "xywy_qa_", ".json", by="name").endswith("xywy_qa_2.json")
    rows = RD.read_json_array(spark, newest).collect()
    assert [r.question for r in rows] == ["q1"]
    with pytest.raises(FileNotFoundError):
        RD.newest_file(spark, tmpdir_path, "classified_qa_", ".json")


def test_classified_map_reader(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "classified_qa_x.json")
    data = {"内科": [{"question": "q1", "answer": "a1", "url": "u1"},
                   {"question": "q2", "answer": "a2", "url": "u2"}],
            "外科": [], "儿科": [{"question": "q3", "answer": "a3", "url": "u3"}]}
    with open(p, "w", encoding="utf-8") as f:
        json.dump(data, f, ensure_ascii=False, indent=2)
    rows = RD.read_classified(spark, p).orderBy("dept_pos", "pos").collect()
    assert [(r.dept, r.question) for r in rows] == [("内科", "q1"), ("内科", "q2"), ("儿科", "q3")]
    sizes = [(r.dept, r["count"]) for r in RD.category_sizes(spark, p).orderBy("dept_pos").collect()]
    assert sizes == [("内科", 2), ("外科", 0), ("儿科", 1)]
    bad = os.path.join(tmpdir_path, "classified_qa_bad.json")
    with open(bad, "w") as f:
        f.write("{not json")
    with pytest.raises(ValueError):
        RD.read_classified(spark, bad)


def test_sinks_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([("q", "a", "u", "内科")], "question string, answer string, url string, label string")
    SK.write_classified(df, os.path.join(tmpdir_path, "cls"))
    back = spark.read.parquet(os.path.join(tmpdir_path, "cls")).collect()
    assert back[0].label == "内科"
    SK.write_stats(df, os.path.join(tmpdir_path, "stats"))
    lines = [r.value for r in spark.read.text(os.path.join(tmpdir_path, "stats")).collect()]
    assert lines == ["分类统计信息:", "内科: 1条"]
    empty = spark.createDataFrame([], "pos int, link string")
    assert SK.write_links(empty, os.path.join(tmpdir_path, "links")) is False
    assert not os.path.exists(os.path.join(tmpdir_path, "links"))
    assert SK.output_name("classified_qa_20240101_000000.json") == "20240101_000000"


def test_first_seen_order_across_splits_of_one_file(spark, tmpdir_path):
    """A large part file read in many splits: the first line per URL in
    (file, line) order still wins."""
    p = os.path.join(tmpdir_path, "part_big.jsonl")
    with open(p, "w") as f:
        for i in range(400):
            f.write(json.dumps({"question": f"q{i}", "answer": f"a{i}", "url": f"u{i % 37}"}) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
        parts = RD.read_json_parts(spark, [p])
        assert parts.rdd.getNumPartitions() > 5
        got = {r.url: r.question for r in RD.merge_parts(parts).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {f"u{j}": f"q{j}" for j in range(37)}


def test_malformed_lines_of_every_kind_are_bad(spark):
    from curatio.sources.readers import classify_json_lines
    lines = ['{"url":"u"}', '  {"url":null}  ', '{"url":"u"} trailing', '{"url":"u"}{"url":"v"}', '{"url":"u"},{"url":"v"}',
             "{'url':'u'}", '["url"]', '"url"', "", None, '{"url":"u"', '{"other":1}', '{"url":"u"}]', '{"url":"u"}] junk',
             '{"url":"u"}]]', '{"url":"u"}],[1', '{"url":"u"}, "s"], [']
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, line string")
    got = {r.k: r.is_bad for r in classify_json_lines(df, "line", "url STRING").collect()}
    assert [got[k] for k in range(len(lines))] == [False, False] + [True] * 15


def test_merge_takes_parts_by_number_and_by_given_order(spark, tmpdir_path):
    import os
    from curatio.sources.readers import merge_parts, read_json_parts
    paths = []
    for n in range(16):
        paths.append(os.path.join(tmpdir_path, f"part_{n}.jsonl"))
        with open(paths[-1], "w") as f:
            f.write(f'{{"question":"q{n}","answer":"a","url":"same"}}\n')
    first = lambda p: [r.question for r in merge_parts(read_json_parts(spark, p)).collect()]
    assert first(os.path.join(tmpdir_path, "part_*.jsonl")) == ["q0"]
    assert first(os.path.join(tmpdir_path, "part_1*.jsonl")) == ["q1"]
    assert first([paths[2], paths[10]]) == ["q2"]
    assert first([paths[10], paths[2]]) == ["q10"]


@pytest.mark.parametrize("folder", ["plain", "with space", "per%cent é"])
def test_given_order_of_any_path_holds(spark, tmpdir_path, folder, monkeypatch):
    at = os.path.join(tmpdir_path, folder)
    for name in ("z", "y", "deep/x"):
        path = os.path.join(at, f"{name}.jsonl")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(json.dumps({"question": name, "answer": "a", "url": "same"}) + "\n")

    def kept(parts):
        return [r.question for r in RD.merge_parts(RD.read_json_parts(spark, parts)).collect()]
    z, y, deep = (os.path.join(at, n) for n in ("z.jsonl", "y.jsonl", "deep"))
    assert kept([z, y]) == ["z"] and kept([y, z]) == ["y"]
    assert kept([deep, y, z]) == ["deep/x"] and kept([y, deep]) == ["y"]
    assert kept([z, deep + "/*.jsonl", y]) == ["z"] and kept(["file://" + z, y]) == ["z"]
