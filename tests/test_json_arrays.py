"""JSON arrays and maps of arrays read in byte ranges, against whole-file
parses, with cuts in strings, escapes and keys."""

import json
import os
import random

import pytest

from curatio.sources import json_arrays as JA
from curatio.sources import readers as RD

PIECES = ['"', "\\", "}", "{", "[", "]", ",", ":", "\n", "a", "é", "中", '\\"', "\\\\", " ", "\U0001F600", '{"x":1}', "],["]


@pytest.fixture(params=[24, 57, 1 << 20])
def split_bytes(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def text(rng):
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 12)))


def put(folder, name, value, **how):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, **how)
    return path


HOW = [{"indent": 2}, {"ensure_ascii": False}, {"indent": 1, "ensure_ascii": False}, {"separators": (",", ":")}]


@pytest.mark.parametrize("how", HOW)
def test_array_of_objects_equals_whole_parse(spark, tmpdir_path, split_bytes, how):
    rng = random.Random(len(str(how)))
    rows = [{"question": text(rng), "answer": text(rng), "url": text(rng)} for _ in range(15)]
    path = put(tmpdir_path, "a.json", rows, **how)
    parts = spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions()
    got = RD.read_json_array(spark, path)
    assert got.columns == ["question", "answer", "url"]
    want = sorted((r["question"], r["answer"], r["url"]) for r in rows)
    assert sorted(map(tuple, got.collect())) == want
    assert parts > 5


def test_no_row_is_larger_than_an_element(spark, tmpdir_path):
    path = put(tmpdir_path, "a.json", [{"question": "q" * k, "answer": "", "url": "u"} for k in range(300)])
    longest = max(len(r.value) for r in JA._pieces(spark, path, JA.OBJECTS).collect())
    assert longest < 300 + 60


def test_nested_objects_and_empty_arrays(spark, tmpdir_path, split_bytes):
    rows = [{"question": "q", "answer": "a", "url": "u", "more": {"k": [{"x": "}"}, {}]}}, {}, {"question": None, "url": "v"}]
    path = put(tmpdir_path, "n.json", rows, indent=2)
    got = sorted(map(tuple, RD.read_json_array(spark, path).collect()), key=str)
    assert got == sorted([("q", "a", "u"), (None, None, None), (None, None, "v")], key=str)
    for k, empty in enumerate(("[]", " [ \n ] \n")):
        with open(os.path.join(tmpdir_path, f"e{k}.json"), "w") as f:
            f.write(empty)
        assert RD.read_json_array(spark, os.path.join(tmpdir_path, f"e{k}.json")).count() == 0
        assert RD.read_link_list(spark, os.path.join(tmpdir_path, f"e{k}.json")).count() == 0


@pytest.mark.parametrize("how", HOW)
def test_link_list_keeps_its_order(spark, tmpdir_path, split_bytes, how):
    rng = random.Random(3)
    links = [text(rng) for _ in range(30)]
    got = RD.read_link_list(spark, put(tmpdir_path, "l.json", links, **how)).orderBy("pos").collect()
    assert [(r.pos, r.url) for r in got] == list(enumerate(links))


@pytest.mark.parametrize("how", HOW)
def test_map_of_arrays_equals_whole_parse(spark, tmpdir_path, split_bytes, how):
    rng = random.Random(5)
    names = ["plain", 'with "quotes"', "brace}{", "back\\slash", "空", "last: empty", ""]
    sizes = [3, 0, 12, 1, 2, 0, 1]
    data = {n: [{"question": text(rng), "answer": text(rng), "url": str(k)} for k in range(s)] for n, s in zip(names, sizes)}
    path = put(tmpdir_path, "m.json", data, **how)
    want = sorted((d, j, k, r["question"], r["answer"], r["url"]) for j, (d, rows) in enumerate(data.items())
                  for k, r in enumerate(rows))
    assert sorted(map(tuple, RD.read_classified(spark, path).collect())) == want
    sizes = sorted((r.dept_pos, r.dept, r["count"]) for r in RD.category_sizes(spark, path).collect())
    assert sizes == [(j, d, len(rows)) for j, (d, rows) in enumerate(data.items())]


def test_empty_map_and_errors(spark, tmpdir_path):
    assert RD.read_classified(spark, put(tmpdir_path, "e.json", {})).count() == 0
    assert RD.category_sizes(spark, put(tmpdir_path, "f.json", {"a": [], "b": []})).count() == 2
    bad = os.path.join(tmpdir_path, "bad.json")
    for broken in ("{", '{"a": [{"question": "x"}', "not json", '{"a": [{"question": "x}]}', "[1, 2]"):
        with open(bad, "w") as f:
            f.write(broken)
        with pytest.raises(ValueError):
            RD.read_classified(spark, bad)
