"""The file-to-file entry points end to end on literal inputs."""

import json
import os

from curatio import defaults as D
from curatio.operators.lexicon import lexicon_from_dict
from curatio.plans import jobs

PAGE = ('<div class="clearfix"><h1>{q}</h1></div>'
        '<div id="xywy_2024"><p>{a}</p></div>'
        '<div class="ksAll-list"><div class="fl"><a href="/wenda/{i}.htm">x</a></div></div>')


def test_entry_points_end_to_end(spark, tmpdir_path):
    rows = [
        (0, "https://site.example/q/0", PAGE.format(q="头痛发烧怎么办", a="多喝水多休息，必要时去医院检查一下。", i=0)),
        (1, "https://site.example/q/1", PAGE.format(q="骨折以后怎么护理", a="固定患处并及时就医，遵医嘱进行康复训练。", i=1)),
        (2, "https://site.example/q/1", PAGE.format(q="重复的页面", a="这一行的网址与上一行相同，应当被去重。", i=2)),
        (3, "https://site.example/q/3", PAGE.format(q="孩子咳嗽", a="请拨打咨询电话12345获取帮助，谢谢您。", i=3)),
        (4, "https://site.example/q/4", PAGE.format(q="无关问题", a="今天的天气很好，适合出去散步走走。", i=4)),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = tmpdir_path
    assert jobs.links(pages, os.path.join(out, "links"))
    links = spark.read.json(os.path.join(out, "links")).collect()
    assert sorted(r.url for r in links) == [f"https://site.example/wenda/{i}.htm" for i in range(5)]

    assert jobs.extract(pages, os.path.join(out, "raw"))
    raw = jobs.read_raw(spark, os.path.join(out, "raw"))
    assert raw.count() == 4  # the repeated URL is kept once (first page)

    lex = lexicon_from_dict(spark, {"内科": ["头痛", "发烧"], "外科": ["骨折"], "儿科": ["孩子", "咳嗽"],
                                    "其他科": []})
    classified = jobs.classify_corpus(spark, raw, lex, out)
    labels = {r.question: r.label for r in classified.collect()}
    assert labels == {"头痛发烧怎么办": "内科", "骨折以后怎么护理": "外科", "孩子咳嗽": "儿科",
                      "无关问题": D.FALLBACK_CATEGORY}
    stats = [r.value for r in spark.read.text(os.path.join(out, "classification_stats")).coalesce(1).collect()]
    order = list(dict.fromkeys(r.label for r in classified.orderBy("pos").collect()))
    assert stats == ["分类统计信息:", *[f"{label}: 1条" for label in order]] and len(order) == 4

    records = jobs.convert_corpus(spark, classified, out, cap=5000, seed=42).collect()
    assert len(records) == 3  # the reject term drops the 儿科 answer
    assert sorted(int(r.id.rsplit("_", 1)[1]) for r in records) == [0, 1, 2]
    conv = records[0].conversations
    assert [t["from"] for t in conv] == ["user", "assistant"]
    cstats = {(r.label, r.is_total): (r.original, r.filtered, r.final)
              for r in spark.read.json(os.path.join(out, "conversion_stats")).collect()}
    assert cstats[(None, True)] == (4, 3, 3)

    rep = {r.label: r["count"] for r in jobs.report(classified).collect()}
    assert sum(rep.values()) == 4


def test_merge_parts_job(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "part_0.jsonl")
    with open(p, "w") as f:
        f.write(json.dumps({"question": "q", "answer": "a", "url": "u"}) + "\n")
        f.write("broken\n")
        f.write(json.dumps({"question": "q2", "answer": "a2", "url": "u"}) + "\n")
    assert jobs.merge(spark, [p], os.path.join(tmpdir_path, "merged"))
    got = [r.answer for r in spark.read.json(os.path.join(tmpdir_path, "merged")).collect()]
    assert got == ["a"]


def test_command_line(spark, tmpdir_path):
    from curatio.__main__ import main
    pages = spark.createDataFrame(
        [(0, "https://site.example/q/0", PAGE.format(q="头痛怎么办", a="多喝水多休息，必要时去医院检查。", i=0))],
        "page_id long, url string, html string")
    pages.write.parquet(os.path.join(tmpdir_path, "pages"))
    lex = os.path.join(tmpdir_path, "lex.json")
    with open(lex, "w", encoding="utf-8") as f:
        json.dump({"内科": ["头痛"], "其他科": []}, f, ensure_ascii=False)
    assert main(["extract", "--pages", os.path.join(tmpdir_path, "pages"), "--out", os.path.join(tmpdir_path, "raw")]) == 0
    assert main(["classify", "--raw", os.path.join(tmpdir_path, "raw"), "--lexicon", lex,
                 "--out", os.path.join(tmpdir_path, "p")]) == 0
    assert main(["convert", "--classified", os.path.join(tmpdir_path, "p", "classified"),
                 "--out", os.path.join(tmpdir_path, "p")]) == 0
    recs = spark.read.json(os.path.join(tmpdir_path, "p", "conversations")).collect()
    assert [r.id for r in recs] == ["内科_0"]
    assert main(["report", "--classified", os.path.join(tmpdir_path, "p", "classified")]) == 0


def test_merge_skips_urls_of_earlier_runs(spark, tmpdir_path):
    first = os.path.join(tmpdir_path, "part_a.jsonl")
    with open(first, "w") as f:
        f.write(json.dumps({"question": "q", "answer": "a", "url": "u1"}) + "\n")
    assert jobs.merge(spark, [first], os.path.join(tmpdir_path, "run1"))
    second = os.path.join(tmpdir_path, "part_b.jsonl")
    with open(second, "w") as f:
        f.write(json.dumps({"question": "q2", "answer": "again", "url": "u1"}) + "\n")
        f.write(json.dumps({"question": "q3", "answer": "new", "url": "u9"}) + "\n")
    assert jobs.merge(spark, [second], os.path.join(tmpdir_path, "run2"),
                      previous=os.path.join(tmpdir_path, "run1"))
    got = [r.url for r in spark.read.json(os.path.join(tmpdir_path, "run2")).collect()]
    assert got == ["u9"]


def test_vectors_and_prototypes_from_files_change_labels(spark, tmpdir_path):
    from curatio.__main__ import main
    raw = os.path.join(tmpdir_path, "xywy_qa_1.json")
    with open(raw, "w", encoding="utf-8") as f:
        json.dump([{"question": "头痛怎么办", "answer": "多喝水多休息", "url": "u1"},
                   {"question": "头痛又来了", "answer": "多喝水多休息", "url": "u2"}], f, ensure_ascii=False)
    lex = os.path.join(tmpdir_path, "lex.json")
    with open(lex, "w", encoding="utf-8") as f:
        json.dump({"内科": ["头痛"], "外科": ["骨折"], "其他科": []}, f, ensure_ascii=False)
    spark.createDataFrame([("u1", [-9.0, 9.0])], "url string, embedding array<float>").write.parquet(
        os.path.join(tmpdir_path, "v"))
    spark.createDataFrame([("内科", [1.0, -1.0]), ("外科", [-1.0, 1.0])], "dept string, proto array<float>").write.parquet(
        os.path.join(tmpdir_path, "p"))

    def labels(out, *more):
        assert main(["classify", "--raw-dir", tmpdir_path, "--lexicon", lex, "--out", out, *more]) == 0
        return {r.url: r.label for r in spark.read.parquet(os.path.join(out, "classified")).collect()}

    assert labels(os.path.join(tmpdir_path, "a")) == {"u1": "内科", "u2": "内科"}
    assert labels(os.path.join(tmpdir_path, "b"), "--vectors", os.path.join(tmpdir_path, "v"), "--prototypes",
                  os.path.join(tmpdir_path, "p")) == {"u1": "外科", "u2": "内科"}


def test_ids_do_not_depend_on_splits(spark, tmpdir_path):
    """Sixteen parts of different sizes, split small and large: the same ids."""
    for k in range(16):
        with open(os.path.join(tmpdir_path, f"part_{k}.json"), "w") as f:
            for i in range(3 + 40 * (k % 3)):
                f.write(json.dumps({"question": f"q {k} {i}", "answer": "long enough answer", "url": f"u{k}-{i}"}) + "\n")
    from curatio.operators.lexicon import lexicon_from_dict
    lex, old, got = lexicon_from_dict(spark, {"a": ["q"], "z": []}), spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    try:
        for size in ("512", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            c = jobs.classify_corpus(spark, jobs.read_raw(spark, os.path.join(tmpdir_path, "part_*")), lex,
                                     os.path.join(tmpdir_path, f"out{size}"))
            recs = jobs.convert_corpus(spark, c, os.path.join(tmpdir_path, f"out{size}"), cap=50)
            got.append({r.id: r.conversations[0].value for r in recs.collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1] and len(got[0]) == 50
    order = [tuple(map(int, got[0][k].split()[1:])) for k in sorted(got[0], key=lambda s: int(s.split("_")[1]))]
    assert order == sorted(order)
