"""Page parsing; X3 capture choice; X4 decoding."""

from pyspark.sql import functions as F

from curatio.functions.html import select_attr, select_texts
from curatio.operators.pages import decode_body, deciding_captures, page_links, page_qa

PAGE = (
    '<html><head><title>t</title><script>var t="</p>";</script><style>p{x:1}</style></head>'
    '<body><div class="ksAll-list"><div class="fl x"><a href="/wenda/1.htm">one</a>'
    '<a href="https://h.example/other.htm">two</a><a>no href</a>'
    '<a href="/wenda/1.htm">dup</a></div></div>'
    '<div class="clearfix top"><span>x</span><h1>  头痛怎么办 &amp; 发烧 </h1></div>'
    '<div id="xywy_2024"><p><b>  建议 <br><p>多喝水 <!-- c --> 休息</p>'
    '<script>ignored()</script><p>&quot;注意&quot;</div><footer>f</footer></body></html>'
)


def test_select_texts_semantics():
    r = select_texts(PAGE, {"q": ".clearfix h1", "a": "#xywy_2024"})
    assert r == {"q": "头痛怎么办 & 发烧", "a": '建议多喝水休息"注意"'}
    assert select_texts(PAGE, {"q": ".missing h1"})["q"] is None


def test_select_attr_order_dups_and_missing_href():
    got = select_attr(PAGE, ".ksAll-list .fl a")
    assert got == ["/wenda/1.htm", "https://h.example/other.htm", None, "/wenda/1.htm"]


def test_page_operators(spark):
    pages = spark.createDataFrame(
        [(1, "https://site.example/list_1.htm", PAGE),
         (2, "https://site.example/list_2.htm", "<html><body><h1>no answer</h1></body></html>"),
         (3, "https://site.example/x", '<div class="clearfix"><h1>Q</h1></div><div id="xywy_2024">short</div>')],
        "page_id long, url string, html string")
    links = page_links(pages).orderBy("page_id", "pos").collect()
    assert [(r.pos, r.link) for r in links] == [(0, "https://site.example/wenda/1.htm"),
                                                 (3, "https://site.example/wenda/1.htm")]
    qa = page_qa(pages).collect()
    assert [(r.page_id, r.question) for r in qa] == [(1, "头痛怎么办 & 发烧")]


def test_decode_gb18030(spark):
    good = "头痛abc".encode("gb18030")
    bad = bytes.fromhex("CDB7FFFF61626381")
    df = spark.createDataFrame([(good,), (bad,), (None,)], "body binary")
    got = [r[0] for r in df.select(decode_body("body")).collect()]
    assert got == ["头痛abc", bad.decode("gb18030", errors="replace"), None]
    assert got[1] == "头��abc�"


def test_deciding_captures(spark):
    rows = [
        ("first200", 0, 200, None),
        ("retry", 0, 500, None), ("retry", 1, 200, None),
        ("late", 0, 500, None), ("late", 1, 500, None), ("late", 2, 500, None), ("late", 3, 200, None),
        ("retry_err", 0, None, "timeout"), ("retry_err", 1, 200, None),
        ("fatal", 0, None, "boom"), ("fatal", 1, 200, None),
        ("empty_then_ok", 0, 200, None), ("empty_then_ok", 1, 200, None),
    ]
    cap = spark.createDataFrame(rows, "url string, attempt int, status int, error string")
    got = {r.url: r.attempt for r in deciding_captures(cap).collect()}
    # a 200 decides even if it parses to nothing later (no retry)
    assert got == {"first200": 0, "retry": 1, "retry_err": 1, "empty_then_ok": 0}
    assert F is not None


def test_batch_functions_ship_by_value():
    """Python workers must not need the package installed: the modules
    holding batch functions are pickled by value."""
    from pyspark import cloudpickle

    import curatio.operators.pages  # noqa: F401
    import curatio.operators.similarity  # noqa: F401
    reg = cloudpickle.list_registry_pickle_by_value()
    assert {"curatio.functions.html", "curatio.operators.pages",
            "curatio.operators.similarity"} <= set(reg)


def test_decode_gb18030_jvm_path(spark):
    """With the legacy charset flags on, the built-in JVM decode is used and
    agrees with Python's codec on good and malformed bytes."""
    samples = ["头痛abc".encode("gb18030"), bytes.fromhex("CDB7FFFF61626381"), "€ 中文".encode("gb18030")]
    df = spark.createDataFrame([(b,) for b in samples], "body binary")
    keys = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "true")
        col = decode_body("body", spark=spark)
        assert "pandas" not in str(col).lower()
        got = [r[0] for r in df.select(col).collect()]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == [b.decode("gb18030", errors="replace") for b in samples]
