"""The regex tokenizer of the page helper equals the stdlib tokenizer
(``html.parser`` with ``convert_charrefs``) on random tricky HTML: both
drive the same open-element handler, so any difference is a tokenizing
difference."""

import random
from html.parser import HTMLParser

from curatio.functions import html as H


class _StdlibDriven(HTMLParser):
    """Feeds the helper's handler from the stdlib tokenizer."""

    def __init__(self, handler):
        super().__init__(convert_charrefs=True)
        self.h = handler

    def handle_starttag(self, tag, attrs):
        self.h.handle_starttag(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.h.handle_startendtag(tag, attrs)

    def handle_endtag(self, tag):
        self.h.handle_endtag(tag)

    def handle_data(self, data):
        self.h.handle_data(data)

    def handle_comment(self, data):
        self.h.end_node()

    handle_decl = handle_pi = unknown_decl = handle_comment


def stdlib_select(html, selectors):
    h = H._PageParser(selectors, None, None)
    p = _StdlibDriven(h)
    p.feed(html)
    p.close()
    h.finish()
    return {k: h.done.get(k) for k in selectors}


PIECES = ["<div class='a b'>", "<DIV CLASS=a>", "</div>", "<p>", "</p>", "<b>", "</B>", "<br>", "<br/>",
          "<span id=x>", "</span>", "<article>", "</article>", "<h1>", "</h1>", "text", " more text ",
          "&amp;", "&quot;q&quot;", "&amp", "&lt;", "a < b", "x<3", "<!-- c </p> -->", "<!DOCTYPE html>",
          "<script>var t=\"</p>\";</script>", "<style>p{}</style>", "<a href=\"/x?a=1&amp;b=2\">l</a>",
          "<img src=x alt='a>b'>", "\n", "\t", "中文", "<li>", "<ul>", "</ul>", "<p class=\"a\">",
          "<template><i>t</i></template>", "<?xml x?>"]


def test_tokenizer_equals_stdlib_on_random_html():
    rnd = random.Random(2024)
    selectors = {"a": "div p", "b": ".a", "c": "#x", "d": "article h1", "e": "ul li", "f": "div .b"}
    for _ in range(600):
        html = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 30)))
        got = H.select_texts(html, selectors)
        want = stdlib_select(html, selectors)
        assert got == want, html


def stdlib_attrs(html, selector, attr="href"):
    h = H._PageParser({}, selector, attr)
    p = _StdlibDriven(h)
    p.feed(html)
    p.close()
    h.finish()
    return h.attrs_found


def test_attribute_extraction_equals_stdlib():
    rnd = random.Random(7)
    for _ in range(1500):
        html = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 40)))
        for sel in ("a", "div a", "img", ".a a"):
            assert H.select_attr(html, sel, "href") == stdlib_attrs(html, sel, "href"), html
        assert H.select_attr(html, "img", "alt") == stdlib_attrs(html, "img", "alt"), html


def test_literal_pages():
    """Hand-worked texts."""
    text = lambda html, sel="div": H.select_texts(html, {"t": sel})["t"]
    assert text("<div><p title=it's>Hello there</p><p>don't stop</p></div>") == "Hello theredon't stop"
    assert text("<div><span><template>gone</span>kept</div>") == "kept"
    assert text("<div>5 < 10 mg</div>") == "5 < 10 mg"
    assert text("<div> a &lt; b <!-- c --> d </div>") == "a < bd"
    assert text("<div><ruby>kan<rp>(</rp><rt>ji</rt><rp>)</rp></ruby> x</div>") == "kanx"
    assert text("<div title='a>b' class=\"c>d\">in</div>") == "in"
    assert text("<div><script>x</script>y<style>z</style></div>") == "y"
    assert H.select_attr("<a href=/x/>l</a><a href=>m</a><a href='/y'/>", "a") == ["/x/", None, "/y"]
