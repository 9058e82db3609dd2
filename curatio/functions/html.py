"""Small HTML helper for the page batch functions.

Per page: one pass of a regex tokenizer (the chunking rules of the stdlib
``html.parser``: entities decoded per text chunk, a ``<`` that starts no tag
is its own text chunk, script/style bodies are raw text) with an
open-element stack.
Selectors are descendant chains of compound selectors (``tag``, ``.class``,
``#id``, e.g. ``.clearfix h1``). Text of an element is every text node
inside it stripped, empties dropped, joined without a separator; adjacent
chunks are one node, tags and comments end it; comments and the text of
script, style, template and ruby annotations are not text; entities are
decoded."""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urljoin

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}
# Elements whose text does not count as text of what holds them.
NO_TEXT = {"script", "style", "template", "rt", "rp"}
# Start tags that implicitly close an open <p>.
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer",
            "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav",
            "ol", "p", "pre", "section", "table", "ul"}
SELF_CLOSING_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
                         "option": {"option"}, "tr": {"tr"}, "td": {"td", "th"},
                         "th": {"td", "th"}}
_COMPOUND = re.compile(r"([a-zA-Z0-9_-]+)|\.([a-zA-Z0-9_-]+)|#([a-zA-Z0-9_-]+)")
# comment | declaration | processing instruction | start/end tag
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
                    r"|<(/?)([a-zA-Z][^\s/>]*)"
                    # a quote opens a value only right after the equals sign
                    r"((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*|(?=>))|[^>=])*+)>", re.S)
_ATTR = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_CDATA = {"script", "style"}  # bodies are raw text: no tags inside


def parse_selector(sel: str) -> list[tuple[str | None, frozenset, str | None]]:
    chain = []
    for part in sel.split():
        tag, classes, ident = None, set(), None
        for t, c, i in _COMPOUND.findall(part):
            if t:
                tag = t.lower()
            elif c:
                classes.add(c)
            else:
                ident = i
        chain.append((tag, frozenset(classes), ident))
    return chain


def _match_one(comp, node) -> bool:
    tag, classes, ident = comp
    ntag, nclasses, nid = node
    return ((tag is None or tag == ntag) and classes <= nclasses
            and (ident is None or ident == nid))


def matches(chain, stack) -> bool:
    """``stack[-1]`` is the candidate; ancestors are ``stack[:-1]``."""
    if not chain or not _match_one(chain[-1], stack[-1]):
        return False
    i = len(stack) - 2
    for comp in reversed(chain[:-1]):
        while i >= 0 and not _match_one(comp, stack[i]):
            i -= 1
        if i < 0:
            return False
        i -= 1
    return True


class _PageParser:
    def __init__(self, first_selectors: dict, all_selector, attr: str | None):
        self.first = {k: parse_selector(v) for k, v in first_selectors.items()}
        self.all_chain = parse_selector(all_selector) if all_selector else None
        self.attr = attr
        self.stack: list[tuple] = []       # (tag, classes, id)
        self.open_caps: list[list] = []    # [name, depth, chunks]
        self.done: dict[str, str] = {}
        self.attrs_found: list[str | None] = []
        self.hidden = 0                    # open elements without text
        self.node: list[str] = []          # chunks of the current text node

    def _pop_to(self, idx: int):
        while len(self.stack) > idx:
            if self.stack.pop()[0] in NO_TEXT:
                self.hidden -= 1
            depth = len(self.stack)
            keep = []
            for cap in self.open_caps:
                if cap[1] > depth:
                    self.done[cap[0]] = "".join(cap[2])
                else:
                    keep.append(cap)
            self.open_caps = keep

    def _close_nearest(self, names) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in names:
                self._pop_to(i)
                return

    def handle_starttag(self, tag, attrs):
        self.end_node()
        a = dict(attrs)
        if tag in CLOSES_P:
            self._close_nearest({"p"})
        if tag in SELF_CLOSING_SIBLINGS and self.stack and self.stack[-1][0] in SELF_CLOSING_SIBLINGS[tag]:
            self._pop_to(len(self.stack) - 1)
        node = (tag, frozenset((a.get("class") or "").split()), a.get("id"))
        self.stack.append(node)
        for name, chain in self.first.items():
            if name not in self.done and all(c[0] != name for c in self.open_caps) \
                    and matches(chain, self.stack):
                self.open_caps.append([name, len(self.stack), []])
        if self.all_chain is not None and matches(self.all_chain, self.stack):
            self.attrs_found.append(a.get(self.attr))
        if tag in NO_TEXT:
            self.hidden += 1
        if tag in VOID:
            self._pop_to(len(self.stack) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.end_node()
        if tag in VOID:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop_to(i)
                return

    def handle_data(self, data):
        if not self.hidden:
            self.node.append(data)

    def end_node(self):
        s = "".join(self.node).strip()
        self.node = []
        if s:
            for cap in self.open_caps:
                cap[2].append(s)

    def _data(self, chunk: str):
        # a "<" that starts no tag is a text chunk of its own
        parts = chunk.split("<")
        if parts[0]:
            self.handle_data(unescape(parts[0]))
        for part in parts[1:]:
            self.handle_data("<")
            if part:
                self.handle_data(unescape(part))

    def feed(self, html: str):
        pos, n = 0, len(html)
        while pos < n:
            m = _TOKEN.search(html, pos)
            if m is None:
                self._data(html[pos:])
                break
            if m.start() > pos:
                self._data(html[pos:m.start()])
            pos = m.end()
            name = m.group(2)
            if name is None:
                self.end_node()
                continue  # comment, declaration, processing instruction
            tag = name.lower()
            if m.group(1):
                self.handle_endtag(tag)
                if self.all_chain is None and len(self.done) == len(self.first):
                    return  # every first match is complete: the rest cannot change it
                continue
            raw = m.group(3) or ""
            attrs, closed = [], raw.endswith("/")
            if raw.strip(" \t\n\r\f/"):
                for a in _ATTR.finditer(raw):
                    closed = closed and (a.group(4) is None or a.end() < len(raw))
                    v = a.group(2) if a.group(2) is not None else (
                        a.group(3) if a.group(3) is not None else a.group(4))
                    attrs.append((a.group(1).lower(), None if v is None else unescape(v)))
            if closed:
                self.handle_startendtag(tag, attrs)
            else:
                self.handle_starttag(tag, attrs)
            if tag in _CDATA:
                end = re.compile(r"</%s(?=[\t\n\r\f />])" % tag, re.I).search(html, pos)
                stop = end.start() if end else n
                if stop > pos:
                    self.handle_data(html[pos:stop])
                pos = stop

    def finish(self):
        self.end_node()
        self._pop_to(0)


def select_texts(html: str | None, selectors: dict[str, str]) -> dict[str, str | None]:
    """Text of the first element matching each selector (None when absent)."""
    if html is None:
        return {k: None for k in selectors}
    p = _PageParser(selectors, None, None)
    p.feed(html)
    p.finish()
    return {k: p.done.get(k) for k in selectors}


def select_attr(html: str | None, selector: str, attr: str = "href") -> list[str | None]:
    """Attribute of every element matching ``selector``, in document order."""
    if html is None:
        return []
    p = _PageParser({}, selector, attr)
    p.feed(html)
    p.finish()
    return p.attrs_found


def resolve(base: str | None, href: str) -> str:
    """Absolute URL of ``href`` against the page URL."""
    return urljoin(base or "", href)
