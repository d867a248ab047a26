"""HTML extraction jobs over a pages table.

Pages are parsed inside ``mapInPandas`` tasks (one page -> N rows) with the
standard-library parser and a small tree builder. Tree rules:
void elements take no children; an end tag closes the nearest open element
of that name (unmatched end tags are ignored); **a block start tag (``p``,
``pre``, ``div``, ``h1``-``h6``, ``blockquote``, ``table`` ...) closes an open
``<p>``** (our rule for unclosed paragraphs, as in HTML parsers). Text of an element is
all descendant text except inside ``script``/``style``/``template``.
A page that fails to parse yields an ``error`` value, not a failed job.
"""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom import defaults as D

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Start tags that close an open <p> (as HTML parsers do).
CLOSES_P = frozenset("""address article aside blockquote details dialog div dl fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table
    ul""".split())
OPAQUE = frozenset(("script", "style", "template"))


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs=None, parent=None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent

    def iter(self):
        """Descendant elements in document order (a stack, so any depth will do)."""
        todo = [iter(self.children)]
        while todo:
            ch = next(todo[-1], None)
            if ch is None:
                todo.pop()
            elif isinstance(ch, Node):
                yield ch
                todo.append(iter(ch.children))

    def find(self, pred):
        return next((n for n in self.iter() if pred(n)), None)

    def find_all(self, tag):
        return [n for n in self.iter() if n.tag == tag]

    def text(self) -> str:
        """Text of the element, without that of opaque elements inside."""
        out, todo, opaque_ok = [], [iter(self.children)], self.tag in OPAQUE
        while todo:
            ch = next(todo[-1], None)
            if ch is None:
                todo.pop()
            elif isinstance(ch, str):
                out.append(ch)
            elif ch.tag not in OPAQUE or (opaque_ok and len(todo) == 1):
                todo.append(iter(ch.children))
        return "".join(out)

    def next_siblings(self):
        sibs = self.parent.children if self.parent is not None else []
        i = next(j for j, ch in enumerate(sibs) if ch is self)
        return sibs[i + 1:]

    def has_class(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]")
        self.stack = [self.root]

    def _pop_to(self, tag) -> bool:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return True
        return False

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._pop_to("p")
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)

    def handle_endtag(self, tag):
        self._pop_to(tag)

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


# --- per-page extractors (plain Python, unit-testable) --------------------

def extract_table_rows(root: Node, page_url: str, min_cells: int = 3, link_cell: int = 1,
                       text_cell: int = 2):
    """B1+B2: rows with >= min_cells cells whose link cell has an <a>."""
    rows = []
    for tr in root.find_all("tr"):
        cells = tr.find_all("td")
        if len(cells) < min_cells:
            continue
        a = cells[link_cell].find(lambda n: n.tag == "a")
        if a is None:
            continue
        href = a.attrs.get("href")
        rows.append((a.text().strip(), cells[text_cell].text().strip(),
                     urljoin(page_url, href) if href is not None else None))
    return rows


def extract_links(root: Node, page_url: str):
    """B7+B2: every <a href> resolved against the page URL, in order."""
    return [urljoin(page_url, a.attrs["href"]) for a in root.find_all("a") if "href" in a.attrs]


def first_text(root: Node, tag: str, default: str):
    """B3 shape: stripped text of the first ``tag`` element, else ``default``."""
    n = root.find(lambda x: x.tag == tag)
    return n.text().strip() if n is not None else default


def extract_examples(root: Node, header: str = "h3", marker: str = "Example"):
    """After the first ``header`` containing ``marker``, each following
    sibling <blockquote> up to the next ``header`` contributes the stripped
    text of its first descendant with class ``code``."""
    h = root.find(lambda n: n.tag == header and marker in n.text())
    out = []
    if h is None:
        return out
    for sib in h.next_siblings():
        if isinstance(sib, Node) and sib.tag == header:
            break
        if isinstance(sib, Node) and sib.tag == "blockquote":
            code = sib.find(lambda n: n.has_class("code"))
            if code is not None:
                out.append(code.text().strip())
    return out


def extract_description(root: Node):
    """Stripped <p> texts among the siblings after the first <h1>, up to
    a <pre>, joined by one space; no <h1> -> ''."""
    h1 = root.find(lambda n: n.tag == "h1")
    if h1 is None:
        return ""
    parts = []
    for sib in h1.next_siblings():
        if isinstance(sib, Node) and sib.tag == "pre":
            break
        if isinstance(sib, Node) and sib.tag == "p":
            parts.append(sib.text().strip())
    return " ".join(parts).strip()


ERROR = T.StructField("error", T.StringType())


# --- Spark jobs -----------------------------------------------------------

def _job(pages: DataFrame, id_col: str, html: str, url: str | None, schema: T.StructType, per_page):
    """``per_page`` makes a page's rows, without the last column ``error``. A page that
    raises gives one row: its id, nulls, and the error."""
    cols = [id_col, html] + ([url] if url else [])
    width = len(schema.fields)

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                try:
                    rows.extend((*r, None) for r in per_page(*rec))
                except Exception as e:  # noqa: BLE001 - reported in the row
                    rows.append((rec[0], *[None] * (width - 2), f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    return pages.select(*cols).mapInPandas(run, schema)


def table_rows(pages: DataFrame, id_col: str = "page_id", html: str = "html", url: str = "url",
               min_cells: int = 3, link_cell: int = 1, text_cell: int = 2) -> DataFrame:
    """B1: ``(page_id, pos, command, description, url, error)`` from table rows."""
    schema = T.StructType([pages.schema[id_col], T.StructField("pos", T.IntegerType()),
                           T.StructField("command", T.StringType()),
                           T.StructField("description", T.StringType()),
                           T.StructField("url", T.StringType()), ERROR])

    def per_page(pid, doc, page_url):
        rows = extract_table_rows(parse(doc), page_url, min_cells, link_cell, text_cell)
        return [(pid, i, c, d, u) for i, (c, d, u) in enumerate(rows)]

    return _job(pages, id_col, html, url, schema, per_page)


def links(pages: DataFrame, id_col: str = "page_id", html: str = "html", url: str = "url"
          ) -> DataFrame:
    """``(page_id, pos, href, error)`` with hrefs resolved against the page URL."""
    schema = T.StructType([pages.schema[id_col], T.StructField("pos", T.IntegerType()),
                           T.StructField("href", T.StringType()), ERROR])

    def per_page(pid, doc, page_url):
        return [(pid, i, h) for i, h in enumerate(extract_links(parse(doc), page_url))]

    return _job(pages, id_col, html, url, schema, per_page)


def tag_text(pages: DataFrame, tag: str, default: str, id_col: str = "page_id",
             html: str = "html", out: str = "text") -> DataFrame:
    """B3 shape: ``(page_id, text, error)`` of the first ``tag`` (else ``default``)."""
    schema = T.StructType([pages.schema[id_col], T.StructField(out, T.StringType()), ERROR])

    def per_page(pid, doc):
        return [(pid, first_text(parse(doc), tag, default))]

    return _job(pages, id_col, html, None, schema, per_page)


DETAILS_SCHEMA = [T.StructField("syntax", T.StringType()),
                  T.StructField("examples", T.ArrayType(T.StringType())),
                  T.StructField("description_detailed", T.StringType()),
                  ERROR]


def page_details(pages: DataFrame, id_col: str = "page_id", html: str = "html",
                 default_syntax: str = D.NO_SYNTAX) -> DataFrame:
    """``(page_id, syntax, examples, description_detailed, error)``.
    A failing page gets nulls and the error text (B6)."""
    schema = T.StructType([pages.schema[id_col]] + DETAILS_SCHEMA)

    def per_page(pid, doc):
        root = parse(doc)
        return [(pid, first_text(root, "pre", default_syntax), extract_examples(root),
                 extract_description(root))]

    return _job(pages, id_col, html, None, schema, per_page)


def enrich_details(catalog: DataFrame, details: DataFrame, on: str = "url") -> DataFrame:
    """Catalogue rows keep their base columns; details join when present."""
    return catalog.join(details, on, "left")
