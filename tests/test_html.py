from textloom import defaults as D
from textloom.sources import html

PAGE = """<html><body>
<table>
<tr><th>h</th><th>h</th><th>h</th></tr>
<tr><td>1</td><td><a href="dir.html">DIR</a></td><td> List files </td></tr>
<tr><td>2</td><td>no link</td><td>x</td></tr>
<tr><td>3</td><td><a href="/cmd/cd.html">CD</a></td></tr>
<tr><td>4</td><td><b><a href="copy.html"> COPY </a></b></td><td>Copy &amp; paste</td></tr>
</table>
<h1>Title</h1>
<p>First <b>para</b>.
<p>Second para
<pre> syntax here </pre>
<p>after pre</p>
<h3>Examples</h3>
<blockquote><div><span class="x code">dir /s</span></div></blockquote>
<p>text</p>
<blockquote><span class="code"> dir /b </span><span class="code">ignored</span></blockquote>
<h3>Related</h3>
<blockquote><span class="code">not an example</span></blockquote>
</body></html>"""


def test_table_rows_and_links():
    root = html.parse(PAGE)
    rows = html.extract_table_rows(root, "https://docs.example/cmd/")
    assert rows == [("DIR", "List files", "https://docs.example/cmd/dir.html"),
                    ("COPY", "Copy & paste", "https://docs.example/cmd/copy.html")]
    assert html.extract_links(root, "https://docs.example/cmd/x.html")[1] == "https://docs.example/cmd/cd.html"


def test_details():
    root = html.parse(PAGE)
    assert html.first_text(root, "pre", D.NO_SYNTAX) == "syntax here"
    assert html.extract_examples(root) == ["dir /s", "dir /b"]
    # unclosed <p>: a new <p> closes the open one; stops at <pre>
    assert html.extract_description(root) == "First para. Second para"


def test_missing_parts():
    root = html.parse("<html><body><p>only</p></body></html>")
    assert html.first_text(root, "pre", D.NO_SYNTAX) == D.NO_SYNTAX
    assert html.extract_examples(root) == []
    assert html.extract_description(root) == ""


def test_spark_jobs(spark):
    pages = spark.createDataFrame([(1, "https://docs.example/cmd/", PAGE), (2, "https://e.x/", None)],
                                  "page_id long, url string, html string")
    tr = html.table_rows(pages).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.pos, r.command) for r in tr] == [(1, 0, "DIR"), (1, 1, "COPY")]
    det = {r.page_id: r for r in html.page_details(pages).collect()}
    assert det[1].syntax == "syntax here" and det[1].examples == ["dir /s", "dir /b"]
    assert det[2].syntax == D.NO_SYNTAX and det[2].error is None


def test_deep_nesting_and_bad_links_do_not_stop_the_job(spark):
    deep = "<ul>" + "<li>x" * 50_000
    pages = spark.createDataFrame([(1, "http://a.example/", deep), (2, "http://a.example/", '<a href="http://[x">bad</a>'),
                                   (3, "http://a.example/", '<a href="/y">y</a>')], "page_id long, url string, html string")
    got = {(r.page_id, r.href, r.error is None) for r in html.links(pages).collect()}
    assert got == {(2, None, False), (3, "http://a.example/y", True)}
    text = {r.page_id: r.text for r in html.tag_text(pages, "ul", "none").collect()}
    assert len(text[1]) == 50_000 and text[3] == "none"
    details = html.page_details(pages)
    assert details.filter("error IS NULL").count() == 3
    joined = html.enrich_details(pages.select("page_id", "url"), details, "page_id")
    assert joined.count() == 3
