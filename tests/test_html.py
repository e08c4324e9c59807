"""Golden tests of the HTML token-table cleaner on hand-written pages."""

import pytest
from pyspark.sql import functions as F

from elcorpus.operators import html as H
from elcorpus.plans import clean as C
from elcorpus.profile import ARTICLE, MEDIAWIKI_FR


def wrap(body, qid="Q90"):
    link = f'<a href="https://www.wikidata.org/wiki/Special:EntityPage/{qid}">wd</a>' if qid else ""
    return ('<html><body><div id="mw-content-text"><div class="mw-parser-output">' + body +
            "</div></div>" + link + "</body></html>")


def clean(spark, *pages):
    rows = [(i, f"T{i}", f"u{i}", h) for i, h in enumerate(pages)]
    df = spark.createDataFrame(rows, "input_seq long, page string, url string, text string")
    return {r.input_seq: r for r in C.cleaned_rows(df).collect()}


def test_readme_link_example(spark):
    r = clean(spark, wrap('<p><a href="/wiki/Paris" title="Paris">la ville lumière</a></p>'))[0]
    assert (r.status, r.qid, r.text) == ("ok", "Q90", "[E=Paris]la ville lumière[/E]")


def test_steps_in_order(spark):
    body = ('<div class="bandeau-container"><p>banner</p></div>'
            '<table class="infobox"><tr><td><p>box</p></td></tr></table>'
            '<p>Un <b>deux</b><sup>[1]</sup> <a href="/wiki/Projet:X" title="Projet:X">ns</a> '
            '<a href="/wiki/Lyon#Histoire" title="Lyon">frag</a>\n</p>'
            '<ul><li><p>nested</p></li></ul>'
            '<p><span class="mwe-math-element">abc</span> <a href="/wiki/A_B" title="A B">x <i>y</i></a>\n</p>'
            '<h2>Voir aussi<span class="mw-editsection">[modifier]</span></h2><p>gone</p>')
    r = clean(spark, wrap(body))[0]
    assert r.text == "Un deux ns frag\n\nab [E=A_B]x y[/E]"


def test_missing_page_and_errors(spark):
    res = clean(spark,
                '<html><body><div class="noarticletext">x</div></body></html>',
                '<html><body><p>no container</p></body></html>',
                wrap('<p><span class="mwe-math-element"><img src="m"></span></p>'),
                wrap('<p><span class="mwe-math-element"><img alt="{\\displaystyle x}"></span></p>'),
                wrap('<p><span class="mwe-math-element">y\n2{\\displaystyle y}</span></p>', qid=None))
    assert (res[0].status, res[0].qid, res[0].text) == ("ok", "", "")
    assert (res[1].status, res[1].error_class) == ("error", "IndexError")
    assert (res[2].status, res[2].error_class) == ("error", "KeyError")
    assert res[3].text == "{\\displaystyle x}"
    assert (res[4].text, res[4].qid) == ("y2", "")


def test_first_success_per_title(spark):
    rows = [(1, "T", "u1", "<html><body><p>no container</p></body></html>"),
            (2, "T", "u2", wrap("<p>ok</p>")), (3, "T", "u3", "<html><body></body></html>")]
    df = spark.createDataFrame(rows, "input_seq long, page string, url string, text string")
    ok, err = C.clean_pages(df)
    assert [(r.title, r.url, r.text) for r in ok.collect()] == [("T", "u2", "ok")]
    assert [r.input_seq for r in err.collect()] == [1]


def test_unclosed_paragraphs_article_profile(spark):
    html = "<html><body><nav><p>menu</p></nav><article><h1>T</h1><p><b>A<br><p>B &amp; C</p><p>D</article><p>out</p></body></html>"
    df = spark.createDataFrame([(1, html)], "pk long, html string")
    got = H.paragraph_texts(H.annotate(H.tokenize(df), ARTICLE)).orderBy("p_index").collect()
    assert [(r.p_index, r.text) for r in got] == [(1, "A"), (2, "B & C"), (3, "D")]


def test_tokens_keep_script_whole(spark):
    html = '<p>a<script>var t="</p>";</script><!-- c --> b</p>'
    df = spark.createDataFrame([(1, html)], "pk long, html string")
    kinds = [(r.tok, r.kind) for r in H.raw_tokens(df).orderBy("seq").collect()]
    assert kinds == [("<p>", "open"), ("a", "text"), ('<script>var t="</p>";</script>', "raw"),
                     ("<!-- c -->", "comment"), (" b", "text"), ("</p>", "close")]


@pytest.mark.parametrize("attr_html, title", [
    ('<a title="A &amp; B" href="/wiki/A">x</a>', "A_&_B"),
    ("<a href='/wiki/A' title='Q'>x</a>", "Q"),
])
def test_attribute_forms(spark, attr_html, title):
    r = clean(spark, wrap(f"<p>{attr_html}</p>"))[0]
    assert r.text == f"[E={title}]x[/E]"


@pytest.mark.parametrize("body, text", [
    ("<ul><li>a<li>b</ul><p>after list</p>", "after list"),
    ("<p><span>one</p><p>two</p><p>three</p>", "one\ntwo\nthree"),
    ("<p>a<sup>1</p><p>second</p>", "a\nsecond"),
    ('<p><a href="/wiki/A" title="A">x</p><p><a href="/wiki/B" title="B">y</a></p>', "[E=A]x[/E]\n[E=B]y[/E]"),
    ("<address><p>in address</p></address><p>ok</p>", "ok"),
    ("<pre><p>in pre</p></pre><b><p>in b</p></b><p>ok</p>", "ok"),
    ("<dl><dt>a<dd><p>b<dt>c</dl><table><tr><td><p>x<td>y<tr><td>z</table><p>ok", "ok"),
    ("</div2></span><p>a</b>b</p>", "ab"),
    ("<p>a</p><header>Top <h2>Notes et références</h2></header><p>gone</p>", "a"),
    ('<p><a href="/wiki/R" data-x="the title=Wrong" title="Right">x</a></p>', "[E=Right]x[/E]"),
    ('<p><a href="/wiki/R" class="some title here">x</a></p>', "x"),
    ('<p><a href="/wiki/R" title="A > B">x</a> 1 > 0</p>', "[E=A_>_B]x[/E] 1 > 0"),
    ("<p>x<hr>y<p>z<br/>w</p>", "x\nzw"),
    ('<p><a href="/wiki/A" title="A">x<sup>1</sup></a><i>i<p>b', "[E=A]x[/E]i\nb"),
])
def test_tags_left_out_and_quoted_values(spark, body, text):
    assert clean(spark, wrap(body))[0].text == text


def test_every_element_gets_its_end(spark):
    html = "<div><ul><li>a<li><b>b</ul></i><p>c<p>d</div>e"
    df = spark.createDataFrame([(1, html)], "pk long, html string")
    toks = df.select(F.regexp_extract_all("html", F.lit(H.TOKEN_PATTERN), 0).alias("toks"))
    got = toks.select(F.expr(H._balanced_sql("toks")).alias("b")).first()["b"]
    assert "".join(got) == "<div><ul><li>a</li><li><b>b</b></li></ul><p>c</p><p>d</p></div>e"


def test_balancing_goes_across_blocks_of_tokens(spark):
    n = H._BLOCK * 3 + 7
    df = spark.createDataFrame([(1, "<ul>" + "<li>x" * n + "</ul>"), (2, "<p>well</p>" * n), (3, ""), (4, None)], "pk long, html string")
    toks = df.select("pk", F.regexp_extract_all("html", F.lit(H.TOKEN_PATTERN), 0).alias("toks"))
    got = {r["pk"]: r["b"] for r in toks.select("pk", F.expr(H._balanced_sql("toks")).alias("b")).collect()}
    assert "".join(got[1]) == "<ul>" + "<li>x</li>" * n + "</ul>"
    assert "".join(got[2]) == "<p>well</p>" * n
    assert not got[3] and not got[4]


def test_predicates_on_columns(spark):
    rows = [("a", "/wiki/Paris", "Paris", None, True, False), ("a", "/wiki/Paris", None, None, False, False), ("b", "/wiki/Paris", "Paris", "x", False, False),
            ("a", "/wiki/Projet:X", "Projet:X", None, False, False), ("a", None, "Paris", None, False, False), ("div", None, None, "a bandeau-container", False, True),
            ("table", None, None, "infobox", False, True), ("td", None, None, "infobox_v3 y", False, True), ("td", None, None, "infoboxes", False, False),
            ("span", None, None, "mw-editsection", False, True), ("div", None, None, "mw-editsection", False, False)]
    df = spark.createDataFrame(rows, "tag string, href string, title string, cls string, link boolean, dropped boolean")
    c = F.col
    for r in df.select("*", H.is_link_to_article(c("tag"), c("href"), c("title"), MEDIAWIKI_FR).alias("l"), H.is_dropped_block(c("tag"), c("cls"), MEDIAWIKI_FR).alias("d")).collect():
        assert (r["l"], r["d"]) == (r["link"], r["dropped"]), r
    heads = spark.createDataFrame([("h2", " Voir Aussi\n", True), ("h2", "Vie", False), ("p", "Notes", False), ("header", "notes", True), ("h2", None, False)], "tag string, text string, want boolean")
    for r in heads.select("want", H.is_boilerplate_heading(c("tag"), c("text"), MEDIAWIKI_FR).alias("got")).collect():
        assert r["got"] == r["want"]
