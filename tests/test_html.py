"""Tokens and elements against the standard library's parser and hand-made pages."""

from html import unescape
from html.parser import HTMLParser

from pyspark.sql import functions as F

from berth.functions import html as H
from berth.operators import discover as D


def parse(spark, *pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id long, html string")
    rows = df.select("page_id", H.tokens(F.col("html")).alias("t")).orderBy("page_id").collect()
    return [[(t.kind, t.name, t.text) for t in r.t] for r in rows]


class Reader(HTMLParser):
    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out = []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.out.append((1, tag))

    def handle_endtag(self, tag):
        self.out.append((-1, tag))

    def handle_data(self, data):
        self.out.append((0, data))


def plain(tokens):
    """Tags and texts in order; neighbouring texts joined."""
    out = []
    for kind, name, text in tokens:
        if kind:
            out.append((kind, name))
        if text:
            if out and out[-1][0] == 0:
                out[-1] = (0, out[-1][1] + text)
            else:
                out.append((0, text))
    return out


def test_tokens_agree_with_the_standard_parser(spark):
    pages = ['<p class="a > b" id=\'>\'>x &amp; y</p>', "<!-- <a>no</a> --><a\nhref=x>t</a >", "<!DOCTYPE html><br/>1 < 2 <b>3</b>",
             "<script>if (a < b && c) '<a>'</script>z", "&#243;&#xE1;&oacute;&nbsp;&hellip;", "", "plain", "<ul><li>a<li>b</ul>",
             "<style>a > b { }</style><p>q", '<a title="&quot;>">k</a>']
    got = [plain(t) for t in parse(spark, *pages)]
    for page, tokens in zip(pages, got):
        want = [x if x[0] else (0, x[1]) for x in plain([(k, v if k else None, None if k else v) for k, v in Reader(page).out])]
        assert [x for x in tokens if x != (-1, "br")] == [x for x in want if x != (-1, "br")], page


def test_references_and_broken_markup(spark):
    texts = ["&#150;", "&#x80;", "&#0;", "&#xD800;", "&#9999999;", "&amp;lt;", "&nosuch;", "&amp", "a & b; c", "&#128512;"]
    got = ["".join(t[2] for t in page) for page in parse(spark, *texts)]
    assert got == ["–", "€", "�", "�", "�", "&lt;", "&nosuch;", "&amp", "a & b; c", unescape("&#128512;")]
    assert parse(spark, None, "x<a href=", "<!-- open", '<a t="x>y</a>') == [
        [], [(0, None, "x"), (0, None, None)], [(0, None, None)], [(1, "a", None), (0, None, "y"), (-1, "a", None)]]


def test_a_tag_of_many_attributes_and_a_long_page(spark):
    many = "<a " + " ".join(f'k{i}="v > {i}"' for i in range(50_000)) + " class='p ds'>t</a>"
    deep = "<b>" * 3_000 + "x"
    df = spark.createDataFrame([(1, f'<li class="t"><span>M</span>{many}</li>'), (2, deep)], "page_id long, html string")
    assert [tuple(r) for r in D.discover_module_datasets(df, "M").collect()] == [(1, 1, "t")]
    assert {(r.page_id, r.n_b) for r in D.element_survey(df, ["b"]).collect()} == {(1, 0), (2, 3_000)}


def elements(spark, page, *names):
    df = spark.createDataFrame([(page,)], "html string").select(H.tokens(F.col("html")).alias("t"))
    df = df.select("t", H.ranges(F.col("t"), names).alias("e"))
    return [(r[0], r[1]) for r in df.select(F.explode(F.transform("e", lambda e: F.struct(e["name"], H.text_of(F.col("t"), e)))).alias("x")).select("x.*").collect()]


def test_ranges_nest_end_by_siblings_and_close_what_was_left_open(spark):
    assert elements(spark, "<span>a<span>b</span>c</span>d", "span") == [("span", "abc"), ("span", "b")]
    assert elements(spark, "<ul><li>a<ul><li>b</li></ul>c<li>d</ul>e", "li") == [("li", "abc"), ("li", "b"), ("li", "d")]
    assert elements(spark, "<li>a<ul></li>b</ul>c</li>d", "li") == [("li", "abc")]
    assert elements(spark, "<nav><a>x</nav>y<a>z", "a", "nav") == [("nav", "x"), ("a", "x"), ("a", "z")]
    assert elements(spark, "</a>x<input>y<a>z</a></a>", "a", "input") == [("a", "z")]


def test_classes(spark):
    tags = {'<a class="x ds">': True, "<a CLASS='ds'>": True, "<a class=ds>": True, "<a class = ds href=x>": True, '<a title="class=ds">': False,
            "<a title=\" class='ds'\" class=no>": False, '<a class="no-ds ds2">': False, "<a>": False, '<a data-class="ds">': False,
            '<a disabled class="\nds\t">': True}
    df = spark.createDataFrame([(t,) for t in tags], "tag string").select("tag", H.has_class(F.col("tag"), "ds").alias("ok"))
    assert {r.tag: r.ok for r in df.collect()} == tags
