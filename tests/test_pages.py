"""Element trees and what is read from them, on hand-made pages."""

import time

import pytest
from pyspark.sql import functions as F

from lodestone.functions import tree
from lodestone.operators import pages


def frame(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "key int, html string")


def told(spark, html, *columns):
    row = frame(spark, html).withColumn("t", tree.tree(F.col("html"))).select(*(c.alias(str(k)) for k, c in enumerate(columns))).collect()[0]
    return row[0] if len(columns) == 1 else tuple(row)


def tr():
    return F.col("t")


texts = lambda selector: F.transform(tree.select(tr(), selector), lambda e: tree.text_of(tr(), e))


@pytest.mark.parametrize(
    ("selector", "want"),
    [
        ("li", ["a", "b c", "d"]),
        (".x li, #d", ["a", "b c", "d"]),
        ("ul.x li.y", ["b c"]),
        ("[data-k]", ["b c"]),
        ("[data-k=one]", ["b c"]),
        ('[data-k*="n"]', ["b c"]),
        ("[data-k^=x]", []),
        ("*#d", ["d"]),
        ("ul ul", []),
    ],
)
def test_selectors(spark, selector, want):
    html = '<ul class="x z"><li>a<li class=y data-k="one">b <i>c</i></ul><ol><li id=d>d</ol>'
    assert told(spark, html, texts(selector)) == want


def test_a_selector_must_be_one(spark):
    with pytest.raises(ValueError):
        tree.select(tr(), "li > a")


def test_unclosed_and_stray_tags(spark):
    html = "<p>one<p>two</b></div><table><tr><td>1<td>2<tr><td>3</table>x &amp; y<script>var a = '<p>';</script><br/>z"
    assert told(spark, html, texts("p"), texts("td"), F.array_join(tree.lines(tr(), tree.node(tr(), F.lit(0))), "|")) == (["one", "two"], ["1", "2", "3"], "one")


def test_deep_pages_take_linear_time(spark):
    page = "<div>" * 40_000 + "<p>in"
    start = time.perf_counter()
    assert told(spark, page, texts("p"), F.size(tree.ancestors(tr(), F.get(tree.select(tr(), "p"), 0)))) == (["in"], 8)
    assert time.perf_counter() - start < 30


def test_no_page(spark):
    df = frame(spark, None, "", "just text").withColumn("t", tree.tree(F.col("html")))
    got = [tuple(r) for r in df.select(F.size("t.nodes"), F.size(tree.labelled(tr())), F.size(tree.select(tr(), "a"))).collect()]
    assert got == [(0, 0, 0), (0, 0, 0), (1, 0, 0)]
    assert pages.links(df.withColumn("u", F.lit("https://h/")), "key", "html", "u").count() == 0
    assert pages.programmes(df, "key", "html").count() == pages.table_rows(df, "key", "html").count() == 0
    assert pages.sections(df, "key", "html", pages.Layout(blocks=(("A", ("#a",)),))).count() == 0


def test_spans(spark):
    html = """<table><tr><th rowspan="2">A<th colspan="2">B<tr><td>1<td rowspan="9">2<tr><td>3<td>4<tr><td colspan="0">5</table>"""
    got = [(r.row, r.values) for r in pages.table_rows(frame(spark, html), "key", "html").orderBy("row").collect()]
    assert got == [(0, ["A", "B", "B"]), (1, ["A", "1", "2"]), (2, ["3", "4", "2"]), (3, ["5", "", "2"])]


def study(spark, html, kinds=("*part-time*",)):
    df = frame(spark, html).withColumn("t", tree.tree(F.col("html")))
    found = pages.study_of(tr())
    return tuple(df.select(found.modes, pages.excluded(found, F.lit(None), list(kinds), [])).collect()[0])


def test_part_time_only_and_mixed_tables(spark):
    row = '<tr class="values"><td><span>Mode</span><span>{}</span></td><td><span>Duration</span><span>1 year</span></td></tr>'
    table = lambda *modes: f"<table>{''.join(map(row.format, modes))}</table>"
    assert study(spark, table("PgCert: Part-time")) == (["PgCert: Part-time"], True)
    assert study(spark, table("BSc: Full-time", "BSc: Part-time")) == (["BSc: Full-time", "BSc: Part-time"], False)
    assert study(spark, table("PgCert: Part-time"), ["short"]) == (["PgCert: Part-time"], False)
    assert study(spark, "<p>none</p>") == ([], False)


def test_tabs_by_control_and_nested(spark):
    html = """<main id=m><p>Enough text around here</p><div class=tabs><button id=b1>One</button><a href="#p2">Two</a>
    <div role=tabpanel aria-labelledby=b1>first<div role=tabpanel><p>inner</div></div><div role=tabpanel id=p2><ul><li>x<li>y</ul></div>
    <h4>Three</h4><div role=tabpanel></div></div></main>"""
    layout = pages.Layout(blocks=(("Main", ("#none", "main")),), tabs=".tabs")
    got = pages.sections(frame(spark, html), "key", "html", layout)
    assert [(r.kind, r.title, r.body) for r in got.orderBy("place").collect()] == [
        ("tab", "One", "first\n\ninner"),
        ("tab", "Two", "- x\n- y"),
        ("rest", "", "Enough text around here"),
    ]
    whole = pages.sections_markdown(got, layout).collect()[0].markdown
    assert whole == "## Main\n\n#### One\n\nfirst\n\ninner\n\n#### Two\n\n- x\n- y\n\nEnough text around here"


def test_programmes_of_a_country(spark):
    item = '<div class="accordion__item"><div class="accordion__header"><h4>{}</h4>{}</div><div class="accordion__body">{}</div></div>'
    entry = "<p><strong>English language</strong> IELTS 6.5</p><p><strong>Entry requirements</strong>: <span>GPA 3.0</span></p>"
    html = (
        "<h2>News</h2>" + item.format("Not this", "", entry) + "<h2>Postgraduate entry requirements</h2><h3>Law</h3>"
        + item.format("LLM", "<span>1 year</span>", entry) + item.format("MA", "", "<p>Contact our admissions team</p>") + item.format("", "", entry)
        + "<h3>Business</h3>" + item.format("MBA with Foundation Year", "", entry)
    )
    got = pages.programmes(frame(spark, html), "key", "html").orderBy("place").collect()
    assert [tuple(r)[2:] for r in got] == [
        ("Postgraduate", "Law", "Law: LLM", "1 year", "IELTS 6.5", "GPA 3.0"),
        ("Postgraduate", "Law", "Law: MA", "", "", ""),
        ("Postgraduate", "Business", "Business: MBA with Foundation Year", "4 years with foundation year", "IELTS 6.5", "GPA 3.0"),
    ]


def test_requirements_of_a_text(spark):
    rules = [(r"(?i)GPA\s*([\d.]*)", "BSc", "$1|see text"), (r"\bHND\b", "Diploma", "Level 5")]
    df = spark.createDataFrame([("GPA 3.1 or HND",), ("GPA wanted",), ("contact our team, HND",), (None,)], "e string")
    got = [[tuple(x) for x in r[0]] for r in df.select(pages.required(F.col("e"), rules)).collect()]
    assert got == [[("BSc", "3.1"), ("Diploma", "Level 5")], [("BSc", "see text")], [], []]


def test_the_row_selector_is_chosen(spark):
    menu = "".join(f'<a href="/courses/{k}">c</a>' for k in range(3))
    items = "".join(f'<div class="card"><a href="/courses/x{k}">c</a></div>' for k in range(8))
    html = f'<div class="menu">{menu}</div><div class="wide">{items}<a href="/about">a</a></div>'
    found = pages.links(frame(spark, html).withColumn("u", F.lit("https://h.example/")), "key", "html", "u")
    got = pages.link_selectors(found, F.col("path").startswith("/courses/"), 4).where("chosen").collect()
    assert [(r.selector, r.hits, r.others) for r in got] == [(".card", 8, 0)]
