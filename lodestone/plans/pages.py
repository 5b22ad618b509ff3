"""Registered queries over pages that the tables' rows make, with the SQL of what these rows say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import tree
from lodestone.operators import pages
from lodestone.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _made(spark: SparkSession, sf_dir: str, table: str, html: str, *more: str) -> DataFrame:
    return readers.table(spark, sf_dir, table).selectExpr(*more, f"{html} AS html")


#: Pages that a task reads, some seconds of work: a small file of short rows makes many pages, and would be one task.
_DEALT = 2000


def _dealt(spark: SparkSession, sf_dir: str, table: str, html: str, *more: str) -> DataFrame:
    """As _made, the table's rows dealt to as many tasks as their number asks for, before they become pages."""
    rows = readers.table(spark, sf_dir, table)
    return rows.repartition(max(1, -(-rows.count() // _DEALT))).selectExpr(*more, f"{html} AS html")


_K = "CAST(p_partkey AS STRING)"
_TABBED = f"""concat('<html><body><h1>', p_name, '</h1><div id="entry"><h2>Entry</h2><div class="tabs"><ul>',
 '<li><a id="t', {_K}, '" href="#uk">UK ', p_brand, '</a></li><li><button aria-controls="world">World</button></li></ul>',
 '<div class="panel" id="uk" aria-labelledby="t', {_K}, '"><p>Grade <b>', p_type, '</b></p></div>',
 CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('<div class="panel" id="world"><p>Size ', CAST(p_size AS STRING), ' or more', '<div class="panel"><p>inner') END,
 CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '</div></div>' END, '<h3>Third ', CAST(p_size AS STRING), '</h3><div class="panel"><dl class="opts"><dt>Start</dt><dd>', p_type, '</dd><dt>Fee<dd>',
 CAST(p_size AS STRING), '</dl><p>not this</div></div><p>Around ', p_brand, '</p><script>var x = "<p>";</script></div>',
 '<section class="fees"><div class="acc"><h3>Fees ', p_type, '</h3><div class="acc-body"><p>Pay ', CAST(p_size AS STRING), '</p><div class="tabs"><div class="panel" aria-labelledby="t', {_K}, '">Home',
 '</div></div></div></div>', CASE WHEN p_partkey % 2 = 0 THEN '' ELSE concat('<div class="acc"><h3>', p_brand, '</h3><div class="acc-body"><ul><li>Loan</ul></div></div>') END, '</section>')"""
TABS = pages.Layout(
    blocks=(("Entry", ("#missing", "#entry")), ("Fees", (".fees",)), ("Short", ("h1",))),
    accordion=".acc",
    accordion_title="h3",
    accordion_body=".acc-body",
    tabs=".tabs",
    panel=".panel",
    options=".opts",
    least=20,
    dropped="script, h2",
)
_PARTS = """SELECT p_partkey AS key, 0 AS block, 1 AS n, 'tab' AS kind, concat('UK ', p_brand) AS title, concat('Grade **', p_type, '**') AS body FROM part
UNION ALL SELECT p_partkey, 0, 2, 'tab', 'World', concat('Size ', p_size, ' or more', chr(10), chr(10), 'inner') FROM part WHERE p_partkey % 3 <> 0
UNION ALL SELECT p_partkey, 0, 3, 'tab', concat('Third ', p_size), concat('- **Start:** ', p_type, chr(10), '- **Fee:** ', p_size) FROM part
UNION ALL SELECT p_partkey, 0, 4, 'rest', '', concat('Around ', p_brand) FROM part
UNION ALL SELECT p_partkey, 1, 1, 'accordion', concat('Fees ', p_type), concat('Pay ', p_size) FROM part
UNION ALL SELECT p_partkey, 1, 2, 'tab', concat('UK ', p_brand), 'Home' FROM part
UNION ALL SELECT p_partkey, 1, 3, 'accordion', p_brand, '- Loan' FROM part WHERE p_partkey % 2 <> 0"""


@query(f"SELECT key, block, CAST(row_number() OVER (PARTITION BY key, block ORDER BY n) AS INTEGER) AS n, kind, title, body FROM ({_PARTS})")
def page_sections(spark, sf_dir):
    found = pages.sections(_dealt(spark, sf_dir, "part", _TABBED, "p_partkey"), "p_partkey", "html", TABS)
    place = F.expr("CAST(row_number() OVER (PARTITION BY key, block ORDER BY place) AS INT)")
    return found.select("key", "block", place.alias("n"), "kind", "title", "body")


@query(f"""SELECT key, string_agg(said, chr(10) || chr(10) ORDER BY block) AS markdown FROM (
  SELECT key, block, ['## Entry', '## Fees'][block + 1] || chr(10) || chr(10) || string_agg(CASE kind WHEN 'rest' THEN body WHEN 'tab' THEN '#### ' || title || chr(10) || chr(10) || body
    ELSE '### ' || title || chr(10) || chr(10) || body END, chr(10) || chr(10) ORDER BY n) AS said FROM ({_PARTS}) GROUP BY key, block) GROUP BY key""")
def page_sections_markdown(spark, sf_dir):
    found = pages.sections(_dealt(spark, sf_dir, "part", _TABBED, "p_partkey"), "p_partkey", "html", TABS)
    return pages.sections_markdown(found, TABS)


_MODE = "CASE p_size % 4 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Part-time' WHEN 2 THEN 'Full time or part time' ELSE '2 years part time' END"
_STUDY = f"""concat('<div class="field--name-field-course-type"><div class="field--item">', p_type, '</div></div>',
 CASE p_partkey % 5
  WHEN 0 THEN concat('<dl><dt>Duration<dd>1 year<dt>Study mode<dd>', {_MODE}, '</dl>')
  WHEN 1 THEN concat('<table><tr><th>Mode<th>Start<tr><td rowspan="2">', {_MODE}, '<td>May<tr><td>June<tr><td>BSc: Full-time<td>July</table>')
  WHEN 2 THEN concat('<table><tr class="v"><td><span>Mode</span><span>', {_MODE}, '</span></td><td><span>Duration</span><span>1 year</span></td></tr></table>')
  WHEN 3 THEN concat('<p>Study options</p><div id="key-course-details"><h3>Study options</h3><p> ', {_MODE}, ' </p></div>')
  ELSE concat('<div class="icon"><span>Study</span><div><b>', {_MODE}, '</b></div></div>') END)"""


@query(f"""WITH m AS (SELECT p_partkey AS key, p_type, p_name, {_MODE} AS mode, p_partkey % 5 AS form FROM part)
SELECT key, p_type AS kind, CASE WHEN form = 3 THEN mode END AS options,
  CASE form WHEN 3 THEN '' WHEN 1 THEN concat(mode, ';BSc: Full-time') ELSE mode END AS modes,
  p_type = 'ECONOMY' OR p_name LIKE '%small%' OR (form <> 1 AND regexp_matches(mode, '(?i)part[- ]time') AND NOT regexp_matches(mode, '(?i)full[- ]time')) AS excluded
FROM m""")
def study_modes(spark, sf_dir):
    rows = _made(spark, sf_dir, "part", _STUDY, "p_partkey AS key", "concat('https://x.example/courses/', replace(p_name, ' ', '-'), '?q=large') AS url")
    rows = rows.withColumn("t", tree.tree(F.col("html")))
    study = pages.study_of(F.col("t"))
    rows = rows.select("key", "url", study.kind.alias("kind"), study.options.alias("options"), study.modes.alias("modes"))
    out = pages.excluded(pages.Study(F.col("kind"), F.col("options"), F.col("modes")), F.col("url"), ["economy", "*part-time*"], ["*small*"])
    return rows.select("key", "kind", "options", F.array_join("modes", ";").alias("modes"), out.alias("excluded"))


_LISTED = f"""concat('<nav class="menu top"><a href="/">Home</a><a href="/courses/', {_K}, '#a">Again</a></nav><div class="results list"><ul class="', lower(replace(p_brand, '#', '-')), '">',
 '<li class="item"><h3><a href="/courses/', {_K}, '/?q=1#x"> ', p_name, ' <b>now</b></a></h3></li>',
 '<li class="item js-x"><a href="https://H.example/courses/', CAST(p_size AS STRING), '-', {_K}, '">', p_type, '</a></li></ul>',
 CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '<p class="more"><a href="courses/more/">More</a> <a href="https://other.example/courses/1">Off</a> <a href="javascript:x()">J</a> <a>none</a>' END, '</div>')"""
_LINKS = """WITH p AS (SELECT p_partkey AS k, '.' || lower(replace(p_brand, '#', '-')) AS b, p_name, p_type, p_size FROM part),
l AS (SELECT k AS key, 'https://h.example/' AS url, '/' AS path, 'Home' AS text, ['.menu', '.top'] AS c FROM p
UNION ALL SELECT k, concat('https://h.example/courses/', k), concat('/courses/', k), 'Again', ['.menu', '.top'] FROM p
UNION ALL SELECT k, concat('https://H.example/courses/', p_size, '-', k), concat('/courses/', p_size, '-', k), p_type, ['.item', '.js-x', b, '.results', '.list'] FROM p
UNION ALL SELECT k, 'https://h.example/a/courses/more', '/a/courses/more', 'More', ['.more', '.results', '.list'] FROM p WHERE k % 2 <> 0)"""


def _links(spark, sf_dir):
    rows = _made(spark, sf_dir, "part", _LISTED, "p_partkey", "'https://h.example/a/b?c' AS base")
    return pages.links(rows, "p_partkey", "html", "base")


@query(f"{_LINKS} SELECT key, url, path, text, array_to_string(c, ' ') AS classes FROM l")
def links_with_classes(spark, sf_dir):
    return _links(spark, sf_dir).select("key", "url", "path", "text", F.array_join("classes", " ").alias("classes"))


@query("""SELECT page_id AS key, concat(regexp_extract(url, '^(https?://[^/]*)', 1), CASE WHEN rtrim(h, '/') = '' THEN '/' ELSE rtrim(h, '/') END) AS url, min(t) AS text, '' AS classes FROM (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<nav><ul>.*?</ul></nav>', 0)) AS nav FROM pages),
  LATERAL (SELECT unnest(regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>', 1)) AS h, unnest(regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>', 2)) AS t)
GROUP BY ALL""")
def given_page_links(spark, sf_dir):
    found = pages.links(readers.table(spark, sf_dir, "pages"), "page_id", "html", "url")
    return found.select("key", "url", "text", F.array_join("classes", " ").alias("classes"))


@query(f"""{_LINKS}, g AS (SELECT key % 50 AS key, path, c FROM l),
m AS (SELECT key, unnest(c) AS selector, CASE WHEN path LIKE '/courses/%' THEN 1 ELSE 0 END AS hit FROM g),
t AS (SELECT key, count(*) FILTER (WHERE path LIKE '/courses/%') AS total FROM g GROUP BY key),
s AS (SELECT key, selector, CAST(sum(hit) AS BIGINT) AS hits, CAST(sum(1 - hit) AS BIGINT) AS others FROM m GROUP BY ALL HAVING sum(hit) >= 2),
q AS (SELECT key, selector, hits, others, hits / total AS coverage, hits / greatest(hits + others, 1) AS purity,
  hits * (1.0 + CASE WHEN regexp_matches(selector, 'result|course|programme|program|listing|card|teaser|views-row|a-z|catalogue|catalog|item') THEN 2 ELSE 0 END
  - CASE WHEN regexp_matches(selector, 'menu|nav|footer|header|breadcrumb|social|cookie') THEN 3 ELSE 0 END
  - CASE WHEN selector LIKE '%js-%' AND NOT regexp_matches(selector, 'result|course') THEN 0.5 ELSE 0 END) AS base FROM s JOIN t USING (key) WHERE total >= 2),
r AS (SELECT *, base + coverage * 20 + purity * 30 AS score FROM q),
w AS (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY score DESC, selector DESC) AS INTEGER) AS place FROM r)
SELECT key, selector, hits, others, round(coverage, 6) AS coverage, round(purity, 6) AS purity, round(score, 6) AS score, place FROM w""")
def link_selectors(spark, sf_dir):
    rows = _links(spark, sf_dir).withColumn("key", F.col("key") % 50)  # fifty listings of several pages each
    found = pages.link_selectors(rows, F.col("path").startswith("/courses/"), 4)
    r = lambda c: F.round(c, 6).alias(c)
    return found.select("key", "selector", "hits", "others", r("coverage"), r("purity"), r("score"), "place")


_SUBJECT = "concat('Nation ', CAST(s_nationkey AS STRING))"
_ITEM = """concat('<div class="accordion__item"><div class="accordion__header"><h4>', CASE WHEN s_suppkey % 5 = 0 THEN 'International Foundation Programme ' WHEN s_suppkey % 7 = 0 THEN 'Foundation Year ' ELSE '' END, s_name, '</h4>',
 CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat('<span>', CAST(s_suppkey % 4 AS STRING), ' years</span>') END,
 '</div><div class="accordion__body"><p><strong>English language</strong>: IELTS ', CAST(s_suppkey % 9 AS STRING), '<br>overall</p><p><strong>Entry requirements:</strong> <span>Higher Secondary School Certificate or Intermediate Certificate: ',
 CAST(s_acctbal AS STRING), '%</span></p></div></div>')"""


@query("""SELECT s_nationkey AS key, s_suppkey AS n,
  CASE WHEN s_suppkey % 5 = 0 THEN 'Foundation' WHEN s_suppkey % 2 = 0 THEN 'Undergraduate' ELSE 'Postgraduate' END AS level,
  concat('Nation ', s_nationkey) AS subject,
  concat('Nation ', s_nationkey, ': ', CASE WHEN s_suppkey % 5 = 0 THEN 'International Foundation Programme ' WHEN s_suppkey % 7 = 0 THEN 'Foundation Year ' ELSE '' END, s_name) AS program,
  CASE WHEN s_suppkey % 3 <> 0 THEN concat(s_suppkey % 4, ' years') WHEN s_suppkey % 7 = 0 AND s_suppkey % 5 <> 0 THEN '4 years with foundation year' ELSE '' END AS duration,
  concat('IELTS ', s_suppkey % 9, ' overall') AS english, 'HSC' AS degree, concat(s_acctbal, '%') AS grade
FROM supplier""")
def country_programmes(spark, sf_dir):
    rows = readers.table(spark, sf_dir, "supplier").selectExpr("s_nationkey", "s_suppkey", f"{_SUBJECT} AS subject", f"{_ITEM} AS item")
    part = lambda odd: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("s_suppkey") % 2 == odd, F.struct("s_suppkey", "item")))), lambda x: x["item"]), ""
    )
    head = lambda level: F.concat(F.lit(f'<h2 class="heading">{level} entry requirements</h2><div class="accordion"><h3>'), F.first("subject"), F.lit("</h3>"))
    made = rows.groupBy("s_nationkey").agg(
        F.concat(F.lit("<h2>About</h2>"), head("Undergraduate"), part(0), F.lit("</div>"), head("Postgraduate"), part(1), F.lit("</div>")).alias("html")
    )
    found = pages.programmes(made, "s_nationkey", "html")
    rules = [(r"(?i)Higher Secondary School Certificate or Intermediate Certificate:\s*([^<\n]+)", "HSC", "$1")]
    each = found.select("*", F.explode(pages.required(F.col("entry"), rules)).alias("r"))
    return each.select(
        "key",
        F.regexp_extract("program", "#(\\d+)$", 1).cast("long").alias("n"),
        F.col("studyLevel").alias("level"),
        F.col("subjectArea").alias("subject"),
        "program",
        "duration",
        "english",
        "r.degree",
        "r.grade",
    )


_GRID = """concat('<table><thead><tr><th>Level</th><th colspan="2">Offer</th></tr></thead><tr><td rowspan="2">', p_brand, '</td><td>', p_type, '</td><td>', CAST(p_size AS STRING),
 '</td></tr><tr><td colspan="2">', p_name, '</td></tr><tr><td>only</td></tr></table>', CASE WHEN p_partkey % 4 = 0 THEN '<p>x<table><tr><td>a<table><tr><td>inner</table></td></tr></table>' ELSE '' END)"""


@query("""SELECT p_partkey AS key, 0 AS t, 0 AS r, true AS header, 'Level|Offer|Offer' AS v FROM part
UNION ALL SELECT p_partkey, 0, 1, false, concat(p_brand, '|', p_type, '|', p_size) FROM part
UNION ALL SELECT p_partkey, 0, 2, false, concat(p_brand, '|', p_name, '|', p_name) FROM part
UNION ALL SELECT p_partkey, 0, 3, false, 'only' FROM part
UNION ALL SELECT p_partkey, 1, 0, false, 'a inner' FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT p_partkey, 2, 0, false, 'inner' FROM part WHERE p_partkey % 4 = 0""")
def spanned_tables(spark, sf_dir):
    found = pages.table_rows(_made(spark, sf_dir, "part", _GRID, "p_partkey"), "p_partkey", "html")
    return found.select("key", F.col("table").alias("t"), F.col("row").alias("r"), "header", F.array_join("values", "|").alias("v"))
