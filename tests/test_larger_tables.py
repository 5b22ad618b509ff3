"""Rows and groups that only larger tables have: queries against their SQL, operators by the rows they make on the way."""

import datetime
import random

import duckdb
from pyspark.sql import functions as F

from lodestone.functions import markup, numbers, tree
from lodestone.operators import enrichment, pages
from lodestone.plans import catalog
from lodestone.plans import pages as plans

ORDER = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def by_sql(name, **tables):
    con = duckdb.connect()
    for table, path in tables.items():
        con.sql(f"create view {table} as select * from '{path}/*.parquet'")
    return sorted(con.sql(catalog.oracle_sql()[name]).fetchall())


def test_fees_of_the_example_in_every_kind_of_row(spark, tmp_path):
    day = datetime.datetime(2026, 9, 1)
    rows = [(8 * n + k, 1, "O", price, day, "1-URGENT") for k in range(8) for n, price in enumerate((18570.4, 42500.0, 7000.5, 1234567.9))]
    spark.createDataFrame(rows, ORDER).write.parquet(str(tmp_path / "orders.parquet"))
    got = catalog.queries()["fee_sanitize"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == by_sql("fee_sanitize", orders=tmp_path / "orders.parquet")


def test_the_fee_of_the_example_needs_a_source(spark):
    sane = lambda *a: tuple(spark.range(1).select(numbers.sane_fee(*map(F.lit, a)).alias("x")).collect()[0].x)
    assert sane("18570", "GBP", "", "", False) == ("", "")
    assert sane("18570", "GBP", "", "Fee £18,570", False) == sane("18570", "GBP", "", "", True) == ("18570", "GBP")


def most_joined(df):
    """The rows that the largest join of a query makes."""
    df.collect()

    def nodes(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from nodes(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from nodes(plan.plan())
        else:
            yield plan
            for k in range(plan.children().size()):
                yield from nodes(plan.children().apply(k))

    joins = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in n.getClass().getSimpleName()]
    return max(n.metrics().get("numOutputRows").get().value() for n in joins)


def test_awards_of_one_group_make_no_pairs(spark):
    n = 400
    level, name = "CASE id % 2 WHEN 0 THEN 'postgraduate' ELSE 'diploma' END", "CASE WHEN id % 5 = 0 THEN 'MBA ' ELSE 'x' END"
    courses = spark.range(n).selectExpr("id AS k", "'a' AS uni", f"{level} AS level", f"{name} AS name", "CAST(NULL AS STRING) AS body")
    awards = spark.range(n).selectExpr("'a' AS uni", "id AS ix", "'postgraduate, diploma' AS levels", f"concat({name}, id) AS name", "'' AS kind", "'' AS eligibility", "concat('£', 100 + id % 7) AS amount", "'' AS description")
    made = enrichment.best_awards(courses, awards, "k", ["uni"])
    worth = lambda i, mba, level: (mba and i % 5 == 0, 100 + i % 7, -i) if mba or i % 5 or level == "diploma" else (False, -1, 0)
    want = {k: max(range(n), key=lambda i: worth(i, k % 5 == 0, ("postgraduate", "diploma")[k % 2])) for k in range(n)}
    named = lambda i: f"MBA {i}" if i % 5 == 0 else f"x{i}"
    assert {r.k: r.award.scholarshipName for r in made.collect()} == {k: named(i) for k, i in want.items()}
    assert most_joined(made) <= n
    twice = enrichment.best_awards(courses.union(courses), awards, "k", ["uni"])
    assert twice.count() == n


def test_programmes_of_one_group_make_no_pairs(spark):
    n = 400
    rules = [("pg", "law", 1, "bar", "pg", "bar", True), ("pg", "law", 2, "", "pg", "llm", True), ("pg", "", 1, "", "pg", "msc", False), ("pg", "", 2, "", "pg", "{subject}", False)]
    rules = spark.createDataFrame(rules, "level string, subject string, rank int, pattern string, wanted string, needle string, decides boolean")
    courses = spark.range(n).selectExpr("id AS k", "'a' AS uni", "'pg' AS level", "CASE id % 3 WHEN 0 THEN 'law' WHEN 1 THEN 'art' ELSE 'music' END AS subject", "CASE WHEN id % 2 = 0 THEN 'bar' END AS text")
    offered = "CASE WHEN id < 200 THEN 'none ' WHEN id % 2 = 0 THEN 'LLM ' ELSE 'Bar ' END"
    programmes = spark.range(n).selectExpr("'a' AS uni", "id AS ix", "'PG' AS level", "CASE id % 2 WHEN 0 THEN 'law' ELSE 'art' END AS subject", f"concat({offered}, CASE WHEN id % 2 = 1 AND id > 300 THEN 'Art ' ELSE '' END, id) AS name")
    made = enrichment.programme_by_rule(courses, programmes, rules, "k", ["uni"])
    # the rule on the bar decides and no programme in law has it; art has no MSc, so its subject is looked for
    want = {k: {0: None if k % 2 == 0 else "LLM 200", 1: "Bar Art 301", 2: None}[k % 3] for k in range(n)}
    assert {r.k: r.programme for r in made.collect()} == want
    assert most_joined(made) <= 3 * n


def test_pages_of_a_small_file_are_dealt_and_read_once(spark, tmp_path):
    part = spark.range(9000).selectExpr("id AS p_partkey", "'x' AS p_name", "'Brand#1' AS p_brand", "'SMALL' AS p_type", "CAST(id % 50 AS INT) AS p_size", "1.0D AS p_retailprice")
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    found = pages.sections(plans._dealt(spark, str(tmp_path), "part", plans._TABBED, "p_partkey"), "p_partkey", "html", plans.TABS)
    assert found.rdd.getNumPartitions() == 5
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ArrowEvalPython [") == 2  # the tree and the markdown, each once


def test_sections_queries_deal_their_pages(spark, tmp_path, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(plans, "_DEALT", 30)
    for name in ("page_sections", "page_sections_markdown"):
        df = catalog.queries()[name](spark, str(tmp_path))
        assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, df.collect())) == by_sql(name, part=tmp_path / "part.parquet")


def test_plain_markup_is_read_as_by_the_standard_parser():
    class Told(markup.Markup):
        def __init__(self, page, plain):
            super().__init__()
            self.told = []
            if plain:
                self.read(page)
                return
            self._starts = [0, *(k + 1 for k, c in enumerate(page) if c == "\n")]
            self.feed(page)
            self.close()

        def handle_starttag(self, tag, attrs):
            self.told.append((tag, attrs, self.place(), self.tag_end()))

        def handle_endtag(self, tag):
            self.told.append((tag, self.place()))

        def handle_data(self, data):
            self.told.append((data, self.place()))

    pieces = ["<p>", "</P>", '<DIV Id="x"  class="a\nb" >', "</div>", "a > b\n", "<br>", "<br/>", "<script>x = '<p>';</script>", "<script></style>", "<style>", "</style>",
              "&amp;", "&", "<", "<!-- c -->", "<a b>", "<a b=c>", '<a a="1" A="2">', "<title>t</title>", "</p >", '<p id="x>', "\r\n"]
    rng = random.Random(0)
    for n in range(3000):
        page = "".join(rng.choice(pieces[: 8 if n % 2 else None]) for _ in range(rng.randrange(8)))
        assert Told(page, True).told == Told(page, False).told, page
    assert markup._PLAIN.fullmatch("".join(pieces[:6])) and not markup._PLAIN.fullmatch("<p")


def test_labelled_pairs_of_an_element(spark):
    html = "<dl><dt>A<dd>1</dl><div id=x><dl><dt>B<dd>2<dt>C<dd>3</dl><table><tr><th>H<tr><td>4</table></div><dl><dt>D<dd>5</dl>"
    df = spark.createDataFrame([(html,)], "html string").withColumn("t", tree.tree(F.col("html")))
    t = F.col("t")
    some = tree.bind(F.get(tree.select(t, "#x"), 0), lambda e: tree.labelled(t, e))
    every, inner = df.select(tree.labelled(t), some).collect()[0]
    assert [r.label for r in every] == ["A", "B", "C", "H", "D"] and [tuple(r)[:2] for r in inner] == [("B", "2"), ("C", "3"), ("H", "4")]
