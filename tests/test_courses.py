"""Facts put together from several places, and resolution by tiers."""

import json

import pytest
from pyspark.sql import functions as F

from lodestone.functions import courses, nested
from lodestone.operators import cleanup, resolve


def value(spark, column):
    return spark.range(1).select(column.alias("out")).collect()[0].out


def test_degrees_of_pages(spark):
    d = lambda page: value(spark, courses.degree_of_page(F.lit(page)))
    assert d("x\n- Award BSc (Hons)\n") == "BSc"
    assert d("## Course overview\n- list\nPlacement year x\nMSc full\n## B") == "MSc"
    assert d("---\nsource_html: Art - MA.html\n---\nx") == "MA"
    assert value(spark, courses.degree_by_rules(F.lit("Art"), F.lit(""), F.lit("postgraduate_research"))) == "PhD"


def test_pages(spark):
    page = "---\nstudy_level: foundation\n---\n# T\n## Key information\nk\n## Other\no"
    assert value(spark, courses.excerpt(F.lit(page))) == "study_level: foundation\n\ntitle: T\n\n## Key information\nk"
    assert value(spark, courses.excerpt(F.lit(page), 20)).endswith("...")
    assert value(spark, courses.snippet(F.lit("a\n b £5 \nc £5"), F.lit("£5"))) == "b £5"
    key = "## Key information\n### Year of entry\n- 2026, 2027\n### Duration of study\n- 3 years or 4 years\n### Fees for 2026/27\n- UK £9,000 International £18,500\n"
    assert tuple(value(spark, courses.key_information(F.lit(key)))) == ("January 2027, September 2026", "3 years", "18500")
    assert value(spark, courses.research_duration(F.lit("Completion times\n\nPhD: full-time 3-4 years\n"))) == "3-4 years"
    assert value(spark, courses.research_fee(F.lit("The difference between Home and Overseas tuition fees is £17,712"))) == "17712"
    assert value(spark, courses.starting_fee(F.lit("**£17,500** International students starting 2026/27"))) == "17500"
    assert value(spark, courses.study_options(F.lit("## Key\nStudy options\n\nPart-time\n"))) == "Part-time"
    assert value(spark, courses.excluded_page(F.lit("Study options\nPart-time\n"), F.lit("u"))) is True
    assert value(spark, courses.excluded_page(F.lit("Course type: Short course"), F.lit("u"), ["short*"])) is True
    assert value(spark, courses.letter_page(F.lit("http://x/a-z?letter=b"))) is True
    table = "| Course | Scores |\n| --- | --- |\n| Health (all) | 7.0 overall with no element below 6.5 |"
    assert value(spark, courses.row_label(F.lit(table), F.lit("Health (all) studies"), "std")) == "Health (all)"
    assert value(spark, courses.row_label(F.lit(table), F.lit("Law"), "std")) == "std"
    assert tuple(value(spark, courses.row_scores(F.lit(table), F.lit("Health (all)")))) == ("7.0", "6.5")
    pairs = courses.pairs_of(F.split(F.lit("Fee\n\n£5\nMode\nFull"), "\n"))
    assert value(spark, courses.facts_block(pairs, ["Mode", "Fee", "None"])) == "- **Mode:** Full\n- **Fee:** £5"
    assert value(spark, courses.unspaced_title(F.lit("A r t i s t"), F.lit("http://x/fine-art/"))) == "Fine Art"


def test_country_rows(spark):
    rows = lambda doc, page, level: [tuple(r) for r in value(spark, courses.country_rows(F.lit(doc), F.lit(page), level))]
    doc = json.dumps({"studyLevels": [{"studyLevel": "undergraduate", "programs": [{"requirements": [{"degree": "HSC", "grade": "60%"}, {"degree": "PhD", "grade": "1"}], "description": ["AAB — x", "BBB — y", "policy"]}]}]})
    assert rows(doc, "", "undergraduate") == [("HSC", "60%")]
    assert rows("", "#### Bangladesh\n- **HSC:** GPA 3.0\n#### India\n- **HSC:** 9", "undergraduate") == [("HSC", "GPA 3.0")]
    assert rows("", "Bachelor with 55% and Master CGPA 3.1", "postgraduate") == [("BSc", "55%"), ("MSc", "CGPA 3.1")]
    lines = courses.country_descriptions(F.lit(doc), "undergraduate")
    assert value(spark, courses.for_offers(lines, F.lit("A Level: AAB"))) == ["AAB — x", "policy"]
    blocks = courses.academic_blocks(F.array(F.lit("a")), F.array(F.lit("a"), F.lit("b")), F.array().cast("array<string>"), F.lit("6.5"), F.lit("6.0"))
    assert [(b.subtitle, b.description) for b in value(spark, blocks)] == [("Entry Requirements", ["a", "b"]), ("English Requirement", ["IELTS 6.5 overall with no element below 6.0"])]


def test_fees(spark):
    fee = lambda x: tuple(value(spark, courses.fee_object(F.lit(json.dumps(x)))))
    assert fee({"tuitionFee": "£18,000", "currency": "EUR"}) == ("18000", "EUR")
    assert fee({"UK": 1, "International (2026)": {"fee": 17000, "currency": "GBP"}}) == ("17000", "GBP")
    assert fee({"International": "16,500"}) == ("16500", "GBP")
    assert fee({"UK": 5}) == ("", "")
    block = value(spark, courses.fee_blocks(F.lit('{"tuitionFee": 18000, "placementYearFee": "2500"}'), F.lit("")))
    assert block[0].description == ["International tuition fee: £18,000 (full-time, per year)", "Placement year fee: £2,500"]
    raw = '[{"subtitle":"Fees","description":["see example.com","UK £9"]}]'
    assert value(spark, courses.with_fee_line(nested.metadata(F.lit(raw)), F.lit("7000")))[0].description == ["International tuition fee: £7,000", "UK £9"]
    assert len(value(spark, courses.with_fee_line(nested.metadata(F.lit("")), F.lit("7000")))) == 1


def test_levels_by_tiers(spark):
    known = spark.createDataFrame([("https://a/c/x", "foundation", 1), ("https://b/c/y", "postgraduate", 2), ("https://d/C/Y", "other", 3)], "course_url string, study_level string, ix int")
    df = spark.createDataFrame([("https://a/c/x/",), ("http://z/c/y?q",), ("https://z/new-msc",)], "url string")
    got = {r.url: r.levels for r in resolve.levels_of(df, known, "url").collect()}
    assert got == {"https://a/c/x/": ["foundation"], "http://z/c/y?q": ["postgraduate"], "https://z/new-msc": ["postgraduate"]}
    index = spark.createDataFrame([("https://q/only-index", "other", 1)], "course_url string, study_level string, ix int")
    rows = spark.createDataFrame([("https://q/c/x", "a"), ("https://q/only-index", "b"), ("https://q/n", "Foundation")], "url string, name string")
    assert {r.name: r.level for r in resolve.course_level(rows, known, index, "url", "name").collect()} == {"a": "foundation", "b": "other", "Foundation": "foundation"}


def test_answers_and_programmes(spark):
    answers = spark.createDataFrame([('{"matches":[{"courseName":"ART ","programmeName":"design"}]}',), ('{"matches":{"Law":"none"}}',), ('{"Law":"Legal"}',)], "json string")
    asked = spark.createDataFrame([("Art",), ("Law",)], "name string")
    allowed = spark.createDataFrame([("Design",), ("Legal",)], "value string")
    assert {tuple(r) for r in resolve.accepted_answers(answers, asked, allowed).collect()} == {("Art", "Design"), ("Law", "Legal")}
    c = spark.createDataFrame([(1, "u", "undergraduate", "Law", "see Group B"), (2, "u", "undergraduate", "Physics", "")], "k int, uni string, level string, name string, body string")
    p = spark.createDataFrame(
        [(0, "u", "undergraduate", "All"), (1, "u", "postgraduate", "Group B"), (2, "u", "undergraduate", "Physics set"), (0, "v", "undergraduate", "Physics set of v")],
        "ix int, uni string, level string, programme string",
    )
    score = F.when(F.contains(F.lower("programme"), F.lower("name")), 2).otherwise(0)
    assert {r.k: r.programme for r in resolve.english_programme(c, p, "k", score, ["uni"]).collect()} == {1: "Group B", 2: "Physics set"}
    with pytest.raises(ValueError):
        resolve.english_programme(c, p, "k", score, [])


def test_index_and_gaps(spark):
    index = spark.createDataFrame([("a/x.md", ""), ("b/y.md", ""), ("c/y.md", "")], "md string, out string")
    done = spark.createDataFrame([("z/x.md", "1"), ("z/y.md", "2"), ("b/y.md", "3")], "md string, out string")
    assert {r.md: r.out for r in resolve.index_update(index, done, "md", ["out"]).collect()} == {"a/x.md": "1", "b/y.md": "3", "c/y.md": ""}
    rows = spark.createDataFrame([("u", 1, True, True), ("u", 2, True, False), ("v", 1, True, True)], "url string, ix int, a boolean, b boolean")
    assert [(r.url, r.n) for r in resolve.gap_counts(rows, "url", "ix", ["a", "b"]).collect()] == [("v", 2)]
    left, right = (spark.createDataFrame([(k, v) for k, v in x], "k int, v string") for x in ([(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, "d")]))
    assert {r.k: r.status for r in resolve.compared(left, right, "k", "v").collect()} == {1: "match", 2: "mismatch", 3: "missing_left"}
    text = spark.createDataFrame([(1, "## Arts\n### BA\n- Painting\n- painting\n### MA\n- Drawing")], "k int, t string")
    got = resolve.grouped_rows(cleanup.numbered_lines(text, "k", "t"), "k", r"^##\s+([^#].*)$", r"^###\s+(.*)$")
    assert {tuple(r) for r in got.collect()} == {("Arts", "BA", "Painting"), ("Arts", "MA", "Drawing")}
