"""Known inputs and outputs of the column functions and operators."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from lodestone.functions import dates, levels, markdown, nested, numbers, text, urls
from lodestone.functions import html as html_
from lodestone.operators import cleanup, dedupe, export, lookup, normalize, sample, stats, validate
from lodestone.sources import readers, sinks
from lodestone.streaming import progress

DAY = datetime.date(2026, 9, 1)


def value(spark, column, **inputs):
    row = spark.createDataFrame([tuple(inputs.values()) or (1,)], list(inputs) or ["x"])
    return row.select(column.alias("out")).collect()[0].out


def of(spark, f, *values):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.out for r in rows.orderBy("k").select(f(F.col("v")).alias("out")).collect()]


def test_urls(spark):
    u = ["https://x.ac.uk/study/courses/Art & Design/ba-2026-27/?p=3#top", "http://x/ a", "", None, "/courses", "https://x.ac.uk/A/B/"]
    assert of(spark, urls.path_key, *u) == ["/study/courses/art & design/ba-2026-27", "/ a", "", "", "/courses", "/a/b"]
    assert of(spark, urls.slug, *u)[:1] == ["art-design-ba-2026-27"]
    assert of(spark, urls.slug, "/courses", "https://x.ac.uk/A/B/", "https://x.ac.uk/") == ["courses", "a-b", "course"]
    assert of(spark, urls.identity, "a-hons-2026-27", "a", "-2026-27") == ["a-hons", "a", "-2026-27"]
    assert of(spark, urls.intake_year, "a-2027-28", "a") == [2027, 0]
    assert of(spark, urls.intake_folder, "a-2026-27", "a-1999-00", "a") == ["2026 - 2027", "1999 - 2000", ""]
    assert of(spark, urls.page_number, "http://x/?Page=4", "http://x/?p=zz", "http://x/?a=1", "http://x/?pageIndex=-3") == [4, 1, 1, 1]
    assert of(spark, urls.family_key, "http://x/l?page=9&a=b", "http://x/l?page=1&a=b#f") == ["http://x/l?page=1&a=b"] * 2
    assert of(spark, urls.redirect_target, "http://s/r?u=https%3A%2F%2Fx%2Fa", "http://s/r?url=/rel") == ["https://x/a", "http://s/r?url=/rel"]
    assert of(spark, urls.path_template, "http://x/a/b/c", "http://x/a") == ["^/a/b/[^/]+$", None]
    assert of(spark, urls.source_url, '<!-- saved from url=(0030)https://x/y --><base href="z">', '<link rel="canonical" href="https://c/">', "") == ["https://x/y", "https://c/", ""]


def test_levels(spark):
    got = of(spark, levels.classify, "https://x/courses/a-with-Foundation-year", "https://x/courses/mres-a", "https://x/courses/a-msc", "https://x/courses/a-ba", "https://x/charms")
    assert got == ["foundation", "postgraduate_research", "postgraduate", "undergraduate", "undergraduate"]
    assert of(spark, levels.parse, "UG", "post grad", "PGR", "Postgraduate Research", "zz") == ["undergraduate", None, "postgraduate_research", "postgraduate_research", None]
    assert value(spark, levels.primary(F.array(F.lit("undergraduate"), F.lit("foundation")))) == "foundation"
    assert value(spark, levels.tag(F.lit("https://x/a-msc"), F.lit("FOUNDATION"), {"postgraduate": ["-msc"]})) == "postgraduate"
    assert value(spark, levels.tag(F.lit("https://x/a-msc"), F.lit("FOUNDATION"), {"postgraduate": ["-msc"]}, True)) == "foundation"


def test_names(spark):
    assert of(spark, text.degree_enum, "A-Level", "Dakhil", "Master's", "bachelor of arts", "none", None) == ["HSC", "HSC", "MSc", "BA", "", ""]
    assert of(spark, text.award_label, "BSc (Hons)", "A BA (Hons) course", "MArch", "x") == ["BSc", "BA", "MA", ""]
    assert of(spark, text.degree_of_name, "BSc Physics", "Physics - BEng (Hons)", "Physics PhD", "Physics") == ["BSc", "BEng", "PhD", ""]
    assert of(spark, text.lookup_keys, "  Art  with Foundation Year – BA (Hons)", "Art") == [["art with foundation year – ba (hons)", "art"], ["art"]]
    assert of(spark, text.requirement_degree, "HSC (Alim)", "Other ") == ["HSC", "Other"]
    assert of(spark, text.requirement_grade, "CGPA 2.75/4", "50 % marks", "GPA of 2.00", "needs 65", "pass") == ["CGPA 2.75", "50%", "GPA 2.00", "65", "pass"]
    assert of(spark, text.offer_grades, "AAB-ABB or bbb") == [["AAB", "ABB", "BBB"]]
    assert of(spark, text.is_empty, None, " ", "[ ]", "None", "[1]", "0") == [True, True, True, True, False, False]
    assert [value(spark, text.wildcard(F.lit("Part Time"), p)) for p in ("part*", "*TIME", "*rt t*", "part time", "", "x%")] == [True, True, True, True, False, False]
    assert of(spark, text.known_degree, "", "bsc", "Wizardry", "PHD") == [True, True, False, True]
    assert of(spark, text.error_bucket, "", "MISSING_REQUIRED_FIELD: missing required field(s): a, b | X: y", "A: b | C: d") == ["OK", "MISSING: a, b", "A: b"]
    assert of(spark, text.english_group, "see Group c here", "none") == ["Group C", ""]


def test_grounding(spark):
    body = F.lit("Fee £18,500 from 7 May")
    assert [value(spark, text.grounded(F.lit(v), body)) for v in ("18500", "£18,500", "May 7", "June 9", "", "words")] == [True, True, True, False, True, False]


@pytest.mark.parametrize(
    ("grade", "degree", "want"),
    [
        ("80 UCAS Tariff points / CDD", "HSC", 3.5),
        ("120 UCAS Tariff points", "HSC", 4.0),
        ("GPA of 2.0 or CGPA 3.456", "BSc", 3.46),
        ("Minimum 60%", "HSC", 3.5),
        ("60%", "MSc", 3.0),
        ("30%", "HSC", 0.0),
        ("Upper Second (2:1)", "BSc", 3.0),
        ("BBB or 2:2", "HSC", 2.5),
        ("a pass", "BSc", None),
        (None, "BSc", None),
    ],
)
def test_gpa(spark, grade, degree, want):
    assert value(spark, numbers.gpa(F.lit(grade).cast("string"), F.lit(degree))) == want


def test_numbers(spark):
    assert numbers.offer_of_points()[80] == "CDD"
    assert of(spark, numbers.school_gpa_text, "80 UCAS Tariff points / CDD", "AAB", "none") == ["GPA 3.5", "GPA 5", ""]
    assert of(spark, numbers.money, "£17,000 a year", "no", None, "1,234.50") == ["17000", "", "", "1234.50"]
    assert of(spark, numbers.fee_number, "£1,200.50", "£9,000", "", "x") == ["1200.5", "9000", "", ""]
    assert of(spark, numbers.stated_deposit, "You'll pay a £4,000 deposit before CAS.", "a deposit of £500", "£12") == ["£4,000", "£500", ""]
    text_ = "International tuition fee: £18,000 a year\nDuring placement year: £2,500"
    assert of(spark, numbers.fee_in_text, text_, "Pay £900 or £1,900\nA deposit of £99,999", "none") == ["18000", "1900", ""]
    assert of(spark, numbers.is_decimal, "1,000.5", "nan", "", "x", "inf") == [True, False, True, False, False]
    sane = lambda *a: tuple(value(spark, numbers.sane_fee(*(F.lit(x) for x in a))))
    assert sane("18000", "GBP", "a deposit of £4,000", "", False) == ("18000", "GBP")
    assert sane("42500", "AUD", "International tuition fee: £7,000", "", False) == ("7000", "GBP")
    assert sane("5", "GBP", "fee not available", "", False) == ("", "")
    assert sane("9000", "GBP", "All £9,000", "", False) == ("9000", "GBP")
    assert value(spark, numbers.scholarship_amount(F.lit("£1,000 or £2,000"), F.lit(""))) == 2000.0
    assert value(spark, numbers.scholarship_amount(F.lit(""), F.lit("value: £300 and £900"))) == 300.0
    assert value(spark, numbers.pages_of(F.lit(95), F.lit(10))) == 10


def test_scores(spark):
    f = numbers.test_scores(F.lit("IELTS 6.5 overall with no individual band below 6.0. TOEFL iBT 72 overall with a minimum of 17 in each component."))
    assert [value(spark, f[k]) for k in ("ieltsMinOverall", "ieltsMinSection", "toeflMinOverall", "toeflMinSection", "pteMinOverall")] == ["6.5", "6.0", "72", "17", ""]


def test_dates(spark):
    t = lambda v: value(spark, dates.date_token(F.lit(v), DAY))
    assert [t(v) for v in ("August", "september", "31 August", "1st September", "30 September 2026", "31 February", "rolling", "")] == [
        "August 2027", "September 2026", "31 August 2027", "1 September 2026", "30 September 2026", "31 February", "rolling", "",
    ]
    assert value(spark, dates.date_list(F.lit("January, , May 2027"), DAY)) == "January 2027, May 2027"
    assert of(spark, dates.months_of, "1.5 years", "18 months", "24", "x", "2 years 6 months") == ["18", "18", "24", "", "24"]
    assert of(spark, dates.whole_months, "1 year 6 months", "3 years", "12", "1.5 x") == ["6", "36", "12", ""]
    assert of(spark, dates.intake_text, "Sep 2027", "January 2026 May 2026", "Jan 2026, open day", "soon") == ["September 2027", "January 2026, May 2026", "Jan 2026", "soon"]
    assert of(spark, dates.intake_tokens, "Sep-26, Dec 2026,x", "")[0] == ["sep 2026", "dec 2026"]
    assert value(spark, dates.sort_intakes(F.array(F.lit("May 2027"), F.lit("open"), F.lit("January 2027")))) == ["January 2027", "May 2027", "open"]


def test_nested(spark):
    shape = lambda v: [(b.subtitle, b.description) for b in value(spark, nested.metadata(F.lit(v)))]
    assert shape('{"subtitle":"a","description":"x"}') == [("a", ["x"])]
    assert shape('[{"title":"t","description":["", "y"]}, 3]') == [("t", ["y"])]
    assert shape("oops") == [] and shape("") == []
    assert [value(spark, nested.is_metadata(F.lit(v))) for v in ("", "[]", '[{"description":["a"]}]', '[{"description":"a"}]', "{}", "[1]", "x")] == [True, True, True, False, False, False, False]
    doc = json.dumps({"studyLevels": [{"studyLevel": "Foundation Year", "programs": [{"requirements": [{"degree": "HSC", "grade": "GPA of 2.00"}]}]}]})
    assert [tuple(r) for r in value(spark, nested.country_requirements(F.lit(doc), "foundation"))] == [("HSC", "GPA 2.00")]
    rows = F.array(*(F.struct(F.lit(d).alias("degree"), F.lit(g).alias("grade")) for d, g in (("HSC", "a"), ("hsc", "A"), ("HSC", "b"))))
    assert len(value(spark, nested.distinct_requirements(rows))) == 2
    assert [tuple(r) for r in value(spark, nested.bullets(F.lit("- **HSC (Alim):** GPA 3.0\n- **Description:** x")))] == [("HSC", "GPA 3.0")]
    assert value(spark, nested.by_path(F.lit('{"a":{"b":[{"c":"v"}]}}'), "a.b.0.c")) == "v"
    assert value(spark, nested.by_path(F.lit("{}"), "a.b")) == ""
    assert value(spark, nested.signature(F.lit('[{"b":1,"a":2}]'))) == "a,b"


RAW = {
    "courseName": "Art", "courseUrl": "https://x/c", "academicRequirementsMetaData": None, "intakeInfo": "September",
    "courseDuration": "3 years", "currency": "GBP",
}


def record(spark, **more):
    df = spark.read.schema(normalize.RAW).json(spark.sparkContext.parallelize([json.dumps(RAW | more)]))
    return normalize.normalize(df, DAY).collect()[0]


def test_normalize(spark):
    pair = lambda *rows: [{"degree": d, "grade": g} for d, g in rows]
    r = record(spark, requirements=pair(("HSC", "GPA 2.00"), ("HSC", "3.5 GPA 3.5")))
    assert (r.minDegreeName, r.minGpa, r.higherGpa) == ("HSC", "3.5", "")
    r = record(spark, requirements=pair(("HSC", "GPA 2.0"), ("BSc", "50%"), ("Diploma", "x")))
    assert (r.minDegreeName, r.minGpa, r.higherDegreeName, r.higherGpa) == ("HSC", "2.0", "BSc", "2.5")
    r = record(spark, requirements=pair(("BSc", "50%"), ("MSc", "60%")))
    assert (r.minDegreeName, r.higherDegreeName, r.higherGpa) == ("BSc", "MSc", "3.0")
    r = record(spark, requirements=[], tuitionFeeCandidates=[{"label": "International", "amount": "£17,000"}, {"label": "overseas 2", "amount": "£18,000.5"}], tuitionFee="9")
    assert (r.tuitionFee, r.minDegreeName, r.minGpa, r.intakeInfo, r.courseDuration) == ("18000.5", "", "", "September 2026", "36")
    r = record(spark, scholarships=[{"name": "a", "amount": "£5"}, {"name": "b", "amount": "£5", "details": ["d", ""]}])
    assert (r.scholarshipName, r.scholarshipAmount, r.scholarshipMetaData[0].description) == ("a", "5", ["a", "b", "d"])
    assert len(r) == 26


def test_markdown(spark):
    page = "---\nstudy_level: foundation\nsource: a: b\n---\n\n# Cookies\n# T\n## Entry requirements\n| Q | G |\nUCAS tariff points 120\n## B\n### c\nx\n## D\ny"
    meta, body = markdown.front_matter(F.lit(page))
    assert value(spark, meta) == {"study_level": "foundation", "source": "a: b"}
    assert value(spark, markdown.title(body, F.lit("https://x/a-b/"), ("cook*",))) == "T"
    assert value(spark, markdown.title(F.lit("none"), F.lit("https://x/a-b/?q"))) == "A B"
    assert value(spark, markdown.without_section(F.lit(page), "b", 2)).endswith("## D\ny")
    assert "### c" not in value(spark, markdown.without_section(F.lit(page), "b", 2))
    assert value(spark, markdown.without_section(F.lit("## a\n1\n## a\n2\n# z"), "a", 2)) == "# z"
    fees = "### International students\n- Full Time\n- with placement 4 years\n- £9,000 a year\n- Full Time\n- 3 years\n- £8,500\n"
    f = markdown.stage_fields(F.lit(fees + "- **Start:** Sep 2027\nIELTS 6.0 overall with no less than 5.5 in each band"))
    assert tuple(value(spark, f)) == ("September 2027", "3 years", "8500", "GBP", "6.0", "5.5")
    assert value(spark, markdown.drop_column(F.lit("| A | UK | B |\n| --- | --- | --- |\n| 1 | 2 | 3 |"), "uk")).splitlines()[2] == "| 1 | 3 |"
    assert value(spark, markdown.with_level(F.lit("x"), F.lit("other"))).startswith("---\nstudy_level: other")
    assert "study_level: other\nsource" in value(spark, markdown.with_level(F.lit(page), F.lit("other")))
    assert value(spark, markdown.tidy(F.lit("a b  \n\n\n\nc "))) == "a b\n\nc"


def test_cleanup(spark):
    text_ = "# T\n# t\na\n## E\n\n## F\nb\n### 2025/26\nold\n### 2026/27\nnew\n## Home\nhome only\nInternational\nabroad"
    df = spark.createDataFrame([(1, text_)], "id int, body string")
    lines = cleanup.numbered_lines(df, "id", "body")
    back = lambda x: cleanup.rejoined(x, "id", "body").collect()[0].body
    assert back(lines) == text_
    assert back(cleanup.without_repeated_titles(lines, "id")).startswith("# T\na")
    assert "## E" not in back(cleanup.without_empty_headings(lines, "id"))
    assert "old" not in back(cleanup.latest_year_block(lines, "id")) and "new" in back(cleanup.latest_year_block(lines, "id"))
    out = back(cleanup.until_marker(lines, "id", "^## Home", "^International"))
    assert "home only" not in out and "abroad" in out
    assert value(spark, cleanup.ielts_line(F.lit("IELTS: 6.5 (5.5 each)"))) == "IELTS 6.5 overall with no individual band below 5.5"
    assert value(spark, cleanup.first_label(cleanup.label_values(F.lit("**Fee:** £5\n- Award: BSc")), "none", "Award")) == "BSc"
    fees = spark.createDataFrame([(1, "2025\n£1,000\n£2,000\n2026\n£3,000")], "id int, body string")
    assert {(r.year, r.amount) for r in cleanup.first_per_year(cleanup.numbered_lines(fees, "id", "body"), "id").collect()} == {("2025", "1,000"), ("2026", "3,000")}


def test_html(spark):
    page = "<html><body><nav>n</nav><main><h1>T <b>i</b></h1><p>a <a href='/x'>l</a><br>b<p>c<ul><li>one<ul><li>sub</li></ul></li><li>two</ul><table><tr><th>A<th>B</tr><tr><td>1<td>2</tr></table></main></body></html>"
    md = of(spark, html_.to_markdown, page, None)
    assert md[1] == "" and "- one\n  - sub\n- two" in md[0] and "| A | B |\n| --- | --- |\n| 1 | 2 |" in md[0] and "[l](/x)" in md[0] and "n" not in md[0].split("\n")[0]
    assert of(spark, html_.page_title, page, "<title>z</title>") == ["T i", "z"]
    base = F.lit("https://x.uk/a/b.html?q=1")
    assert [value(spark, html_.absolute(F.lit(h), base)) for h in ("c", "/d", "//e/f", "http://g", "#h")] == ["https://x.uk/a/c", "https://x.uk/d", "https://e/f", "http://g", "https://x.uk/a/b.html?q=1#h"]
    assert tuple(value(spark, html_.result_count(F.lit("Showing 1 - 10 of 1,095 results")))) == (1, 10, 1095)


def test_intake_dedupe(spark):
    rows = [(0, "https://x/courses/a-bsc-2026-27", "undergraduate"), (1, "https://x/courses/a-bsc-2027-28", "undergraduate"), (2, "https://x/courses/b", "undergraduate"), (3, "https://x/courses/a-bsc-2026-27", "foundation"), (4, "", "foundation")]
    df = spark.createDataFrame(rows, "ix int, url string, level string")
    kept, skipped = dedupe.latest_intake(df, "url", F.col("level"), F.col("ix"))
    assert {r.ix for r in kept.collect()} == {1, 2, 3} and [r.ix for r in skipped.collect()] == [0]


def test_samples(spark):
    rows = [(f"https://x/{lv}/{k}", lv) for lv in ("undergraduate", "foundation") for k in range(8)]
    df = spark.createDataFrame(rows, "url string, level string")
    assert {(r.level, r["count"]) for r in sample.per_level(df, "url", "level", 5, 1).groupBy("level").count().collect()} == {("undergraduate", 5), ("foundation", 5)}
    assert sample.stratified(df, "url", "level", 5, 1).count() == 5
    assert sample.stratified(df, "url", "level", 99, 1).count() == 16


def test_lookup_levels(spark):
    d = spark.createDataFrame([("undergraduate", "art", "BA"), (None, "art", "MA"), ("foundation", "law", "LLB")], "level string, key string, value string")
    df = spark.createDataFrame([(0, "Art", "undergraduate"), (1, "Art", "foundation"), (2, "Law", ""), (3, "Law", "undergraduate")], "ix int, name string, level string")
    got = {r.ix: r.degree for r in lookup.by_level_then_global(df, d, "name", "level", "ix", "degree").collect()}
    assert got == {0: "BA", 1: "MA", 2: "LLB", 3: None}


def test_validate_scholarship_level(spark):
    wrong = lambda lv, name, said="": value(spark, validate.level_mismatch(F.lit(lv), F.lit(name), nested.metadata(F.lit("")), F.lit(said)))
    assert "undergraduate/foundation got" in wrong("foundation", "Postgraduate award")
    assert "postgraduate got" in wrong("postgraduate_research", "x", "Undergraduate")
    assert wrong("undergraduate", "Undergraduate and postgraduate") == "" and wrong("postgraduate", "") == ""
    issues = validate.document_issues(spark.createDataFrame([("a", "{"), ("b", '{"studyLevels":[]}')], "uni string, doc string"), "uni", "doc", ("foundation",))
    assert {(r.uni, r.code) for r in issues.collect()} == {("a", "INVALID_JSON"), ("b", "MISSING_LEVEL")}
    with pytest.raises(ValueError, match="INVALID_JSON"):
        validate.assert_clean(issues)


def test_files(spark, tmp_path):
    (tmp_path / "u.csv").write_text("﻿url,other\nhttps://x/a, b \n,\nhttps://x/b,\n")
    assert [r.course_url for r in readers.course_urls(spark, str(tmp_path / "u.csv")).collect()] == ["https://x/a", "https://x/b"]
    with pytest.raises(ValueError, match="lacks"):
        readers.csv(spark, str(tmp_path / "u.csv"), ["none"])
    (tmp_path / "i.csv").write_text("sep=\t\nuniName\tcourseName\nU\t\"a\tb\"\n\t\n")
    assert [tuple(r) for r in readers.index_csv(spark, str(tmp_path / "i.csv"), ["uniName"]).collect()] == [("U", "a\tb")]
    for name, body in (("a.json", '{"courses":[{"course_url":"http://1"},"http://2"]}'), ("b.json", '["http://1","http://2"]'), ("c.txt", "# no\nhttp://1\n\nhttp://2,x\n")):
        (tmp_path / name).write_text(body)
        assert sorted(r.course_url for r in readers.url_list(spark, str(tmp_path / name)).collect()) == ["http://1", "http://2"]
    (tmp_path / "d.json").write_text('{"version":2,"byStudyLevel":{"foundation":{"art":"BA"}},"global":{"law":"LLB"}}')
    assert {tuple(r) for r in readers.dictionary(spark, str(tmp_path / "d.json")).collect()} == {(None, "law", "LLB"), ("foundation", "art", "BA")}
    (tmp_path / "p.json").write_text('{"url_levels":{"http://1":{"foundation":"S"}}}')
    assert [tuple(r) for r in readers.progress_levels(spark, str(tmp_path / "p.json")).collect()] == [("http://1", "foundation", "S")]
    (tmp_path / "md" / "x").mkdir(parents=True)
    (tmp_path / "md" / "x" / "a.md").write_text("---\ncourse_url: http://1\n---\n# T\nbody")
    assert [(r.title, r.meta["course_url"]) for r in readers.markdown_files(spark, str(tmp_path / "md")).collect()] == [("T", "http://1")]
    (tmp_path / "r.md").write_text("| Unit | Slug |\n| --- | --- |\n| A | a |\n")
    assert [tuple(r) for r in readers.registry(spark, str(tmp_path / "r.md"), ["unit", "slug"]).collect()] == [("A", "a")]
    assert readers.settings('A=1\n# x\nB="two\nlines"\n') == {"A": "1", "B": "two\nlines"} and readers.setting_list("a;# c\n#x") == ["a", "#x"]
    df = spark.createDataFrame([("http://1", "foundation", [1, 2])], "course_url string, study_level string, n array<int>")
    sinks.csv(df, str(tmp_path / "out.csv"), quote_all=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "out.csv")).collect()[0].n == "[1,2]"
    sinks.level_files(df, str(tmp_path / "levels"))
    assert readers.url_levels(spark, [sinks.level_file(str(tmp_path / "levels"), x) for x in levels.LEVELS]).count() == 1
    missing = sinks.split_by(df, spark.createDataFrame([("foundation",), ("other",)], "study_level string"), "study_level", str(tmp_path / "split"))
    assert [r.study_level for r in missing.collect()] == ["other"]


def test_exported_rows(spark):
    records = normalize.normalize(spark.read.schema(normalize.RAW).json(spark.sparkContext.parallelize([json.dumps(RAW)])), DAY)
    portal = F.struct(F.lit("P").alias("programmeName"), F.lit("BA").alias("degreeName"))
    r = export.course_rows(records, F.lit("U"), F.lit("https://b/"), F.lit("foundation"), portal).collect()[0]
    assert len(r) == 30 and (r.programmeName, r.degreeName, r.courseUrlExternal, r.feesMetaData) == ("P", "BA", "https://b/c", "[]")
    parts = spark.createDataFrame([("k", '{"a":{"b":"v"}}')], "key string, json string")
    assert export.audit_rows(spark.createDataFrame([("k",), ("l",)], "key string"), {"entry": (parts, ["a.b"])}, "key").orderBy("key").collect()[1]["entry.a.b"] == ""


def test_progress(spark, tmp_path):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    events = spark.createDataFrame([("a", 1, "completed"), ("b", 1, "completed"), ("b", 2, "failed")], "k string, t int, status string")
    assert sorted(r.k for r in progress.pending(items, events, "k", "t").collect()) == ["b", "c"]

    def work(v):
        if v == "b":
            raise ValueError("no")
        return v.upper()

    got = {r.k: (r.out, r.error) for r in progress.attempted(items, work, "k", "out").collect()}
    assert got == {"a": ("A", None), "b": (None, "ValueError: no"), "c": ("C", None)}
    picks = progress.in_batches(items, lambda names: {n: "one" if n != "c" else "off list" for n in names}, "k", ["One"]).collect()
    assert sorted((r.k, r.value) for r in picks) == [("a", "One"), ("b", "One")]


def test_listing_stream_equals_its_batch_form(spark, tmp_path):
    rows = [("x", 1, ["a"]), ("x", 2, ["b"]), ("x", 3, ["b"]), ("x", 4, ["b"]), ("x", 5, ["c"]), ("y", 1, []), ("y", 2, []), ("y", 3, ["z"])]
    schema = "key string, page int, urls array<string>"
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)
    batch = progress.listing_batch(spark.read.parquet(src), "key", "page", "urls").select("key", "page", "streak")
    for _ in range(2):  # the second run from the same checkpoint adds nothing
        stream = progress.listing_stream(spark.readStream.schema(schema).parquet(src), "key", "page", "urls")
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).select("key", "page", "streak")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_upserted_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    for n in range(2):
        spark.createDataFrame([("a", n), ("b", n)], "k string, t int").write.mode("append").parquet(src)
        q = progress.upserted(spark.readStream.schema("k string, t int").parquet(src), str(tmp_path / "out"), str(tmp_path / "cp"), "k", "t")
        q.trigger(availableNow=True).start().awaitTermination()
    got = progress.latest_of(spark, str(tmp_path / "out"), "k", "t")
    assert sorted((r.k, r.t) for r in got.collect()) == [("a", 1), ("b", 1)]


def test_stats_mining(spark):
    rows = [(f"https://x/study/courses/c{k}", True) for k in range(5)] + [("https://x/about", False)] * 3
    df = spark.createDataFrame(rows, "url string, hit boolean")
    best = stats.suggested_templates(df, "url", 3).collect()
    assert [(r.template, r.n, r.share) for r in best] == [("^/study/courses/[^/]+$", 5, round(5 / 6, 4))]
    assert [(r.path, r.n) for r in stats.exclusions(df, "url", F.col("hit"), 2).collect()] == [("/about", 3)]


def test_main_part():
    long = "word " * 60
    page = f'<body><div><div class="a page-content b"><p>{long}</p></div></div><div id="content">short</div><div>{long}{long}</div></body>'
    assert html_.main_part(page).startswith('<div class="a page-content b">')
    assert html_.main_part(f"<body><div>a</div><section>{'x' * 50}<div>b</div></section></body>").startswith("<section>")
    assert html_.main_part(None) == ""


def test_configured_blocks(spark):
    page = '<h1>Art</h1><div id="k"><h2>Facts</h2><p>three years of study, full time</p></div><div class="x fees"><p>£9,000 a year for all students</p></div><main><section data-t="tab-entry"><p>A degree in any subject</p></section></main>'
    blocks = [("Facts", "#k"), ("Fees", "span.fees, .fees"), ("Entry", 'main [data-t*="entry"]'), ("None", "#zz"), ("Title", "h1")]
    text_, warnings = html_.page_blocks(page, blocks)
    assert text_.startswith("# Art\n\n## Facts\n\nthree years") and "## Fees\n\n£9,000" in text_ and text_.endswith("A degree in any subject")
    assert warnings == ["None: not found", "Title: too short"]
    assert of(spark, lambda c: html_.blocks_markdown(c, blocks)["markdown"], page, None)[0] == text_
    with pytest.raises(ValueError, match="selector"):
        html_.page_blocks(page, [("a", ">>")])


def test_variant_rows(spark):
    df = spark.createDataFrame([(1, ["full", "part"], ["Sep", "Jan"]), (2, [], None)], "id int, modes array<string>, starts array<string>")
    rows = cleanup.variant_rows(df, "modes", "starts").collect()
    assert sorted((r.id, r.mode or "", r.start or "") for r in rows) == [(1, "full", "Jan"), (1, "full", "Sep"), (1, "part", "Jan"), (1, "part", "Sep"), (2, "", "")]


def test_pages_without_end_tags_nested_tables_and_headers():
    from lodestone.functions.html import page_markdown

    body = "<body><article><header><h1>Name</h1></header><p>Some text.</p></article><footer>f</footer>"
    assert page_markdown(f"<html><head><title>T</title><meta charset=x>{body}") == "# Name\n\nSome text."
    assert page_markdown(f"<html><head><title>T</title></head>{body}") == "# Name\n\nSome text."
    assert page_markdown("<header><h1>Site</h1></header><p>x</p>") == "x"
    table = "<table><tr><th>a</th><th><table><tr><td>in</td></tr></table></th></tr><tr><td>1</td><td>2</td></tr></table>"
    lines = page_markdown(table).splitlines()
    assert lines[0].startswith("| a |") and "in" in lines[0] and lines[-1] == "| 1 | 2 |"


def test_sections_until_a_heading_above(spark):
    body = "# T\n## A\n### Fees\nx\n### Other\ny\n## B\n### Kept\nz"
    one = spark.createDataFrame([(body,)], "b string")
    cut = lambda *a, **k: one.select(markdown.without_section(F.col("b"), *a, **k)).first()[0]
    assert cut("fees", 3, until=2) == "# T\n## A\n## B\n### Kept\nz"
    assert cut("fees", 3) == "# T\n## A\n### Other\ny\n## B\n### Kept\nz"
    assert cut("b", 2) == "# T\n## A\n### Fees\nx\n### Other\ny"
    long = spark.range(1).select(F.concat(F.lit("# T\n"), F.repeat(F.lit("## A\nline\n"), 50000)).alias("b"))
    assert long.select(markdown.without_section(F.col("b"), "a", 2)).first()[0] == "# T"


def test_a_failed_batch_leaves_a_trace(spark):
    from lodestone.streaming import progress

    def ask(names):
        raise RuntimeError("no model")

    rows = progress.in_batches(spark.createDataFrame([("a",), ("b",)], "k string"), ask, "k", ["x"]).collect()
    assert sorted((r.k, r.value, r.error) for r in rows) == [("a", None, "RuntimeError: no model"), ("b", None, "RuntimeError: no model")]


def test_templates(spark, tmp_path):
    from lodestone.sources import catalogue

    for n in (1, 2):
        (tmp_path / f"t{n}.csv").write_text(
            f"\ufeffCourse Type,ALL_COURSE.csv,,\nUni Name,Uni {n},\nUni Link,https://u{n}.example.org\n\n"
            "Programme,ALL Course Listing URL,Page 1\nAll,https://u.example.org/all,,,d\nFoundation,,,,,,,,,note\n"
        )
    rows = catalogue.template(spark, str(tmp_path / "*.csv")).orderBy("university_name", "programme").collect()
    assert [(r.university_name, r.programme, r.all_listing, r.detail, r.comments) for r in rows] == [
        (f"Uni {n}", *x) for n in (1, 2) for x in (("All", "https://u.example.org/all", "d", ""), ("Foundation", "", "", "note"))
    ]
    assert {r.course_type for r in rows} == {"ALL_COURSE.csv"}


def test_selection_of_index_entries(spark):
    from lodestone.sources import catalogue

    rows = spark.createDataFrame([(f"https://u.org/{k}", f"x/{k}.md", "undergraduate" if k % 2 else "foundation") for k in range(6)], "course_url string, md_file string, study_level string")
    picked = lambda **k: sorted(r.md_file for r in catalogue.selected(rows, **k).collect())
    assert picked(md_file="a/3.md", limit=1) == ["x/3.md"]
    assert picked(url_list=["https://u.org/2/?x=1#y", "https://u.org/5"]) == ["x/2.md", "x/5.md"]
    assert picked(levels=["foundation"], limit=2) == ["x/0.md", "x/2.md"]
    assert picked(index=2) == ["x/1.md"] and picked(limit=1) == ["x/0.md"] and len(picked()) == 6


def test_csv_byte_order_mark(spark, tmp_path):
    sinks.csv(spark.createDataFrame([(1, "é, x")], "id int, name string").coalesce(1), str(tmp_path / "c"), bom=True)
    (part,) = (tmp_path / "c").glob("part-*.csv")
    assert part.read_bytes() == "\ufeffid,name\n1,\"é, x\"\n".encode()
    two = spark.createDataFrame([(1, 'é, "x"'), (2, "two\nlines"), (3, None)], "id int, name string")
    for n in (1, 2):
        sinks.csv(two.repartitionByRange(n, "id"), str(tmp_path / f"d{n}"), quote_all=True, bom=True)
        files = [f.read_text(encoding="utf-8") for f in (tmp_path / f"d{n}").glob("part-*")]
        assert len(files) == n and all(f.startswith('\ufeff"id","name"\n') and f.count("\ufeff") == 1 for f in files)
        back = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / f"d{n}"))
        assert sorted(tuple(r) for r in back.fillna("").collect()) == [("1", 'é, "x"'), ("2", "two\nlines"), ("3", "")]
    sinks.csv(two.limit(0), str(tmp_path / "d0"), quote_all=True, bom=True)
    assert "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "d0").glob("part-*")) == '\ufeff"id","name"\n'


def test_drop_ungrounded(spark):
    rows = [("9000", None, "fee £9,000"), ("9000", " ", None), (None, "it's", "none")]
    got = validate.drop_ungrounded(spark.createDataFrame(rows, "fee string, lead string, body string"), ["fee", "lead"], "body").collect()
    assert [(r.fee, r.lead, r.warnings) for r in got] == [
        ("9000", None, []),
        ("", " ", ["fee: dropped ungrounded value '9000'"]),
        (None, "", ["lead: dropped ungrounded value \"it's\""]),
    ]


def test_page_steps(spark):
    urls = [("a", "http://x/l?page=1"), ("a", "http://x/l?page=1"), ("a", "http://x/l?page=9"), ("b", "http://x/l?page=10"),
            ("b", "http://x/l?page=30"), ("c", None)]
    got = stats.page_steps(spark.createDataFrame(urls, "k string, u string"), "u", ["k"])
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 20), ("c", 1)]
    assert stats.page_steps(spark.createDataFrame([], "k string, u string"), "u", ["k"]).count() == 0


def test_template_cells_with_line_breaks(spark, tmp_path):
    from lodestone.sources import catalogue

    (tmp_path / "t.csv").write_text('﻿Course Type,ALL_COURSE.csv\r\nUni Name,"Uni, 1"\r\nUni Link,https://u\r\n\r\nProgramme,All\r\nAll,https://a,,,,,,,,"one\ntwo, ""three"""\r\n')
    rows = catalogue.template(spark, str(tmp_path / "t.csv")).collect()
    assert [(r.university_name, r.programme, r.all_listing, r.comments) for r in rows] == [("Uni, 1", "All", "https://a", 'one\ntwo, "three"')]


def test_an_odd_level_hides_no_issue_of_the_others(spark):
    from lodestone.operators import documents

    text = '{"studyLevels":[5,{"studyLevel":"Undergraduate","programs":[{"program":"p","requirements":[{"degree":"","grade":"60%"}],"description":["d"]}]},null]}'
    docs = spark.createDataFrame([(1, "entry", text), (2, "entry", '{"studyLevels":{}}')], "k int, kind string, doc string")
    got = sorted((r.k, r.code, r.message) for r in documents.issues(docs, "k", "kind", "doc").collect())
    assert got == [
        (1, "invalid_study_level", "studyLevels[0] must be an object"),
        (1, "invalid_study_level", "studyLevels[2] must be an object"),
        (1, "missing_degree", "Undergraduate requirements[0] is missing degree"),
        (1, "missing_pipeline_level", "No studyLevel block found for pipeline level 'foundation'"),
        (1, "missing_pipeline_level", "No studyLevel block found for pipeline level 'postgraduate'"),
        (2, "missing_study_levels", "studyLevels must be a non-empty array"),
    ]


def test_a_file_for_every_level(spark, tmp_path):
    rows = spark.createDataFrame([(f"http://{k}", x) for k, x in enumerate(("foundation", "unheard-of", "foundation"))], "course_url string, study_level string")
    for _ in range(2):  # a second run replaces the first
        sinks.level_files(rows, str(tmp_path / "l"))
        found = {x: spark.read.option("header", True).csv(sinks.level_file(str(tmp_path / "l"), x)) for x in levels.LEVELS}
        assert {x: d.count() for x, d in found.items()} == {x: 2 * (x == "foundation") for x in levels.LEVELS}
        assert all(d.columns == ["course_url", "study_level"] for d in found.values())


def test_index_update_joins_by_path_only(spark):
    from lodestone.operators import resolve

    index = spark.createDataFrame([(f"{k}/index.md", "") for k in range(50)] + [("x/only.md", "old")], "md string, out string")
    done = spark.createDataFrame([("z/index.md", "no"), ("7/index.md", "7"), ("y/only.md", None)], "md string, out string")
    got = {r.md: r.out for r in resolve.index_update(index, done, "md", ["out"]).collect()}
    assert got == {f"{k}/index.md": "7" if k == 7 else "" for k in range(50)} | {"x/only.md": None}
