"""Edits and enrichment: blanks, nulls, ties, clashing labels and empty tables."""

from pyspark.sql import functions as F

from lodestone.functions import edits
from lodestone.operators import enrichment


def one(spark, column, **values):
    row = spark.range(1).select(*((F.lit(v).cast("string") if v is None or isinstance(v, str) else v).alias(k) for k, v in values.items()))
    return row.select(column.alias("out")).collect()[0].out


def test_sections_go_up_to_a_stop(spark):
    cut = lambda body, stops=("About",): one(spark, edits.without_until(F.col("b"), "Fees (2026)", 2, list(stops)), b=body)
    assert cut("# T\n## Fees (2026)\nx\n## Next\ny\n### About\nz\n## ABOUT \nend") == "# T\n## ABOUT \nend"
    assert cut("## Fees (2026)\nx\n# About\nend\n") == "# About\nend"  # a heading above may stop too
    assert cut("# T\n## Fees (2026)\nx\n## Next\ny\n") == "# T"
    assert cut("# T\n### Fees (2026)\nx\n") == "# T\n### Fees (2026)\nx\n"
    assert cut("# T\n## Fees (2026) and more\nx") == "# T\n## Fees (2026) and more\nx"
    assert cut("a\n## Fees (2026)\nx\n## About\nb\n## fees (2026)\ny") == "a\n## About\nb"
    assert cut("a\n## Fees (2026)\nx\n## About\nb", ()) == "a"
    assert cut("") == "" and cut(None) is None
    assert cut("## Fees (2026)\n" + "long line of a page\n" * 50_000 + "## About\nb") == "## About\nb"


def test_fee_of_the_latest_year(spark):
    block = lambda year, fee, more="": f"### {year}/27\n\n| Type of study | Fees |\n| --- | --- |\n| Full-time | £{fee} per year |{more}\n\n"
    fee = lambda text: one(spark, edits.latest_full_time_fee(F.col("t")), t=text)
    assert fee(block(2026, "17,000") + block(2025, "16,000")) == "17000"
    assert fee(block(2026, "17,000") + block(2026, "18,000")) == "18000"
    assert fee(block(2027, "9,535", "\n| Part-time | £4,000 per year |") + block(2026, "18,000")) == "18000"
    assert fee(block(2026, "18,000") + "Part-time courses differ.") == "18000"
    assert fee("no fee") is None and fee("") is None and fee(None) is None


def test_bullets_are_put_by_label(spark):
    put = lambda body, *bullets: one(spark, edits.with_bullets(F.col("b"), "## Facts", F.array(*map(F.lit, bullets)).cast("array<string>")), b=body)
    body = "# T\n\n## Facts\n- **A:** 1\nplain\n- **bold**\n\n## More\nx"
    assert put(body, "- **a:** 2", "- **B:** 3", "- **b:** 4", "none") == "# T\n\n## Facts\n\n- **a:** 2\n- **bold**\n- **b:** 4\n## More\nx"
    assert put(body) == "# T\n\n## Facts\n\n- **A:** 1\n- **bold**\n## More\nx"
    assert put("## Facts", "- **A:** 1") == "\n\n## Facts\n\n- **A:** 1\n"
    assert put("no such part", "- **A:** 1") == "no such part" and put(None, "- **A:** 1") is None


def test_facts_of_two_maps(spark):
    m = lambda **kv: F.create_map(*(F.lit(x) for p in kv.items() for x in p)) if kv else F.lit(None).cast("map<string,string>")
    merged = lambda a, b: one(spark, edits.merged_facts(F.col("a"), F.col("b"), ["x", "y"]), a=a, b=b)
    assert merged(m(x="1", z="2"), m(x="3", y="", z="4")) == {"x": "3", "z": "2"}
    assert merged(m(), m(y="1")) == {"y": "1"} and merged(m(x="1"), m()) == {"x": "1"} and merged(m(), m()) == {}


def test_first_section_and_foundation(spark):
    patterns = [r"(?s)A:(.*?);", r"(?s)B:(.*)"]
    assert one(spark, edits.first_section(F.col("t"), patterns), t="B: two \n") == "two"
    assert one(spark, edits.first_section(F.col("t"), patterns), t="B: two A: one ;") == "one"
    assert one(spark, edits.first_section(F.col("t"), patterns), t=None) == ""
    told = lambda level, head, body: one(spark, edits.is_foundation(F.col("l"), F.col("h"), F.col("b")), l=level, h=head, b=body)
    assert told(" Foundation", None, None) and told("x", "foundation", "") and told(None, None, "BA with Foundation  \nFoundation Year")
    assert told(None, None, None) is False and told("undergraduate", "", "foundation years") is False


AWARD = "uni string, ix int, levels string, name string, kind string, eligibility string, amount string, description string"
COURSE = "k int, uni string, level string, name string, body string"


def test_awards_and_the_mba(spark):
    courses = [
        (1, "a", "postgraduate", "MSc", "text"), (2, "a", "postgraduate", "MBA", None), (3, "a", "undergraduate", None, "an mba"),
        (4, "b", "postgraduate", "MSc", ""), (5, "a", "diploma", "D", ""), (6, "a", None, "x", "y"),
    ]
    awards = [
        ("a", 1, "Postgraduate", "First", None, "e", "£500", None), ("a", 2, "postgraduate research", "Second", "", " e ", "£500", "e"),
        ("a", 3, "Postgraduate/undergraduate", "MBA award", "percentage", None, None, None), ("a", 4, "Undergraduate", "U", None, None, None, "£9 total"),
        ("a", 5, "Diploma,", "D", "x", None, "", "none"), ("a", 6, None, "N", None, None, "£99", None),
    ]
    made = enrichment.best_awards(spark.createDataFrame(courses, COURSE), spark.createDataFrame(awards, AWARD), "k", ["uni"])
    got = {r.k: (r.award.scholarshipName, r.award.scholarshipAmount, r.award.scholarshipType) for r in made.collect()}
    # 1: ties go to the earlier; 2 and 3: only the award of the MBA, whatever it is worth; 4: another university; 6: no level
    assert got == {1: ("First", "500", "Amount"), 2: ("MBA award", "", "Percentage"), 3: ("MBA award", "", "Percentage"), 5: ("D", "", "")}
    block = {r.k: r.award.scholarshipMetaData for r in made.collect()}
    assert block[1][0].description == ["e", "£500"] and block[2] == []
    assert enrichment.best_awards(spark.createDataFrame(courses, COURSE), spark.createDataFrame([], AWARD), "k", ["uni"]).count() == 0


def test_rules_find_programmes(spark):
    rules = [("pg", "law", 1, "bar", "PG", "Bar", True), ("pg", "law", 2, "", "PG", "LLM", True), ("pg", "", 1, "", "PG", "MSc", False), ("pg", "", 2, "", "PG", "{subject}", False)]
    rules = spark.createDataFrame(rules, "level string, subject string, rank int, pattern string, wanted string, needle string, decides boolean")
    programmes = [("a", 2, "pg", "Law", "LLM two"), ("a", 1, "pg", "LAW", "llm one"), ("a", 3, "pg", "art", "Modern Art"), ("a", 4, "ug", "art", "MSc art"), ("b", 1, "pg", "law", "Bar"), ("a", 5, "pg", "art", None)]
    programmes = spark.createDataFrame(programmes, "uni string, ix int, level string, subject string, name string")
    courses = [(1, "a", "PG", "Law", "x"), (2, "a", "pg", "law", "The BAR course"), (3, "a", "pg", "Art", None), (4, "a", "pg", "", "x"), (5, "a", "ug", "law", "x"), (6, "b", "pg", "law", "bar")]
    courses = spark.createDataFrame(courses, "k int, uni string, level string, subject string, text string")
    got = {r.k: r.programme for r in enrichment.programme_by_rule(courses, programmes, rules, "k", ["uni"]).collect()}
    # 2: the rule on the bar decides, so that the LLM is not tried
    assert got == {1: "llm one", 2: None, 3: "Modern Art", 4: None, 5: None, 6: "Bar"}


def test_progress_starts_anew(spark):
    done = spark.createDataFrame([("https://u.ac.uk/list?page=3",), ("https://u.ac.uk/list?level=ug&page=3",), ("https://u.ac.uk/other",), (None,)], "url string")
    groups = spark.createDataFrame([("s::a",), ("s2::a",), ("s",), (None,)], "key string")
    seeds = spark.createDataFrame([("s", "https://u.ac.uk/list?page=1"), ("s", None), ("", None)], "scope string, url string")
    left, listed = enrichment.reset_progress(done, groups, seeds)
    assert sorted(str(r.url) for r in left.collect()) == ["None", "https://u.ac.uk/list?level=ug&page=3", "https://u.ac.uk/other"]
    assert sorted(str(r.key) for r in listed.collect()) == ["None", "s", "s2::a"]
    left, listed = enrichment.reset_progress(done, groups, seeds.limit(0))
    assert left.count() == 4 and listed.count() == 4


def test_phase_totals_of_nothing(spark):
    states = spark.createDataFrame([("a", "x", "done"), ("a", "x", "done"), ("b", "x", "partial"), ("b", "y", None)], "university string, phase string, status string")
    assert {r.phase: r.n for r in enrichment.phase_summary(states).collect()} == {"universities": 2, "x": 1, "y": 0}
    assert [tuple(r) for r in enrichment.phase_summary(states.limit(0)).collect()] == [("universities", 0)]
