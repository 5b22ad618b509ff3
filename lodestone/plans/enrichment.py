"""Registered queries of edits and of what several sources say of a course, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import edits, nested
from lodestone.operators import enrichment
from lodestone.plans.inputs import COURSES, derived
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


def _part(spark, sf_dir, *columns):
    return readers.table(spark, sf_dir, "part").selectExpr("p_partkey AS key", *columns)


_HEAD = "CASE doc_id % 4 WHEN 0 THEN 'Fees ' WHEN 1 THEN 'FEES' WHEN 2 THEN 'Costs' ELSE 'Fees' END"
_STOP = "CASE WHEN doc_id % 3 = 0 THEN 'Nothing that stops' WHEN doc_id % 3 = 1 THEN 'About' ELSE 'your CAREER' END"
_LONG = f"concat('# ', source, chr(10), '## ', {_HEAD}, chr(10), 'paid', chr(10), '## Extra', chr(10), '### About', chr(10), '## ', {_STOP}, chr(10), replace(text, '#', '+'))"


@query(rf"""SELECT doc_id, CASE WHEN doc_id % 4 = 2 THEN body WHEN doc_id % 3 = 0 THEN concat('# ', source)
  ELSE regexp_replace(concat('# ', source, chr(10), '## ', {_STOP}, chr(10), replace(text, '#', '+')), '\n\z', '') END AS page FROM (SELECT *, {_LONG} AS body FROM documents)""")
def sections_until(spark, sf_dir):
    docs = readers.table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_LONG} AS body")
    return docs.select("doc_id", edits.without_until(F.col("body"), "Fees", 2, ["About", "Your career"]).alias("page"))


_YEAR = lambda year, mode, fee: f"'### ', {year}, '/27', chr(10), chr(10), '| Type of study | Fees |', chr(10), '| --- | --- |', chr(10), '| Full-time | £', {fee}, ',500 per year |', {mode}, chr(10), chr(10)"
_HOME = lambda k: f"CASE WHEN p_partkey % {k} = 0 THEN concat(chr(10), '| Part-time | £9 per year |') ELSE '' END"
_FEES = f"""concat('## Fees and funding', chr(10), {_YEAR("CAST(2024 + p_partkey % 4 AS STRING)", _HOME(3), "CAST(10 + p_size AS STRING)")},
  {_YEAR("'2026'", _HOME(5), "CAST(20 + p_size AS STRING)")}, 'Part-time study costs less.')"""


@query("""SELECT p_partkey AS key, CASE WHEN p_partkey % 5 <> 0 AND (p_partkey % 3 = 0 OR 2024 + p_partkey % 4 <= 2026) THEN concat(20 + p_size, '500')
  WHEN p_partkey % 3 <> 0 THEN concat(10 + p_size, '500') END AS fee FROM part""")
def latest_year_fees(spark, sf_dir):
    return _part(spark, sf_dir, f"{_FEES} AS body").select("key", edits.latest_full_time_fee(F.col("body")).alias("fee"))


_FACTS = """concat('# ', p_name, chr(10), chr(10), '## Key facts', chr(10), chr(10), '- **Duration:** ', CAST(p_size AS STRING), ' months', chr(10), 'stray line', chr(10),
  CASE WHEN p_partkey % 3 = 0 THEN concat('- **IELTS:** old', chr(10)) ELSE '' END, CASE WHEN p_partkey % 2 = 0 THEN concat('## About', chr(10), p_type) ELSE '' END)"""


@query("""SELECT p_partkey AS key, CASE WHEN p_partkey % 7 = 0 THEN concat('# ', p_name, chr(10), 'plain') ELSE concat('# ', p_name, chr(10), chr(10), '## Key facts', chr(10), chr(10), '- **Duration:** ', p_size, ' months', chr(10),
  '- **ielts:** ', p_size, chr(10), '- **Intake:** ', p_brand, chr(10), CASE WHEN p_partkey % 2 = 0 THEN concat('## About', chr(10), p_type) ELSE '' END) END AS page FROM part""")
def bullets_put(spark, sf_dir):
    rows = _part(spark, sf_dir, f"CASE WHEN p_partkey % 7 = 0 THEN concat('# ', p_name, chr(10), 'plain') ELSE {_FACTS} END AS body", "p_size", "p_brand")
    bullets = F.array(F.lit("- **IELTS:** first"), F.concat(F.lit("- **Intake:** "), "p_brand"), F.lit("no label"), F.concat(F.lit("- **ielts:** "), "p_size"))
    return rows.select("key", edits.with_bullets(F.col("body"), "## Key facts", bullets).alias("page"))


@query("""SELECT p_partkey AS key, concat('Duration=', CASE WHEN p_partkey % 3 = 0 THEN concat(p_size, ' months') ELSE p_type END, ';Start date=', CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END,
  ';Campus=', p_name, ';Fee=') AS facts FROM part""")
def facts_of_two_sources(spark, sf_dir):
    part = readers.table(spark, sf_dir, "part")
    first = F.create_map(F.lit("Duration"), "p_type", F.lit("Campus"), "p_name")
    second = F.create_map(
        F.lit("Duration"), F.when(F.col("p_partkey") % 3 == 0, F.concat("p_size", F.lit(" months"))).otherwise(""),
        F.lit("Start date"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")), F.lit("Campus"), F.lit("other"), F.lit("Fee"), F.lit("1"),
    )
    facts = part.select(F.col("p_partkey").alias("key"), edits.merged_facts(first, second, ["Duration", "Start date"]).alias("m"))
    shown = [F.concat(F.lit(f"{k}="), F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(""))) for k in ("Duration", "Start date", "Campus", "Fee")]
    return facts.select("key", F.concat_ws(";", *shown).alias("facts"))


_AWARDS = """SELECT s_suppkey AS ix, concat('uni', CAST(s_suppkey % 7 AS STRING)) AS uni,
  CASE s_suppkey % 4 WHEN 0 THEN 'Undergraduate, Foundation Year' WHEN 1 THEN 'Postgraduate / postgraduate research' WHEN 2 THEN 'Foundation&Postgraduate' ELSE 'undergraduate' END AS levels,
  concat(CASE WHEN s_suppkey % 5 = 0 THEN 'MBA ' ELSE '' END, s_name) AS name, CASE s_suppkey % 3 WHEN 0 THEN 'percentage' WHEN 1 THEN 'amount' ELSE '' END AS kind,
  concat('From ', s_name) AS eligibility, CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE concat('£', CAST(1 + s_nationkey AS STRING), ',500 or £900') END AS amount,
  CASE WHEN s_suppkey % 2 = 0 THEN concat('Value: £', CAST(s_nationkey AS STRING), '000') ELSE 'Ask us' END AS description FROM supplier"""


@query(f"""WITH c AS ({COURSES}), a AS ({_AWARDS}),
v AS (SELECT *, CASE WHEN amount <> '' THEN (1 + CAST(regexp_extract(amount, '£(\\d+),', 1) AS INT)) * 1000 - 500 WHEN ix % 2 = 0 THEN CAST(regexp_extract(description, '£(\\d+)', 1) AS INT) ELSE -1 END AS worth, ix % 5 = 0 AS of_mba FROM a),
l AS (SELECT v.*, unnest(CASE ix % 4 WHEN 0 THEN ['undergraduate', 'foundation'] WHEN 1 THEN ['postgraduate'] WHEN 2 THEN ['foundation', 'postgraduate'] ELSE ['undergraduate'] END) AS level FROM v),
j AS (SELECT c.ix AS key, c.ix % 3 = 0 AS mba, l.*, row_number() OVER (PARTITION BY c.ix ORDER BY (c.ix % 3 = 0 AND of_mba) DESC, worth DESC, l.ix) AS n
  FROM c JOIN l ON l.uni = c.uni AND l.level = c.level WHERE c.ix % 3 = 0 OR NOT of_mba OR c.level <> 'postgraduate')
SELECT key, name, CASE WHEN worth < 0 THEN '' ELSE CAST(worth AS VARCHAR) END AS amount, CASE WHEN kind = 'percentage' THEN 'Percentage' WHEN kind = 'amount' OR worth >= 0 THEN 'Amount' ELSE '' END AS kind,
  concat_ws('|', eligibility, nullif(amount, ''), description) AS lines FROM j WHERE n = 1""")
def award_choices(spark, sf_dir):
    courses = derived(spark, sf_dir, "courses").select(F.col("ix").alias("key"), "uni", "level", "name", F.when(F.col("ix") % 3 == 0, "The mba, in full").alias("body"))
    awards = spark.sql(_AWARDS.replace("FROM supplier", "FROM {supplier}"), supplier=readers.table(spark, sf_dir, "supplier"))
    a = F.col("award")
    out = enrichment.best_awards(courses, awards, "key", ["uni"])
    return out.select(
        "key", a["scholarshipName"].alias("name"), a["scholarshipAmount"].alias("amount"), a["scholarshipType"].alias("kind"),
        F.array_join(a["scholarshipMetaData"][0]["description"], "|").alias("lines"),
    )


@query("""WITH r AS (SELECT p_partkey AS key, p_partkey % 4 AS q, CAST(4 + p_size % 5 AS VARCHAR) AS s, p_brand, p_partkey % 6 = 5 AS said, p_partkey % 5 = 0 AS worded FROM part),
t AS (SELECT *, CASE WHEN key % 10 = 3 THEN '9.0' WHEN key % 7 = 0 THEN '8.0' WHEN q = 1 THEN concat(s, '.0') WHEN q = 2 THEN '' ELSE concat(s, '.5') END AS io,
  CASE WHEN q = 1 THEN '5.5' WHEN q = 2 THEN '' ELSE '4.0' END AS s2 FROM r)
SELECT key, io AS ielts, s2 AS ielts_section, CASE WHEN q = 3 THEN '80' ELSE '70' END AS toefl, CASE WHEN q = 3 THEN '' ELSE '18' END AS toefl_section, CASE WHEN q IN (1, 2) THEN '51' ELSE '60' END AS pte, CASE WHEN q IN (1, 2) THEN '' ELSE '55' END AS pte_section,
  CASE WHEN worded THEN concat('English Requirement:', p_brand) WHEN said THEN 'English Requirement:told' WHEN io = '' THEN ''
    ELSE concat('English Requirement:IELTS ', io, ' overall', CASE WHEN s2 <> '' THEN concat(' with no element below ', s2) ELSE '' END) END AS blocks FROM t""")
def english_precedence(spark, sf_dir):
    rows = _part(spark, sf_dir, "CAST(4 + p_size % 5 AS STRING) AS s", "p_brand")
    q, key = F.col("key") % 4, F.col("key")
    fields = ("TestName", "ieltsMinOverall", "ieltsMinSection", "toeflMinOverall", "toeflMinSection", "pteMinOverall", "pteMinSection")
    test = lambda **put: F.struct(*(F.coalesce(put.get(f, F.lit(None)), F.lit(None).cast("string")).alias(f) for f in fields))
    ielts = F.when(q == 1, F.concat("s", F.lit(".0"))).otherwise("")
    pte = test(TestName=F.lit("Pearson (PTE)"), pteMinOverall=F.lit(" 51 "))
    programme = F.array(
        test(TestName=F.lit("IELTS UKVI"), ieltsMinOverall=F.lit("1.0")),
        test(TestName=F.lit("IELTS Academic"), ieltsMinOverall=ielts, ieltsMinSection=F.when(q == 1, "5.5")),
        pte,
    )
    toefl = F.array(test(TestName=F.lit("TOEFL iBT"), toeflMinOverall=F.lit("80")))
    tests = F.when(q.isin(1, 2), programme).when(q == 3, toefl)
    text = F.concat(F.lit("IELTS "), "s", F.lit(".5 overall with no element below 4.0. TOEFL 70 with a minimum of 18, PTE 60 with a minimum of 55"))
    answer = {f: F.lit("") for f in fields[1:]} | {"ieltsMinOverall": F.when(key % 7 == 0, "8.0").otherwise(" ")}
    page = {"ieltsMinOverall": F.when(key % 10 == 3, "9.0")}
    block = F.array(F.struct(F.lit("English Requirement").alias("subtitle"), F.array(F.lit("told")).alias("description"))).cast(nested.META)
    out = enrichment.english_fields(answer, tests, text, page, F.when(key % 6 == 5, block), F.when(key % 5 == 0, F.array("p_brand")))
    shown = F.array_join(F.transform(out["blocks"], lambda b: F.concat(b["subtitle"], F.lit(":"), F.array_join(b["description"], "|"))), ";")
    names = {"ielts": "ieltsMinOverall", "ielts_section": "ieltsMinSection", "toefl": "toeflMinOverall", "toefl_section": "toeflMinSection", "pte": "pteMinOverall", "pte_section": "pteMinSection"}
    return rows.select("key", *(out[f].alias(n) for n, f in names.items()), shown.alias("blocks"))


@query("""SELECT p_partkey AS key, array_to_string(list_filter([p_type, p_type, CASE WHEN p_partkey % 2 = 0 THEN p_brand END, CASE WHEN p_partkey % 3 = 0 THEN concat(p_name, ' or more') END,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 <> 0 THEN p_brand END], lambda x: x IS NOT NULL), '|') AS lines FROM part""")
def entry_sources(spark, sf_dir):
    rows = _part(spark, sf_dir, "p_type", "p_brand", "CASE WHEN p_partkey % 3 = 0 THEN concat(p_name, chr(10), '  or more ', chr(10), ' or ', chr(10), p_brand, chr(10)) END AS country")
    document = F.when(F.col("key") % 2 == 0, F.array("p_brand", "p_type", "p_brand"))
    blocks = enrichment.entry_blocks(F.array("p_type", "p_type"), document, F.col("country"))
    return rows.select("key", F.array_join(blocks[0]["description"], "|").alias("lines"))


_JSON = """CASE p_partkey % 5 WHEN 0 THEN '{}' WHEN 1 THEN concat('{"degreeName":" BSc","requirements":[{"grade":"', CAST(p_size AS STRING), '%","degree":"HSC"},{"degree":"","grade":"1"}]}')
 WHEN 2 THEN concat('{"degreeName":" ","AcademicRequirementsMetaData":[{"subtitle":"entry requirements","description":["', p_type, '","', p_brand, '"]},{"subtitle":"English Requirement","description":["x"]}]}')
 WHEN 3 THEN '{"requirements":"none"}' ELSE 'broken' END"""


@query("""SELECT p_partkey AS key, CASE WHEN p_partkey % 5 = 1 THEN '2' ELSE '0' END AS req_count, CASE WHEN p_partkey % 5 = 1 THEN 'degree,grade' ELSE 'empty' END AS req_first_keys,
  CASE WHEN p_partkey % 5 = 1 THEN '1' ELSE '0' END AS req_normalized_count, CASE WHEN p_partkey % 5 = 1 THEN 'true' ELSE 'false' END AS has_degree,
  CASE WHEN p_partkey % 5 = 2 THEN concat(p_type, chr(10), p_brand) ELSE '' END AS entry_text FROM part""")
def record_diagnostics(spark, sf_dir):
    rows = _part(spark, sf_dir, f"{_JSON} AS document")
    return rows.select("key", *(c.alias(n) for n, c in enrichment.diagnostics(F.col("document"), F.lit("undergraduate")).items()))


_RULES = [
    ("postgraduate", "law", 1, "pgdl|diploma", "postgraduate", "Diploma", True), ("postgraduate", "law", 2, "", "postgraduate", "LLM", True),
    ("postgraduate", "", 1, "", "postgraduate", "Master", False), ("postgraduate", "", 2, "", "postgraduate", "{subject}", False),
    ("undergraduate", "", 1, "top-up", "undergraduate", "Top-Up", True), ("undergraduate", "", 2, "", "undergraduate", "Three Year", True),
]
_SUBJECT = "CASE {k} % 3 WHEN 0 THEN 'Law' WHEN 1 THEN 'Business' ELSE 'Art' END"
_OFFERED = f"""SELECT s_suppkey AS ix, s_suppkey % 4 AS uni, CASE WHEN s_suppkey % 2 = 0 THEN 'Postgraduate' ELSE 'Undergraduate' END AS level, {_SUBJECT.format(k="s_suppkey")} AS subject,
  concat(CASE s_nationkey % 5 WHEN 0 THEN 'PG Diploma ' WHEN 1 THEN 'llm ' WHEN 2 THEN 'Master of Business ' WHEN 3 THEN 'top-up Art ' ELSE 'Three Year ' END, s_name) AS name FROM supplier"""
_ASKED = f"""SELECT p_partkey AS key, p_size % 4 AS uni, CASE WHEN p_partkey % 2 = 0 THEN 'postgraduate' ELSE 'undergraduate' END AS level, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE {_SUBJECT.format(k="p_partkey")} END AS subject,
  concat(p_name, CASE p_size % 3 WHEN 0 THEN ' PGDL' WHEN 1 THEN ' Top-Up' ELSE '' END) AS text FROM part"""


@query(f"""WITH a AS ({_ASKED}), o AS ({_OFFERED}),
t AS (SELECT a.*, CASE WHEN level = 'postgraduate' AND subject = 'Law' THEN CASE WHEN contains(text, 'PGDL') THEN ['diploma'] ELSE ['llm'] END WHEN level = 'postgraduate' THEN ['master', lower(subject)]
  WHEN contains(text, 'Top-Up') THEN ['top-up'] ELSE ['three year'] END AS needles FROM a WHERE subject <> ''),
m AS (SELECT t.key, o.name, row_number() OVER (PARTITION BY t.key ORDER BY CASE WHEN contains(lower(o.name), needles[1]) THEN 1 ELSE 2 END, o.ix) AS n FROM t JOIN o ON o.uni = t.uni AND lower(o.level) = t.level AND o.subject = t.subject
  WHERE contains(lower(o.name), needles[1]) OR (len(needles) > 1 AND contains(lower(o.name), needles[2])))
SELECT a.key, m.name AS programme FROM a LEFT JOIN m ON m.key = a.key AND n = 1""")
def subject_programmes(spark, sf_dir):
    courses = spark.sql(_ASKED.replace("FROM part", "FROM {part}"), part=readers.table(spark, sf_dir, "part"))
    offered = spark.sql(_OFFERED.replace("FROM supplier", "FROM {supplier}"), supplier=readers.table(spark, sf_dir, "supplier"))
    rules = spark.createDataFrame(_RULES, "level string, subject string, rank int, pattern string, wanted string, needle string, decides boolean")
    return enrichment.programme_by_rule(courses, offered, rules, "key", ["uni"])


@query("""WITH r AS (SELECT p_partkey AS key, CASE p_size % 4 WHEN 0 THEN '6.0' WHEN 1 THEN '6.5' WHEN 2 THEN '6.5' ELSE '9.0' END AS o, CASE p_size % 4 WHEN 0 THEN '5.5' WHEN 1 THEN '6.0' WHEN 2 THEN '5.5' ELSE '' END AS s FROM part)
SELECT key, CASE WHEN o = '9.0' THEN '' WHEN s = '6.0' THEN concat('IELTS Academic ', o, '/', s, ';PTE 59/54') ELSE concat('IELTS Academic ', o, '/', s, ';PTE 51/51;TOEFL 72/') END AS tests,
  CASE WHEN o = '9.0' THEN '' WHEN s = '6.0' THEN 'upper' ELSE 'lower|valid for 2 years' END AS notes FROM r""")
def band_equivalents(spark, sf_dir):
    rows = _part(spark, sf_dir, "CASE p_size % 4 WHEN 0 THEN '6.0' WHEN 1 THEN '6.5' WHEN 2 THEN ' 6.5' ELSE '9.0' END AS overall", "CASE p_size % 4 WHEN 0 THEN '5.5' WHEN 1 THEN '6.0' WHEN 2 THEN '5.5' END AS section")
    kind = "overall string, section string, others array<struct<name:string,overall:string,section:string>>, notes array<string>"
    bands = spark.createDataFrame([("6.0", "5.5", [("PTE", "51", "51"), ("TOEFL", "72", "")], ["lower", "valid for 2 years"]), ("6.5", "6.0", [("PTE", "59", "54")], ["upper"])], kind)
    overrides = spark.createDataFrame([("6.5", "5.5", "6.0", "5.5")], "overall string, section string, like_overall string, like_section string")
    shown = F.array_join(F.transform("tests", lambda t: F.concat(t["name"], F.lit(" "), t["overall"], F.lit("/"), t["section"])), ";")
    return enrichment.band_tests(rows, bands, overrides).select("key", shown.alias("tests"), F.array_join("notes", "|").alias("notes"))


@query("""SELECT o_orderkey AS key, CASE WHEN o_custkey % 3 <> 0 THEN 'url' END AS url, CASE WHEN o_orderkey % 4 <> 1 THEN 'group' END AS listing FROM orders WHERE o_custkey % 3 <> 0 OR o_orderkey % 4 <> 1""")
def progress_reset(spark, sf_dir):
    orders = readers.table(spark, sf_dir, "orders")
    done = orders.selectExpr("o_orderkey AS key", "concat('https://uni.example.org/list', CAST(o_custkey % 3 AS STRING), '/?level=ug&page=', CAST(o_orderkey AS STRING)) AS url")
    groups = orders.selectExpr("o_orderkey AS id", "concat('scope', CAST(o_orderkey % 4 AS STRING), '::', CAST(o_custkey AS STRING)) AS key")
    seeds = spark.createDataFrame([("scope1", "https://uni.example.org/list0/?level=ug&page=1"), ("scope", None)], "scope string, url string")
    left, listed = enrichment.reset_progress(done, groups, seeds)
    both = left.select("key", F.lit("url").alias("url")).join(listed.select(F.col("id").alias("key"), F.lit("group").alias("listing")), "key", "full")
    return both.select("key", "url", "listing")


@query("""WITH s AS (SELECT concat('u', user_id) AS university, event_type AS phase, event_id % 3 = 0 AS done FROM events)
SELECT 'universities' AS phase, count(DISTINCT university) AS n FROM s UNION ALL SELECT phase, count(DISTINCT university) FILTER (WHERE done) AS n FROM s GROUP BY phase""")
def phase_totals(spark, sf_dir):
    events = readers.table(spark, sf_dir, "events")
    states = events.selectExpr("concat('u', user_id) AS university", "event_type AS phase", "CASE WHEN event_id % 3 = 0 THEN 'done' ELSE 'partial' END AS status")
    return enrichment.phase_summary(states)
