"""Registered queries over reference documents, settings, index rows and stage rows, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import dates, levels, nested, numbers, text
from lodestone.operators import cleanup, dedupe, documents, export, lookup, validate
from lodestone.plans.inputs import COURSES, derived
from lodestone.sources import catalogue, readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.table(spark, sf_dir, "part")




def _key() -> Column:
    return F.col("p_partkey")


_ENTRY = '{"studyLevels":[{"studyLevel":"%s","programs":[{"program":"%s","requirements":[{"degree":"%s","grade":"%s"}],"description":[%s]}]}]}'


def _entry(spark, sf_dir):
    level = F.when(_key() % 5 == 0, "Nowhere").when(_key() % 2 == 0, "Undergraduate").otherwise("Foundation Year")
    degree = F.when(_key() % 7 == 0, "").when(_key() % 3 == 0, "MSc").otherwise("HSC")
    grade = F.when(_key() % 11 == 0, " ").otherwise(F.concat(F.col("p_size") + 40, F.lit("%")))
    doc = F.format_string(_ENTRY, level, F.col("p_name"), degree, grade, F.when(_key() % 4 == 0, "").otherwise('"a", " b "'))
    return _part(spark, sf_dir).select("p_partkey", "p_name", F.lit("entry").alias("kind"), F.when(_key() % 13 == 0, "[1").otherwise(doc).alias("doc"))


@query("""WITH d AS (SELECT *, CASE WHEN p_partkey % 5 = 0 THEN 'Nowhere' WHEN p_partkey % 2 = 0 THEN 'Undergraduate' ELSE 'Foundation Year' END AS lvl,
  CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN 'MSc' ELSE 'HSC' END AS deg FROM part),
ok AS (SELECT * FROM d WHERE p_partkey % 13 <> 0), known AS (SELECT * FROM ok WHERE lvl <> 'Nowhere')
SELECT p_partkey, 'entry' AS kind, 'ERROR' AS severity, 'json_parse_failed' AS code, 'Could not parse the entry document' AS message FROM d WHERE p_partkey % 13 = 0
UNION ALL SELECT p_partkey, 'entry', 'ERROR', 'unknown_study_level', 'studyLevel "Nowhere" is no known level' FROM ok WHERE lvl = 'Nowhere'
UNION ALL SELECT p_partkey, 'entry', 'WARN', 'missing_description', concat(lvl, ' programs[0] has empty description[]') FROM known WHERE p_partkey % 4 = 0
UNION ALL SELECT p_partkey, 'entry', 'ERROR', 'missing_degree', concat(lvl, ' requirements[0] is missing degree') FROM known WHERE deg = ''
UNION ALL SELECT p_partkey, 'entry', 'ERROR', 'missing_grade', concat(lvl, ' requirements[0] is missing grade') FROM known WHERE deg <> '' AND p_partkey % 11 = 0
UNION ALL SELECT p_partkey, 'entry', 'ERROR', 'degree_unmapped', concat(lvl, ' requirements[0].degree "MSc" canonicalizes to "MSc"') FROM known WHERE deg = 'MSc' AND p_partkey % 11 <> 0
UNION ALL SELECT p_partkey, 'entry', 'WARN', 'missing_pipeline_level', concat('No studyLevel block found for pipeline level ''', l, '''')
  FROM ok, (SELECT unnest(['foundation', 'undergraduate', 'postgraduate']) AS l)
  WHERE l <> CASE lvl WHEN 'Undergraduate' THEN 'undergraduate' WHEN 'Foundation Year' THEN 'foundation' ELSE '' END""")
def entry_document_issues(spark, sf_dir):
    return documents.issues(_entry(spark, sf_dir), "p_partkey", "kind", "doc")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE concat('# Entry Requirements', chr(10), chr(10), '## ',
  CASE WHEN p_partkey % 5 = 0 THEN 'Nowhere' WHEN p_partkey % 2 = 0 THEN 'Undergraduate' ELSE 'Foundation Year' END, chr(10), chr(10), '- **Program:** ', p_name,
  CASE WHEN p_partkey % 11 = 0 THEN '' ELSE concat(chr(10), '- **', CASE WHEN p_partkey % 7 = 0 THEN 'Qualification' WHEN p_partkey % 3 = 0 THEN 'MSc' ELSE 'HSC' END, ':** ', p_size + 40, '%') END,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE concat(chr(10), '- **Description:** a b') END, chr(10)) END AS page FROM part""")
def entry_document_pages(spark, sf_dir):
    page = F.when(_key() % 13 == 0, "").otherwise(documents.entry_page(F.col("doc")))
    return _entry(spark, sf_dir).select("p_partkey", page.alias("page"))


def _english(spark, sf_dir):
    level = F.when(_key() % 3 == 0, "").when(_key() % 4 == 0, "Sixth form").otherwise("Postgraduate")
    name = F.when(_key() % 10 == 0, "group c").otherwise(F.col("p_name"))
    row = '{"TestStudyLevel":"%s","ProgramName":"%s","TestRequirements":[{"TestName":"IELTS","ieltsMinOverall":"6.5","ieltsMinSection":"6.0"},{"pteMinOverall":"60"}],"description":[]}'
    return _part(spark, sf_dir).select(
        "p_partkey", "p_name", F.lit("english").alias("kind"), F.when(_key() % 17 == 0, "[]").when(_key() % 19 == 0, "[1]").otherwise(F.concat(F.lit("["), F.format_string(row, level, name), F.lit("]"))).alias("doc")
    )


@query("""SELECT p_partkey, 'english' AS kind, CASE WHEN p_partkey % 17 = 0 OR p_partkey % 19 = 0 THEN 'ERROR' ELSE 'WARN' END AS severity,
  CASE WHEN p_partkey % 17 = 0 THEN 'json_parse_failed' WHEN p_partkey % 19 = 0 THEN 'invalid_row' WHEN p_partkey % 3 = 0 THEN 'english_no_study_level' ELSE 'unknown_english_study_level' END AS code,
  CASE WHEN p_partkey % 17 = 0 THEN 'Could not parse the english document' WHEN p_partkey % 19 = 0 THEN 'english[0] must be an object'
       WHEN p_partkey % 3 = 0 THEN '1 row(s) missing TestStudyLevel' ELSE 'english[0] TestStudyLevel "Sixth form"' END AS message
FROM part WHERE p_partkey % 17 = 0 OR p_partkey % 19 = 0 OR (p_partkey % 10 <> 0 AND (p_partkey % 3 = 0 OR p_partkey % 4 = 0))""")
def english_document_issues(spark, sf_dir):
    return documents.issues(_english(spark, sf_dir), "p_partkey", "kind", "doc")


@query("""SELECT p_partkey, concat('# English Language Requirements', chr(10), chr(10), '## ', CASE WHEN p_partkey % 3 = 0 THEN 'Requirements' WHEN p_partkey % 4 = 0 THEN 'Sixth form' ELSE 'Postgraduate' END,
  chr(10), chr(10), '- **Program:** ', CASE WHEN p_partkey % 10 = 0 THEN 'group c' ELSE p_name END, chr(10),
  '- **IELTS:** 6.5 overall, 6.0 minimum per section', chr(10), '- **Test:** 60 overall,  minimum per section', chr(10)) AS page FROM part WHERE p_partkey % 17 <> 0 AND p_partkey % 19 <> 0""")
def english_document_pages(spark, sf_dir):
    rows = _english(spark, sf_dir).where("doc not in ('[]', '[1]')")
    return rows.select("p_partkey", documents.english_page(F.col("doc")).alias("page"))


def _scholarships(spark, sf_dir):
    level = F.when(_key() % 3 == 0, "").when(_key() % 4 == 0, "Doctors").otherwise("Undergraduate, Postgraduate")
    row = '[{"scholarshipName":"%s","scholarshipType":"%s","scholarshipStudyLevel":"%s","Amount":"%d"}]'
    kind = F.when(_key() % 5 == 0, "").when(_key() % 5 == 1, "PERCENTAGE").when(_key() % 5 == 2, "10% off").when(_key() % 5 == 3, "£ off").otherwise("gift")
    doc = F.format_string(row, F.col("p_name"), kind, level, F.col("p_size"))
    return _part(spark, sf_dir).select("p_partkey", F.lit("scholarships").alias("kind"), kind.alias("type"), F.when(_key() % 17 == 0, "{}").otherwise(doc).alias("doc"))


@query("""SELECT p_partkey, 'scholarships' AS kind, CASE WHEN p_partkey % 17 = 0 THEN 'ERROR' ELSE 'WARN' END AS severity,
  CASE WHEN p_partkey % 17 = 0 THEN 'json_parse_failed' WHEN p_partkey % 3 = 0 THEN 'missing_scholarship_study_level' ELSE 'scholarship_level_unmatched' END AS code,
  CASE WHEN p_partkey % 17 = 0 THEN 'Could not parse the scholarship document' WHEN p_partkey % 3 = 0 THEN concat('scholarship[0] "', p_name, '"') ELSE 'scholarshipStudyLevel "Doctors"' END AS message
FROM part WHERE p_partkey % 17 = 0 OR p_partkey % 3 = 0 OR p_partkey % 4 = 0""")
def scholarship_document_issues(spark, sf_dir):
    return documents.issues(_scholarships(spark, sf_dir), "p_partkey", "kind", "doc")


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN 'Percentage' WHEN 2 THEN 'Percentage' WHEN 3 THEN 'Amount' ELSE '' END AS kind FROM part""")
def scholarship_types(spark, sf_dir):
    return _scholarships(spark, sf_dir).select("p_partkey", documents.scholarship_type(F.col("type")).alias("kind"))


@query("""SELECT p_partkey, concat('# Scholarships', chr(10), chr(10), '## ', p_name, chr(10), chr(10),
  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN concat('- **Type:** PERCENTAGE', chr(10)) WHEN 2 THEN concat('- **Type:** 10% off', chr(10)) WHEN 3 THEN concat('- **Type:** £ off', chr(10)) ELSE concat('- **Type:** gift', chr(10)) END,
  CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 4 = 0 THEN concat('- **Study level:** Doctors', chr(10)) ELSE concat('- **Study level:** Undergraduate, Postgraduate', chr(10)) END,
  '- **Amount:** ', p_size, chr(10)) AS page FROM part WHERE p_partkey % 17 <> 0""")
def scholarship_document_pages(spark, sf_dir):
    rows = _scholarships(spark, sf_dir).where("doc <> '{}'")
    return rows.select("p_partkey", documents.scholarships_page(F.col("doc")).alias("page"))


def _deposit(spark, sf_dir):
    meta = F.when(_key() % 2 == 0, '[{"subtitle":"Fees","description":["pay", "early"]}]').otherwise("[]")
    doc = F.format_string('{"initialDeposit":"%s","feesMetaData":%s}', F.when(_key() % 3 == 0, "").otherwise(F.concat(F.lit("£"), F.col("p_size"))), meta)
    return _part(spark, sf_dir).select("p_partkey", F.lit("deposit").alias("kind"), F.when(_key() % 17 == 0, "[]").otherwise(doc).alias("doc"))


@query("""SELECT p_partkey, 'deposit' AS kind, CASE WHEN p_partkey % 17 = 0 THEN 'ERROR' ELSE 'WARN' END AS severity,
  CASE WHEN p_partkey % 17 = 0 THEN 'json_parse_failed' ELSE 'missing_deposit_fields' END AS code,
  CASE WHEN p_partkey % 17 = 0 THEN 'Could not parse the deposit document' ELSE 'deposit JSON should include initialDeposit and/or feesMetaData' END AS message
FROM part WHERE p_partkey % 17 = 0 OR (p_partkey % 3 = 0 AND p_partkey % 2 = 1)""")
def deposit_document_issues(spark, sf_dir):
    return documents.issues(_deposit(spark, sf_dir), "p_partkey", "kind", "doc")


@query("""SELECT p_partkey, concat('# Tuition Fee Deposit', chr(10), CASE
  WHEN p_partkey % 2 = 0 THEN concat(chr(10), '## Fees', chr(10), chr(10), CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('- **Amount:** £', p_size, chr(10)) END, '- **Description:** pay early', chr(10))
  WHEN p_partkey % 3 = 0 THEN '' ELSE concat(chr(10), '## Initial Deposit', chr(10), chr(10), '- **Amount:** £', p_size, chr(10)) END) AS page FROM part WHERE p_partkey % 17 <> 0""")
def deposit_document_pages(spark, sf_dir):
    rows = _deposit(spark, sf_dir).where("doc <> '[]'")
    return rows.select("p_partkey", documents.deposit_page(F.col("doc")).alias("page"))


@query("""SELECT p_partkey, CAST(p_size * 1000 AS VARCHAR) AS "tuitionFee", CASE WHEN p_partkey % 3 = 0 THEN 'EUR' ELSE 'GBP' END AS currency,
  CASE WHEN p_partkey % 2 = 0 THEN 'September 2026' ELSE 'September 2027' END AS "intakeInfo", CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '24' END AS "courseDuration",
  '6.5' AS "ieltsMinOverall", '' AS "initialDeposit", p_name AS "programmeName", 'ok' AS "Result" FROM part""")
def parsed_stage_rows(spark, sf_dir):
    stage = F.format_string(
        '{"tuitionFee":"£%s per year","currency":"%s","intakeInfo":"%s","courseDuration":"%s","ieltsMinOverall":" 6.5 "}',
        F.format_number(F.col("p_size") * 1000, 0), F.when(_key() % 3 == 0, "EUR").otherwise(" "),
        F.when(_key() % 2 == 0, "September 2026").otherwise("Sep 2027"), F.when(_key() % 5 == 0, "full time").otherwise("2 years"),
    )
    row = documents.parsed_row(stage, F.lit("u"), F.lit("https://u.example.org/c"), F.col("p_name"), F.lit("BSc"))
    return _part(spark, sf_dir).select("p_partkey", row.alias("r")).select(
        "p_partkey", *(f"r.{c}" for c in ("tuitionFee", "currency", "intakeInfo", "courseDuration", "ieltsMinOverall", "initialDeposit", "programmeName", "Result"))
    )


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat(CASE WHEN p_partkey % 2 = 0 THEN 'HSC' ELSE 'A Level' END, '=', p_size, '%') END AS requirements,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'Entry Requirements' END AS academic, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS "scholarshipName",
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_size * 100 AS VARCHAR) END AS "scholarshipAmount", CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'Amount' END AS "scholarshipType" FROM part""")
def model_stage_rows(spark, sf_dir):
    answer = F.format_string(
        '```json\n{"requirements":[{"degree":"%s","grade":"%d%%"},{"degree":"MSc","grade":""}],"AcademicRequirementsMetaData":[{"subtitle":"entry requirements","description":"x"},{"subtitle":"Other","description":["y"]}],'
        '"scholarshipName":" %s ","scholarshipAmount":"£%d00 off","scholarshipType":"£ off","invented":1}\n```',
        F.when(_key() % 2 == 0, "HSC").otherwise("A Level"), F.col("p_size"), F.col("p_name"), F.col("p_size"),
    )
    row = documents.model_row(F.when(_key() % 5 == 0, "sorry").otherwise(answer), "undergraduate")
    rows = _part(spark, sf_dir).select("p_partkey", row.alias("r"))
    return rows.select(
        "p_partkey",
        F.array_join(F.transform("r.requirements", lambda x: F.concat(x["degree"], F.lit("="), x["grade"])), ";").alias("requirements"),
        F.array_join(F.transform("r.AcademicRequirementsMetaData", lambda x: x["subtitle"]), ";").alias("academic"),
        "r.scholarshipName", "r.scholarshipAmount", "r.scholarshipType",
    )


# --- settings, index rows and names ---------------------------------------------------------------------------------


def _settings(spark, sf_dir):
    s = readers.table(spark, sf_dir, "supplier").withColumn("path", F.col("s_name"))
    k = F.col("s_suppkey")
    pairs = F.array(
        F.struct(F.lit("COURSE_CATALOGUE_URL").alias("key"), F.when(k % 3 == 0, "").otherwise("https://A.example.org/c//").alias("value")),
        F.struct(F.lit("FOUNDATION_COURSE_CATALOGUE_URL").alias("key"), F.when(k % 5 == 0, "no url").otherwise("").alias("value")),
        F.struct(F.lit("FOUNDATION_COURSE_CATALOGUE_HTML").alias("key"), F.when(k % 5 == 0, "f.html").otherwise("").alias("value")),
        *(
            F.struct(F.lit(f"UNDERGRADUATE_COURSE_LISTING_PAGE_{n}").alias("key"), F.when((k % 4 != n), F.lit(f"https://u.example.org/s/?page={min(n, 2)}")).otherwise("").alias("value"))
            for n in (1, 2, 3)
        ),
        F.struct(F.lit("OTHER").alias("key"), F.lit("x").alias("value")),
    )
    return s.select("path", F.explode(pairs).alias("s")).select("path", "s.key", "s.value")


@query("""SELECT s_name AS path, '' AS scope, 'https://A.example.org/c' AS catalogue_url, '' AS catalogue_html, 'a.example.org' AS domain, 'url' AS source FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT s_name, 'FOUNDATION', 'no url', 'f.html', '', 'error' FROM supplier WHERE s_suppkey % 5 = 0""")
def catalogue_sources(spark, sf_dir):
    return catalogue.catalogue_sources(_settings(spark, sf_dir))


@query("""SELECT s_name AS path, 'UNDERGRADUATE' AS scope, n AS at, concat('https://u.example.org/s/?page=', n) AS url, '/s' AS search_path
FROM supplier, (SELECT unnest([1, 2]) AS n) WHERE s_suppkey % 4 = 0 OR n < s_suppkey % 4""")
def listing_seeds(spark, sf_dir):
    return catalogue.listing_seeds(_settings(spark, sf_dir))


@query(f"""WITH c AS ({COURSES}), e AS (SELECT ix, level, url, concat(CASE WHEN ix % 2 = 0 THEN 'clean/courses/' ELSE '' END, ix, '.md') AS md FROM c)
SELECT ix, md AS md_file, concat('clean/courses/', ix, '.md') AS clean_md, CASE WHEN ix % 3 = 0 THEN concat(level, '/x', ix, '/normalized.json') ELSE '' END AS "normalized.json",
  CASE WHEN ix % 5 = 0 THEN concat(level, '/x', ix, '/stage1.json') ELSE '' END AS "stage1.json" FROM e""")
def index_artefacts(spark, sf_dir):
    c = derived(spark, sf_dir, "courses")
    index = c.select(
        "uni", F.col("uni").alias("uniName"), F.col("name").alias("courseName"), F.lit("").alias("degreeName"), F.concat(F.lit(" https://u.example.org/courses/x"), "ix").alias("courseUrlExternal"),
        F.concat(F.when(F.col("ix") % 2 == 0, "clean/courses/").otherwise(""), "ix", F.lit(".md")).alias("md_file"), F.col("level").alias("study_level"),
    )
    name = F.explode(F.array_compact(F.array(F.when(F.col("ix") % 3 == 0, "normalized.json"), F.when(F.col("ix") % 5 == 0, "stage1.json"))))
    files = c.select("level", "ix", name.alias("name")).select(F.concat("level", F.lit("/x"), "ix", F.lit("/"), "name").alias("path"))
    out = catalogue.with_artefacts(catalogue.index_entries(index), files, ["normalized.json", "stage1.json"])
    ix = F.regexp_extract("course_url", r"x(\d+)$", 1).cast("bigint")
    return out.select(ix.alias("ix"), "md_file", "clean_md", "`normalized.json`", "`stage1.json`")


@query(f"""WITH c AS ({COURSES}) SELECT level, CAST(count(*) FILTER (WHERE ix % 3 = 0) AS BIGINT) AS with_record, CAST(count(*) FILTER (WHERE ix % 3 <> 0) AS BIGINT) AS without FROM c GROUP BY level""")
def index_records(spark, sf_dir):
    c = derived(spark, sf_dir, "courses").withColumn("course_url", F.concat(F.lit("https://u.example.org/courses/x"), "ix"))
    entries = c.select("ix", "course_url", F.col("level").alias("study_level"))
    records = c.where("ix % 3 = 0").select(F.col("level").alias("study_level"), F.concat(F.lit("x"), "ix").alias("slug"))
    found, without = catalogue.with_record(entries, records)
    both = found.select("study_level", F.lit(1).alias("f"), F.lit(0).alias("w")).unionByName(without.select("study_level", F.lit(0).alias("f"), F.lit(1).alias("w")))
    return both.groupBy(F.col("study_level").alias("level")).agg(F.sum("f").alias("with_record"), F.sum("w").alias("without"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '../course_listing/a/b.html' WHEN 1 THEN '../x/y.html' WHEN 2 THEN '../course_listing/name.html'
  WHEN 3 THEN '../course_listing/p.html' WHEN 4 THEN 'x/y.html' ELSE '../uni_req/z.html' END AS path, replace(replace(p_name, ' ', '\\ '), '.', '\\.') AS css FROM part""")
def portable_names(spark, sf_dir):
    raw = F.when(_key() % 6 == 0, '"C:\\Users\\me\\course_listing\\a\\b.html"').when(_key() % 6 == 1, "../x/y.html").when(_key() % 6 == 2, "/home/me/name.html").when(_key() % 6 == 3, "p.html").when(_key() % 6 == 4, "x/y.html").otherwise("/d/uni_req//z.html")
    return _part(spark, sf_dir).select("p_partkey", catalogue.portable_path(raw).alias("path"), catalogue.css_name(F.col("p_name")).alias("css"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'February,September' WHEN 1 THEN 'January,May,October' ELSE '' END AS months,
  p_partkey % 3 = 0 AND p_partkey % 2 = 0 AS candidate,
  concat('# Deposit Notes', chr(10), chr(10), 'Source file: clean/uni/deposit-notes.md', chr(10), chr(10), p_name) AS section FROM part""")
def specification_facts(spark, sf_dir):
    spec = F.when(_key() % 3 == 0, "UCIF  Standard intake points (months): Feb, Sept & Feb. Course title").when(_key() % 3 == 1, "Standard intake point January and May; Oct Final award BSc").otherwise("none")
    body = F.concat(F.lit("# T\n## International entry requirements\n"), F.when(_key() % 3 == 0, "varies by institution").otherwise("as stated"), F.lit("\n## Fees\nvaries by institution"))
    level = F.when(_key() % 2 == 0, " Postgraduate ").otherwise("undergraduate")
    ok = catalogue.derive_candidates(body, level, ["postgraduate"], "International entry requirements", ["(?i)by institution"])
    page = F.concat(F.lit("---\nkind: uni\n---\n\n"), F.col("p_name"), F.lit("\n"))
    return _part(spark, sf_dir).select(
        "p_partkey", F.array_join(catalogue.intake_points(spec), ",").alias("months"), ok.alias("candidate"), catalogue.section_text(F.lit("deposit-notes.md"), page).alias("section")
    )


# --- lines of pages -------------------------------------------------------------------------------------------------

_L = "chr(10)"


def _lines(spark, sf_dir, *parts) -> DataFrame:
    rows = _part(spark, sf_dir).select("p_partkey", F.concat_ws("\n", *parts).alias("body"))
    return cleanup.numbered_lines(rows, "p_partkey", "body")


@query(f"""SELECT p_partkey, concat('# ', p_name, {_L}, 'intro', {_L}, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE concat('# Other', {_L}) END, 'end') AS body FROM part""")
def repeated_titles(spark, sf_dir):
    lines = _lines(spark, sf_dir, F.concat(F.lit("# "), "p_name"), F.lit("intro"), F.when(_key() % 2 == 0, F.concat(F.lit("#  "), F.upper("p_name"))).otherwise("# Other"), F.lit("end"))
    return cleanup.rejoined(cleanup.without_repeated_titles(lines, "p_partkey"), "p_partkey", "body")


@query(f"""SELECT p_partkey, concat('# T', {_L}, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('## Fees', {_L}, p_name, {_L}) END, '## More', {_L}, 'text') AS body FROM part""")
def empty_headings(spark, sf_dir):
    lines = _lines(spark, sf_dir, F.lit("# T"), F.lit("## Fees"), F.when(_key() % 3 == 0, " ").otherwise(F.col("p_name")), F.lit("## More"), F.lit("text"))
    return cleanup.rejoined(cleanup.without_empty_headings(lines, "p_partkey"), "p_partkey", "body")


@query(f"""SELECT p_partkey, concat('# T', {_L}, '## Entry', {_L}, CASE WHEN p_partkey % 4 = 0 THEN concat('### Bangladesh', {_L}, p_name, {_L}) ELSE '' END, '## More', {_L}, 'text') AS body FROM part""")
def country_blocks(spark, sf_dir):
    country = F.when(_key() % 4 == 0, "Bangladesh").otherwise("Norway")
    lines = _lines(spark, sf_dir, F.lit("# T"), F.lit("## Entry"), F.concat(F.lit("### "), country), F.col("p_name"), F.lit("## More"), F.lit("text"))
    return cleanup.rejoined(cleanup.only_blocks(lines, "Entry", ["Bangladesh"]), "p_partkey", "body")


@query(f"""SELECT p_partkey, concat('# T', {_L}, CASE WHEN p_partkey % 2 = 0 THEN concat('## 2027/28', {_L}, 'new') ELSE concat('## 2026/27', {_L}, 'old') END) AS body FROM part""")
def year_blocks(spark, sf_dir):
    lines = _lines(spark, sf_dir, F.lit("# T"), F.lit("## 2026/27\nold"), F.when(_key() % 2 == 0, "## 2027/28\nnew").otherwise("## 2025/26\nolder"))
    return cleanup.rejoined(cleanup.latest_year_block(lines, "p_partkey"), "p_partkey", "body")


@query(f"""SELECT p_partkey, concat('a', {_L}, CASE WHEN p_partkey % 2 = 0 THEN concat('Back on', {_L}, 'end') ELSE concat(p_name, {_L}, 'end') END) AS body FROM part""")
def marked_lines(spark, sf_dir):
    lines = _lines(spark, sf_dir, F.lit("a"), F.when(_key() % 2 == 0, "Switch off\nhidden\nBack on").otherwise(F.col("p_name")), F.lit("end"))
    return cleanup.rejoined(cleanup.until_marker(lines, "p_partkey", "^Switch off", "^Back on"), "p_partkey", "body")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Home students|| fee | 1 |' ELSE 'Overseas students|| fee | 2 |' END AS rows FROM part""")
def carried_table_rows(spark, sf_dir):
    lines = _lines(spark, sf_dir, F.when(_key() % 2 == 0, "Home students\n| fee | 1 |\nPartners\n| fee | 3 |").otherwise("Partners\n| fee | 3 |\nOverseas students\n| fee | 2 |"))
    kept = cleanup.carried_rows(lines, "p_partkey", r"^(Home students|Overseas students|Partners)$", "Partners")
    return kept.groupBy("p_partkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", "line"))), lambda r: r["line"]), "|").alias("rows"))


@query("""SELECT p_partkey, y AS year, CASE y WHEN '2026' THEN CAST(p_size AS VARCHAR) ELSE '9' END AS amount FROM part, (SELECT unnest(['2026', '2027']) AS y) WHERE y = '2026' OR p_partkey % 2 = 0""")
def amounts_per_year(spark, sf_dir):
    lines = _lines(spark, sf_dir, F.lit("Fees 2026"), F.concat(F.lit("£"), "p_size"), F.lit("£7"), F.when(_key() % 2 == 0, "In 2027:\n£9").otherwise("none"))
    return cleanup.first_per_year(lines, "p_partkey")


@query("""SELECT p_partkey, p_name AS duration, CASE WHEN p_partkey % 2 = 0 THEN 'IELTS 6.5 overall with no individual band below 6.0' ELSE 'no test' END AS ielts,
  CASE WHEN p_partkey % 3 = 0 THEN 'text' ELSE concat('text', chr(10), 'more') END AS kept FROM part""")
def labelled_lines(spark, sf_dir):
    labels = cleanup.label_values(F.concat(F.lit("# T\n**Course length:** "), "p_name", F.lit("\n- Start: May\n")))
    test = F.when(_key() % 2 == 0, "An IELTS score of 6.5 overall, at least 6.0 in each part.").otherwise("no test")
    tail = F.when(_key() % 3 == 0, "text\nSee also: this\nand that").otherwise("text\nmore")
    return _part(spark, sf_dir).select(
        "p_partkey", cleanup.first_label(labels, "Duration", "Course length").alias("duration"), cleanup.ielts_line(test).alias("ielts"), cleanup.without_tail(tail, "See also").alias("kept")
    )


@query("""SELECT ix, mode, start, level FROM (SELECT p_partkey AS ix, unnest(CASE WHEN p_partkey % 2 = 0 THEN ['Full time', 'Part time'] ELSE ['Full time'] END) AS mode FROM part)
JOIN (SELECT p_partkey AS ix, unnest(CASE WHEN p_partkey % 3 = 0 THEN ['Sep', 'Jan'] ELSE [NULL] END) AS start FROM part) USING (ix)
JOIN (SELECT p_partkey AS ix, unnest(CASE WHEN p_partkey % 5 = 0 THEN ['undergraduate', 'foundation'] ELSE ['undergraduate'] END) AS level FROM part) USING (ix)""")
def page_variants(spark, sf_dir):
    rows = _part(spark, sf_dir).select(
        _key().alias("ix"), F.when(_key() % 2 == 0, F.array(F.lit("Full time"), F.lit("Part time"))).otherwise(F.array(F.lit("Full time"))).alias("modes"),
        F.when(_key() % 3 == 0, F.array(F.lit("Sep"), F.lit("Jan"))).alias("starts"), F.lit("undergraduate").alias("level"),
    )
    out = cleanup.level_rows(cleanup.variant_rows(rows, "modes", "starts"), "level", F.col("ix") % 5 == 0)
    return out.select("ix", "mode", "start", "level")


@query("""SELECT p_brand AS brand, min(p_partkey) FILTER (WHERE p_size = top) AS best FROM (SELECT *, max(p_size) OVER (PARTITION BY p_brand) AS top FROM part) GROUP BY p_brand""")
def picked_variants(spark, sf_dir):
    rows = _part(spark, sf_dir)
    out = cleanup.pick_variant(rows, "p_brand", [[F.col("p_size") > 10**6]], [F.col("p_size").desc(), _key()])
    return out.select(F.col("p_brand").alias("brand"), _key().alias("best"))


# --- lookups, merges and levels -------------------------------------------------------------------------------------


@query(f"""WITH c AS ({COURSES}) SELECT ix, CASE WHEN level = 'undergraduate' THEN 'own' WHEN ix % 2 = 1 THEN 'all' END AS found FROM c""")
def level_then_global_lookup(spark, sf_dir):
    c = derived(spark, sf_dir, "courses")
    own = c.where("level = 'undergraduate'").select("level", F.lower("name").alias("key"), F.lit("own").alias("value")).distinct()
    every = c.where("ix % 2 = 1").select(F.lit(None).cast("string").alias("level"), F.lower("name").alias("key"), F.lit("all").alias("value")).distinct()
    return lookup.by_level_then_global(c, own.unionByName(every), "name", "level", "ix", "found").select("ix", "found")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'model' ELSE p_name END AS name, CASE WHEN p_partkey % 2 = 0 THEN 'parsed' ELSE CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'model' END END AS fee FROM part""")
def merged_stages(spark, sf_dir):
    parsed = _part(spark, sf_dir).select("p_partkey", F.col("p_name").alias("name"), F.when(_key() % 2 == 0, "parsed").otherwise(" ").alias("fee"))
    model = _part(spark, sf_dir).where("p_partkey % 5 <> 0 or p_partkey % 3 = 0").select(
        "p_partkey", F.when(_key() % 3 == 0, "model").otherwise("").alias("name"), F.when(_key() % 5 == 0, "").otherwise("model").alias("fee")
    )
    return export.merge_stages(parsed, model, "p_partkey", ["fee"], ["name"])


@query("""SELECT p_partkey, concat(CASE WHEN p_partkey % 2 = 0 THEN 'a;' ELSE '' END, CASE WHEN p_partkey % 3 = 0 THEN 'b;' ELSE '' END) AS items FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0""")
def combined_parts(spark, sf_dir):
    part = lambda n, x: _part(spark, sf_dir).where(f"p_partkey % {n} = 0").select("p_partkey", F.array(F.lit(x)).alias("items"))
    out = export.combine_parts([part(2, "a;"), part(3, "b;")], "p_partkey", ["items"])
    return out.select("p_partkey", F.array_join("items", "").alias("items"))


@query("""SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS "entry.a.0.b", CASE WHEN p_partkey % 2 = 0 THEN '{"c":1}' ELSE '' END AS "entry.d" FROM part""")
def audited_rows(spark, sf_dir):
    reviewed = _part(spark, sf_dir).select("p_partkey", "p_name")
    docs = _part(spark, sf_dir).where("p_partkey % 2 = 0").select("p_partkey", F.format_string('{"a":[{"b":"%s"}],"d":{"c":1}}', F.col("p_brand")).alias("json"))
    return export.audit_rows(reviewed, {"entry": (docs, ["a.0.b", "d"])}, "p_partkey")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 2 = 0 AND p_partkey % 5 < 3 THEN 'scholarship study level does not match course (undergraduate/foundation got postgraduate scholarship)'
  WHEN p_partkey % 2 = 1 AND p_partkey % 5 >= 3 THEN 'scholarship study level does not match course (postgraduate got undergraduate scholarship)' ELSE '' END AS wrong FROM part""")
def scholarship_level_mismatch(spark, sf_dir):
    level = F.when(_key() % 2 == 0, "undergraduate").otherwise("postgraduate_research")
    declared = F.when(_key() % 5 < 3, "Postgraduate").otherwise("undergraduate")
    name = F.when(_key() % 3 == 0, "").otherwise("Award")
    meta = F.array().cast(nested.META)
    return _part(spark, sf_dir).select("p_partkey", validate.level_mismatch(level, name, meta, declared).alias("wrong"))


@query("""SELECT p_brand AS brand, max(p_partkey) AS path_key FROM part WHERE p_size % 2 = (SELECT 1) GROUP BY p_brand""")
def latest_pages_by_name(spark, sf_dir):
    rows = _part(spark, sf_dir).where("p_size % 2 = 1").withColumn("path", F.format_string("x/%010d-2026-27/normalized.json", _key()))
    return dedupe.latest_by_name(rows, "p_brand", "path").select(F.col("p_brand").alias("brand"), _key().alias("path_key"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'postgraduate_research' WHEN 1 THEN 'foundation' WHEN 2 THEN 'undergraduate' WHEN 3 THEN 'other' ELSE '' END AS of_scope,
  CASE p_partkey % 5 WHEN 0 THEN 'postgraduate_research' WHEN 1 THEN 'foundation' WHEN 3 THEN 'other' ELSE 'undergraduate' END AS folder,
  CASE p_partkey % 5 WHEN 0 THEN 'postgraduate' WHEN 1 THEN 'foundation' ELSE 'undergraduate' END AS bucket,
  concat(CASE p_partkey % 5 WHEN 0 THEN 'postgraduate_research' WHEN 1 THEN 'foundation' WHEN 3 THEN 'other' ELSE 'undergraduate' END, '::x') AS done FROM part""")
def level_names(spark, sf_dir):
    raw = F.when(_key() % 5 == 0, "Postgraduate-Research").when(_key() % 5 == 1, "foundation").when(_key() % 5 == 2, "UNDERGRADUATE").when(_key() % 5 == 3, "other").otherwise("evening")
    return _part(spark, sf_dir).select(
        "p_partkey", levels.from_scope(raw).alias("of_scope"), levels.folder(raw).alias("folder"), levels.bucket(raw).alias("bucket"), levels.resume_key(raw, F.lit("x")).alias("done")
    )


# --- scalars --------------------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, concat('£', p_size, ',000') AS pounds, CASE WHEN p_partkey % 2 = 0 THEN concat('£', p_size, ',500') ELSE '' END AS deposit,
  p_partkey % 2 = 0 AS stated, p_partkey % 3 = 0 AS example, CAST((p_size + 9) // 10 AS INTEGER) AS pages,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) WHEN p_partkey % 3 = 0 THEN CAST(p_size * 1000 AS DOUBLE) ELSE -1.0 END AS scholarship FROM part""")
def money_texts(spark, sf_dir):
    size = F.col("p_size")
    says = F.when(_key() % 2 == 0, F.concat(F.lit("You'll pay a £"), size, F.lit(",500 deposit before CAS"))).otherwise("nothing")
    amount = F.when(_key() % 2 == 0, F.concat(F.lit("£1 or £"), size)).otherwise("half")
    more = F.when(_key() % 3 == 0, F.concat(F.lit("Scholarship value: £"), size, F.lit(",000, not £99,000,000"))).otherwise("none")
    return _part(spark, sf_dir).select(
        "p_partkey",
        numbers.pounds((size * 1000).cast("string")).alias("pounds"),
        numbers.stated_deposit(says).alias("deposit"),
        numbers.amount_in(F.concat(size, F.lit("500")), says).alias("stated"),
        numbers.example_amounts(F.when(_key() % 3 == 0, "AUD 42,500").otherwise("AUD 42,501")).alias("example"),
        numbers.pages_of(size, F.lit(10)).alias("pages"),
        numbers.scholarship_amount(amount, more).alias("scholarship"),
    )


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'January 2026|September 2026|May 2027|soon' WHEN 1 THEN 'soon' ELSE '' END AS sorted,
  CASE WHEN p_partkey % 2 = 0 THEN 'March 2028' ELSE 'next spring' END AS short, CASE WHEN p_partkey % 2 = 0 THEN 'May 2026, June 2027' ELSE 'September' END AS intake FROM part""")
def month_texts(spark, sf_dir):
    none = F.array().cast("array<string>")
    values = F.when(_key() % 3 == 0, F.array(*map(F.lit, ("soon", "May 2027", "September 2026", "January 2026")))).when(_key() % 3 == 1, F.array(F.lit("soon"))).otherwise(none)
    return _part(spark, sf_dir).select(
        "p_partkey",
        F.array_join(dates.sort_intakes(values), "|").alias("sorted"),
        dates.short_month(F.when(_key() % 2 == 0, "mar 2028").otherwise(" next spring")).alias("short"),
        dates.intake_text(F.when(_key() % 2 == 0, "May 2026, full, June 2027").otherwise("September")).alias("intake"),
    )


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Group C' WHEN 1 THEN 'Group A' ELSE '' END AS grp, concat(lower(regexp_replace(p_name, '[^A-Za-z0-9_-]+', '-', 'g')), '-x') AS file,
  CASE WHEN p_partkey % 2 = 0 THEN 'ABB;BBC' ELSE '' END AS offers FROM part""")
def name_texts(spark, sf_dir):
    first = F.when(_key() % 3 == 0, "see group c below").otherwise("none")
    second = F.when(_key() % 3 == 1, "Group A or B").otherwise("no")
    return _part(spark, sf_dir).select(
        "p_partkey",
        text.english_group(first, second).alias("grp"),
        text.file_name(F.concat("p_name", F.lit(" / x!"))).alias("file"),
        F.array_join(text.offer_grades(F.when(_key() % 2 == 0, "ABB - bbc, again ABB").otherwise("A or B")), ";").alias("offers"),
    )


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN concat('HSC=', p_size, '%') ELSE '' END AS bullets, CASE WHEN p_partkey % 3 = 0 THEN 'Entry Requirements;English Requirement' ELSE 'Entry Requirements' END AS blocks,
  CASE WHEN p_partkey % 2 = 0 THEN 'degree,grade' ELSE '' END AS shape FROM part""")
def nested_texts(spark, sf_dir):
    body = F.when(_key() % 2 == 0, F.concat(F.lit("# T\n- **HSC:** "), "p_size", F.lit("%\n- **Description:** 5%"))).otherwise("text")
    meta = F.when(_key() % 3 == 0, '[{"subtitle":"entry requirements","description":["a"]},{"description":["IELTS 6.5 overall"]},{"subtitle":"Fees","description":["b"]}]').otherwise(
        '[{"subtitle":"Entry Requirements","description":"a"},{"subtitle":"English Requirement","description":[]}]'
    )
    rows = F.when(_key() % 2 == 0, '[{"grade":"1","degree":"x"}]').otherwise("[]")
    return _part(spark, sf_dir).select(
        "p_partkey",
        F.array_join(F.transform(nested.bullets(body), lambda r: F.concat(r["degree"], F.lit("="), r["grade"])), ";").alias("bullets"),
        F.array_join(F.transform(nested.academic_only(nested.metadata(meta)), lambda b: b["subtitle"]), ";").alias("blocks"),
        nested.signature(rows).alias("shape"),
    )
