"""Registered queries of the two stages of a course record, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import nested
from lodestone.operators import stages
from lodestone.plans.inputs import PAGES, derived
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


#: A page with an award, an offer and a fee from abroad by its id, and a model's answer to it.
_MORE = """concat(body, chr(10), CASE WHEN id % 9 = 0 THEN concat('- Award BSc (Hons)', chr(10)) ELSE '' END,
 CASE WHEN id % 6 = 1 THEN concat('- **A-levels:** BBC', chr(10)) ELSE '' END, CASE WHEN id % 8 = 0 THEN concat('From abroad: £', CAST(10 + id % 9 AS STRING), ',500') ELSE '' END)"""
_FEES = """CASE id % 4 WHEN 0 THEN concat('{"tuitionFee":"', CAST(10 + id % 9 AS STRING), ',500","currency":" EUR ","placementYearFee":1500}')
 WHEN 1 THEN '{"International students":{"fee":"9,000"},"placementYearFee":"2000"}' WHEN 2 THEN '[{"subtitle":"Fees","description":["see example.com","Deposit applies"]}]' END"""
_ENTRY = """CASE WHEN id % 10 = 0 THEN '[{"subtitle":"Entry Requirements","description":["A first degree in law"]}]' ELSE '[]' END"""
_P = f"p AS (SELECT id, {_MORE} AS page, 10 + id % 9 AS f FROM ({PAGES}))"
_HELD = lambda a, b: f"(contains(page, {a}) OR contains(page, {b}))"


@query(f"""WITH {_P}, h AS (SELECT *, {_HELD("concat(f, '500')", "concat(f, ',500')")} AS held, {_HELD("'987654'", "'987,654'")} AS odd FROM p),
t AS (SELECT *, CASE WHEN id % 2 = 1 OR (id % 4 = 0 AND held) THEN concat(f, '500') ELSE '' END AS fee FROM h)
SELECT id, CASE WHEN id % 5 = 0 THEN concat('/c/', id) ELSE 'Law' END AS name,
  CASE id % 3 WHEN 0 THEN 'September 2026' WHEN 1 THEN 'September 2027' ELSE 'January 2026, May 2026' END AS intake, fee,
  CASE WHEN id % 4 = 0 THEN 'EUR' WHEN id % 2 = 1 THEN 'GBP' ELSE '' END AS currency, CASE WHEN id % 5 = 0 THEN '' ELSE '6.5' END AS ielts,
  CASE WHEN id % 7 = 0 THEN 'MSc' WHEN id % 9 = 0 THEN 'BSc' ELSE '' END AS degree,
  concat('Fees:', CASE id % 4 WHEN 0 THEN concat('International tuition fee: £', f, ',500', CASE WHEN held THEN '' ELSE ' (full-time, per year)' END, '|Placement year fee: £1,500')
    WHEN 1 THEN concat('International tuition fee: £', f, ',500|Placement year fee: £2,000') WHEN 2 THEN 'see example.com|Deposit applies' ELSE concat('International tuition fee: £', f, ',500') END) AS fees,
  CASE WHEN id % 3 = 0 AND odd THEN '987654' ELSE '' END AS deposit, CASE WHEN id % 3 = 0 AND NOT odd THEN 'initialDeposit: dropped ungrounded value ''987654''' ELSE '' END AS warnings,
  CASE WHEN id % 10 = 0 THEN 'Entry Requirements:A first degree in law' WHEN id % 6 = 1 THEN 'Entry Requirements:**A-levels:** BBC' ELSE '' END AS entry FROM t""")
def enriched_stages(spark, sf_dir):
    pages = derived(spark, sf_dir, "course_pages").selectExpr("id", f"{_MORE} AS page", "concat('/c/', CAST(id AS STRING)) AS url", f"{_FEES} AS feesMetaData", f"{_ENTRY} AS AcademicRequirementsMetaData")
    blank = {c: F.lit("") for c in (*stages.PARSER_OWNED, *stages.GROUNDED)}
    answers = pages.withColumns(
        blank
        | {
            "courseName": F.when(F.col("id") % 5 == 0, " ").otherwise("Law"),
            "courseUrl": F.lit(None).cast("string"),
            "degreeName": F.when(F.col("id") % 7 == 0, "MSc"),
            "initialDeposit": F.when(F.col("id") % 3 == 0, "987654").otherwise(""),
            "tuitionFee": F.lit("1"),
        }
    )
    shown = lambda c: F.array_join(F.transform(c, lambda b: F.concat(b["subtitle"], F.lit(":"), F.array_join(b["description"], "|"))), ";")
    r = stages.enriched(answers, "page", "url", "url")
    return r.select(
        "id", F.col("courseName").alias("name"), F.col("intakeInfo").alias("intake"), F.col("tuitionFee").alias("fee"), "currency",
        F.col("ieltsMinOverall").alias("ielts"), F.col("degreeName").alias("degree"), shown("feesMetaData").alias("fees"), F.col("initialDeposit").alias("deposit"),
        F.array_join("warnings", "|").alias("warnings"), shown("AcademicRequirementsMetaData").alias("entry"),
    )


_ABROAD = """concat('- Level ', CASE WHEN id % 2 = 0 THEN 'Postgraduate' ELSE 'Undergraduate' END, chr(10), '- Study mode Full time', chr(10), body, chr(10),
 CASE WHEN id % 3 = 0 THEN '' ELSE concat('### International students', chr(10), '- Full Time', chr(10), '- 4 years with placement', chr(10), '- £1,000', chr(10), '- Full Time', chr(10), '- 3 years', chr(10), '- £', CAST(10 + id % 9 AS STRING), ',750', chr(10), '--END--') END)"""
_JSON = """concat('{"courseName":"Law","courseUrlExternal":"/c/', id, '","degreeName":"","level":"', CASE WHEN id % 2 = 0 THEN 'Postgraduate' ELSE 'Undergraduate' END, '","studyMode":"Full time","award":"","intakeInfo":"',
  CASE id % 3 WHEN 0 THEN 'September 2026' WHEN 1 THEN 'September 2027' ELSE 'January 2026, May 2026' END, '","courseDuration":"', 1 + id % 4, ' years","tuitionFee":"',
  CASE WHEN id % 2 = 1 THEN concat(10 + id % 9, '500') WHEN id % 3 = 0 THEN '' ELSE concat(10 + id % 9, '750') END, '","currency":"', CASE WHEN id % 2 = 0 AND id % 3 = 0 THEN '' ELSE 'GBP' END,
  '","ieltsMinOverall":"', CASE WHEN id % 5 = 0 THEN '' ELSE '6.5' END, '","ieltsMinSection":"', CASE WHEN id % 5 = 0 THEN '' ELSE '6.0' END, '"',
  CASE WHEN id % 3 = 0 THEN '' ELSE concat(',"tuitionFeeOptions":[{"studyMode":"Full Time","courseDuration":"4 years with placement","tuitionFee":"£1,000"},{"studyMode":"Full Time","courseDuration":"3 years","tuitionFee":"£', 10 + id % 9, ',750"}]') END, '}')"""


@query(f"SELECT id, {_JSON} AS expected FROM ({PAGES})")
def expected_page_fields(spark, sf_dir):
    pages = derived(spark, sf_dir, "course_pages").selectExpr("id", f"{_ABROAD} AS page", "concat('/c/', CAST(id AS STRING)) AS url")
    return pages.select("id", stages.expected_fields(F.col("page"), F.lit("Law"), F.col("url"), F.lit(None).cast("string")).alias("expected"))


_LEVEL = "CASE p_partkey % 4 WHEN 0 THEN 'foundation' WHEN 1 THEN 'undergraduate' WHEN 2 THEN 'postgraduate' ELSE 'postgraduate_research' END"
_COUNTRY = """concat('{"studyLevels":[{"studyLevel":"Foundation","programs":[{"requirements":[{"degree":"HSC","grade":"', CAST(p_size AS STRING), '%"}]}]},{"studyLevel":"Postgraduate","programs":[{"requirements":[{"degree":"MSc","grade":"', CAST(p_size AS STRING), '%"}]}]}]}')"""
_ASKED = "CASE p_partkey % 3 WHEN 0 THEN array() WHEN 1 THEN array(named_struct('degree', 'HSC', 'grade', '50%'), named_struct('degree', 'hsc', 'grade', '50%')) ELSE array(named_struct('degree', 'MSc', 'grade', '60%')) END"


@query("""WITH r AS (SELECT p_partkey AS key, p_partkey % 4 AS l, p_partkey % 3 AS a, p_partkey % 5 AS b, p_partkey % 7 = 0 AS silent, p_size AS s, p_brand, p_type FROM part),
q AS (SELECT *, list_filter([CASE WHEN a = 1 AND l <> 2 AND NOT silent THEN 'HSC:50%' END, CASE WHEN a = 2 AND l IN (2, 3) AND NOT silent THEN 'MSc:60%' END], lambda x: x IS NOT NULL) AS own,
  CASE l WHEN 0 THEN [concat('HSC:', s, '%')] WHEN 2 THEN [concat('MSc:', s, '%')] ELSE [] END AS country, CASE WHEN b = 0 AND l < 2 THEN ['HSC:GPA 4'] ELSE [] END AS worth FROM r)
SELECT key, CASE WHEN silent OR a = 0 THEN p_type ELSE p_brand END AS award, CASE WHEN b = 1 THEN '6' WHEN silent THEN '' ELSE '7' END AS ielts, CASE WHEN silent THEN '80' ELSE '90' END AS toefl,
  CASE WHEN silent THEN 'Fees:a' WHEN b = 2 THEN 'Fees:a;Initial tuition Deposit:d' ELSE 'Fees:a;Deposit:d' END AS fees,
  array_to_string(list_filter(list_concat(own, list_filter(list_concat(country, worth), lambda x: NOT list_contains(own, x))), lambda x: x IS NOT NULL), ';') AS requirements
FROM q""")
def merged_stage_rows(spark, sf_dir):
    key, block = F.col("key"), "array<struct<subtitle:string,description:array<string>>>"
    part = readers.table(spark, sf_dir, "part")
    rows = part.selectExpr("p_partkey AS key", "p_type", "p_brand", f"{_LEVEL} AS level", f"{_COUNTRY} AS entry", "CASE WHEN p_partkey % 5 = 0 THEN 'Offer: BBC at A-level' END AS body", f"{_ASKED} AS asked")
    blocks = lambda name, line: F.array(F.struct(name.alias("subtitle"), F.array(F.lit(line)).alias("description"))).cast(block)
    none = F.lit("")
    model = F.struct(
        F.col("asked").cast(nested.REQUIREMENTS).alias("requirements"),
        F.when(key % 3 != 0, F.col("p_brand")).otherwise(" ").alias("scholarshipName"),
        *(none.alias(c) for c in ("scholarshipAmount", "scholarshipType", "ieltsMinSection", "toeflMinSection", "pteMinOverall", "pteMinSection", "initialDeposit")),
        *(F.array().cast(block).alias(c) for c in stages.MODEL_LISTS),
        F.lit("7").alias("ieltsMinOverall"),
        F.lit("90").alias("toeflMinOverall"),
        blocks(F.when(key % 5 == 2, "").otherwise("Deposit"), "d").alias("feesMetaData"),
    )
    rows = rows.withColumns(
        {c: none for c in (*stages.MODEL_TEXTS, *stages.REPLACING_SCORES, *stages.FILLING_SCORES, "initialDeposit", "country")}
        | {c: F.array().cast(block) for c in stages.MODEL_LISTS}
        | {"requirements": F.array().cast(nested.REQUIREMENTS), "feesMetaData": blocks(F.lit("Fees"), "a"), "model": F.when(key % 7 != 0, model)}
        | {"scholarshipName": F.col("p_type"), "ieltsMinOverall": F.when(key % 5 == 1, "6"), "toeflMinOverall": F.lit("80")}
    )
    r = stages.merged_stages(rows, "model", "body", "level", "entry", "country")
    shown = F.array_join(F.transform("feesMetaData", lambda b: F.concat(b["subtitle"], F.lit(":"), F.array_join(b["description"], "|"))), ";")
    wanted = F.array_join(F.transform("requirements", lambda x: F.concat_ws(":", x["degree"], x["grade"])), ";")
    return r.select("key", F.col("scholarshipName").alias("award"), F.coalesce("ieltsMinOverall", none).alias("ielts"), F.col("toeflMinOverall").alias("toefl"), shown.alias("fees"), wanted.alias("requirements"))
