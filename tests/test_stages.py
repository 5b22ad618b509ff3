"""Stages of a course record and reports on files: blanks, nulls, odd JSON and empty tables."""

import json

from pyspark.sql import functions as F

from lodestone.functions import nested
from lodestone.operators import stages, validate

META = nested.META


def one(spark, column):
    return spark.range(1).select(column.alias("out")).collect()[0].out


def owned(spark, *rows):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, body string, feesMetaData string, tuitionFee string")
    out = stages.parser_owned(df, "body").orderBy("k").collect()
    return [(r.tuitionFee, r.currency, [(b.subtitle, *b.description) for b in r.feesMetaData]) for r in out]


def test_the_page_decides_even_to_be_empty(spark):
    page = "First year tuition fee: | £14,200\n"
    got = owned(
        spark,
        (page, None, "99"),
        (page, '{"tuitionFee":1,"currency":"USD","placementYearFee":"1,000"}', "99"),
        ("no fee", "[]", "99"),
        ("no fee", '{"tuitionFee":15000}', "99"),
        ("£15,000 a year", '{"tuitionFee":15000}', "99"),
        (None, '{"tuitionFee":15000}', "99"),
        ("x", '{"fees for international":{"fee":"7,000","currency":"EUR"}}', ""),
        ("x", "not json", ""),
        ("x", '{"currency":"AUD"}', ""),
    )
    assert got == [
        ("14200", "GBP", [("Fees", "International tuition fee: £14,200")]),
        ("14200", "GBP", [("Fees", "International tuition fee: £14,200", "Placement year fee: £1,000")]),
        ("", "", []),
        ("", "GBP", [("Fees", "International tuition fee: £15,000 (full-time, per year)")]),
        ("15000", "GBP", [("Fees", "International tuition fee: £15,000")]),
        ("15000", "GBP", [("Fees", "International tuition fee: £15,000")]),
        ("", "EUR", []),
        ("", "", []),
        ("", "AUD", []),
    ]


def test_offers_of_a_page(spark):
    lines = lambda text: one(spark, stages.stated_offers(F.lit(text)))
    assert lines("x\n- **A-levels:** BBC\n- **BTEC:** DMM\nBBB at A-level\nBBB alone\nB/CCD or") == ["**A-levels:** BBC", "**BTEC:** DMM", "BBB at A-level", "B/CCD or"]
    assert lines("## Entry requirements\n112 UCAS Tariff points needed\n## B\n- **A-levels:** BBC") == ["112 UCAS Tariff points needed."]
    assert lines("") == []


def test_expected_fields_of_nothing(spark):
    none = F.lit(None).cast("string")
    got = json.loads(one(spark, stages.expected_fields(F.lit(""), none, none, none)))
    assert set(got.values()) == {""} and "tuitionFeeOptions" not in got and got.keys() >= {"level", "studyMode", "award", "currency"}


def test_worth_of_offers(spark):
    worth = lambda text, level: [tuple(r) for r in one(spark, stages.equivalent_requirements(F.lit(text), F.lit(level)))]
    assert worth("BBC at A-level", "undergraduate") == [("HSC", "GPA 4")] and worth("CCC", "foundation") == [("HSC", "GPA 3.5")]
    assert worth("BBC", "postgraduate") == worth("nothing", "undergraduate") == []


def test_appended_blocks(spark):
    def run(blocks, stage, overall, least):
        make = lambda rows: F.from_json(F.lit(json.dumps([{"subtitle": s, "description": d} for s, d in rows])), META)
        got = one(spark, stages.with_stage_blocks(make(blocks), make(stage), F.lit(overall), F.lit(least)))
        return [(b.subtitle, list(b.description)) for b in got]

    entry, english = ("Entry Requirements", ["2:1"]), ("English Requirement", ["IELTS 6.5 overall with no element below 6.0"])
    assert run([], [("Fees", ["x"]), entry], "6.5", "6.0") == [entry, english]
    assert run([(" entry requirements", [])], [entry], "", "6.0") == [(" entry requirements", [])]
    assert run([("ENGLISH Requirement", ["x"])], [], "6.5", None) == [("ENGLISH Requirement", ["x"])]
    assert run([("English Requirement", [])], [], "7", None) == [("English Requirement", []), ("English Requirement", ["IELTS 7 overall"])]


def test_reports_on_odd_files(spark):
    rows = spark.createDataFrame([("u", ""), ("u", "MSc")], "uniName string, degreeName string")
    plain = rows.withColumns({"errorReason": F.lit("COMMENT: x inferred"), "filled": F.array().cast("array<string>")})
    report = lambda df, found, need: validate.file_report(df, found, need).collect()
    (r,) = report(plain, rows.columns, ("uniName", "degreeName", "minGpa"))
    assert (r.n_rows, r.error_rows, r.empty) == (2, 0, None)
    assert r.file_error == "MISSING_REQUIRED_FIELD: Missing required CSV headers: minGpa. Found: uniName, degreeName"
    (r,) = report(plain, rows.columns, ("uniName", "degreeName"))
    assert (r.n_rows, r.error_rows, r.empty, r.filled, r.file_error) == (2, 0, {"uniName": 0, "degreeName": 1}, {}, "")
    (r,) = report(plain.limit(0), rows.columns, ("uniName", "degreeName"))
    assert (r.n_rows, r.error_rows, r.file_error) == (0, 0, "MISSING_REQUIRED_FIELD: CSV contains no data rows.") and set(r.empty.values()) == {0}


def test_audits_without_rules_or_pages(spark):
    rules = spark.createDataFrame([("u", "fee", 1, "£(\\d+)", 1)], "uni string, field string, place int, pattern string, least int")
    pages = spark.createDataFrame([(1, "u", "£5"), (2, "u", None), (3, "v", "£5"), (4, None, "£5")], "k int, uni string, body string")
    got = validate.page_audit(pages, rules, "uni", "body", ["fee", "intake"])
    assert {r.k: (r.found["fee"], r.missing) for r in got.collect()} == {1: ("5", ["intake"])} | {k: ("", ["fee", "intake"]) for k in (2, 3, 4)}
    assert validate.audit_totals(got.limit(0), "uni", ["fee"]).where("level <> 'all'").count() == 0
