"""Reference documents of a university (entry, English, scholarships, deposit): rules, readable forms and stage rows.

Each document is a row with a JSON text; issues come out as rows, so that a
corpus of documents is checked by one scan without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import dates, nested, numbers
from lodestone.functions.text import ENTRY_DEGREES, any_of, let, requirement_degree, requirement_grade

#: Names of a level in English documents. Fixed values.
ENGLISH_LEVELS = ("foundation year", "foundation", "undergraduate", "postgraduate", "postgraduate research")
_ISSUE = "array<struct<severity:string,code:string,message:string>>"
ENGLISH = (
    "array<struct<TestStudyLevel:string,ProgramName:string,TestRequirements:array<struct<TestName:string,ieltsMinOverall:string,"
    "ieltsMinSection:string,toeflMinOverall:string,toeflMinSection:string,pteMinOverall:string,pteMinSection:string>>,"
    "description:array<string>>>"
)
SCHOLARSHIPS = (
    "array<struct<scholarshipName:string,scholarshipType:string,scholarshipStudyLevel:string,Eligibility:string,Amount:string,description:string>>"
)
DEPOSIT = "struct<initialDeposit:string,feesMetaData:array<struct<subtitle:string,description:array<string>>>>"
_ENTRY_LEVEL = nested.ENTRY_DOCUMENT.removeprefix("struct<studyLevels:array<").removesuffix(">>")
KINDS = ("entry", "english", "scholarships", "deposit")


def _text(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def _one(severity: str, code: str, message: Column | str) -> Column:
    m = message if isinstance(message, Column) else F.lit(message)
    return F.array(F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), m.alias("message"))).cast(_ISSUE)


def _cases(*cases: tuple[Column, Column]) -> Column:
    """The issues of the first case that holds."""
    out = None
    for test, found in cases:
        out = F.when(test, found) if out is None else out.when(test, found)
    return out.otherwise(F.array().cast(_ISSUE))


def _each(rows: Column, issues) -> Column:
    return F.coalesce(F.flatten(F.transform(rows, issues)), F.array().cast(_ISSUE))


def _level_of(name: Column) -> Column:
    """The level that a document's level name stands for; null for none."""
    low = F.lower(_text(name))
    out = None
    for level, names in nested.LEVEL_NAMES.items():
        out = F.when(low.isin(*names), level) if out is None else out.when(low.isin(*names), level)
    return out


def entry_issues(document: Column, required: tuple[str, ...] = tuple(nested.LEVEL_NAMES)) -> Column:
    """Issues of an entry document: levels, programmes, requirement rows, their degrees and grades, absent levels."""
    said = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))

    def of_level(level: Column, k: Column) -> Column:
        name, known = _text(level["studyLevel"]), _level_of(level["studyLevel"])
        allowed = F.create_map(*(x for lvl, d in ENTRY_DEGREES.items() for x in (F.lit(lvl), F.array(*map(F.lit, d)))))

        def of_row(r: Column, j: Column) -> Column:
            degree, grade = _text(r["degree"]), _text(r["grade"])
            label = requirement_degree(degree)
            at = said(name, " requirements[", j.cast("string"), "]")
            off = ~F.coalesce(F.array_contains(allowed[known], label), F.lit(False))
            mapped = _cases((off, _one("ERROR", "degree_unmapped", said(at, '.degree "', degree, '" canonicalizes to "', label, '"'))))
            read = _cases((requirement_grade(grade) == "", _one("ERROR", "grade_unextractable", said(at, '.grade "', grade, '"'))))
            return _cases(
                (degree == "", _one("ERROR", "missing_degree", said(at, " is missing degree"))),
                (grade == "", _one("ERROR", "missing_grade", said(at, " is missing grade"))),
                (F.lit(True), F.concat(mapped, read)),
            )

        def of_program(p: Column, j: Column) -> Column:
            at = said(name, " programs[", j.cast("string"), "]")
            return F.concat(
                _cases((F.coalesce(F.size(p["requirements"]), F.lit(0)) < 1, _one("WARN", "missing_requirements", said(at, " has no requirements[]")))),
                _cases((F.coalesce(F.size(p["description"]), F.lit(0)) < 1, _one("WARN", "missing_description", said(at, " has empty description[]")))),
                _each(p["requirements"], of_row),
            )

        at = said("studyLevels[", k.cast("string"), "]")
        return _cases(
            (level["off"], _one("ERROR", "invalid_study_level", said(at, " must be an object"))),
            (name == "", _one("ERROR", "missing_study_level_name", said(at, " is missing studyLevel"))),
            (known.isNull(), _one("ERROR", "unknown_study_level", said('studyLevel "', name, '" is no known level'))),
            (F.coalesce(F.size(level["programs"]), F.lit(0)) < 1, _one("WARN", "missing_programs", said(name, " has no programs[] entries"))),
            (F.lit(True), _each(level["programs"], of_program)),
        )

    def of_document(d: Column) -> Column:
        levels = d
        seen = F.transform(levels, lambda x: _level_of(x["studyLevel"]))
        absent = [
            _cases((~F.coalesce(F.array_contains(F.array_compact(seen), lvl), F.lit(False)), _one("WARN", "missing_pipeline_level", f"No studyLevel block found for pipeline level '{lvl}'")))
            for lvl in required
        ]
        return _cases(
            (F.coalesce(F.size(levels), F.lit(0)) < 1, _one("ERROR", "missing_study_levels", "studyLevels must be a non-empty array")),
            (F.lit(True), F.concat(_each(levels, of_level), *absent)),
        )

    v = F.try_parse_json(document)
    bad = ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))

    def read(item: Column) -> Column:
        """One item of studyLevels, read apart from the others, so that an odd one hides none of their issues."""
        is_object = F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False))
        level = F.from_json(F.when(is_object, F.to_json(item)), _ENTRY_LEVEL)
        return F.struct(
            level["studyLevel"].alias("studyLevel"), level["programs"].alias("programs"), (~is_object).alias("off")
        )

    parsed = F.transform(F.try_variant_get(v, "$.studyLevels", "array<variant>"), read)
    return _cases((bad, _one("ERROR", "json_parse_failed", "Could not parse the entry document")), (F.lit(True), let(parsed, of_document)))


def _listed(document: Column, schema: str, what: str, issues) -> Column:
    """Issues of a document that must be a list of objects and not empty."""
    v = F.try_parse_json(document)
    items = F.try_variant_get(v, "$", "array<variant>")
    bad = F.coalesce(F.size(items), F.lit(0)) < 1
    not_objects = _each(
        items,
        lambda x, k: _cases(
            (
                ~F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)),
                _one("ERROR", "invalid_row", F.concat(F.lit(f"{what}["), k.cast("string"), F.lit("] must be an object"))),
            )
        ),
    )
    return _cases(
        (bad, _one("ERROR", "json_parse_failed", f"Could not parse the {what} document")),
        (F.size(not_objects) > 0, not_objects),
        (F.lit(True), let(F.from_json(document, schema), issues)),
    )


def english_issues(document: Column) -> Column:
    """Issues of an English document. One made of groups A to G only has none."""

    def of(rows: Column) -> Column:
        level = lambda r: F.lower(_text(r["TestStudyLevel"]))
        groups = F.forall(rows, lambda r: _text(r["ProgramName"]).rlike("(?i)^Group [A-G]$"))
        blank = F.size(F.filter(rows, lambda r: level(r) == ""))
        unknown = _each(
            rows,
            lambda r, k: _cases(
                (
                    (level(r) != "") & ~level(r).isin(*ENGLISH_LEVELS),
                    _one("WARN", "unknown_english_study_level", F.concat(F.lit("english["), k.cast("string"), F.lit('] TestStudyLevel "'), _text(r["TestStudyLevel"]), F.lit('"'))),
                )
            ),
        )
        none = _cases((blank > 0, _one("WARN", "english_no_study_level", F.concat(blank.cast("string"), F.lit(" row(s) missing TestStudyLevel")))))
        return F.when(groups, F.array().cast(_ISSUE)).otherwise(F.concat(unknown, none))

    return _listed(document, ENGLISH, "english", of)


def scholarship_issues(document: Column) -> Column:
    """Issues of a scholarship document: rows without a study level, or with one that no level of courses has."""

    def of(rows: Column) -> Column:
        def one(r: Column, k: Column) -> Column:
            said = F.lower(_text(r["scholarshipStudyLevel"]))
            tokens = F.transform(F.split(said, "[,/&]"), lambda t: F.trim(t))
            known = any_of([F.array_contains(tokens, n) for names in nested.LEVEL_NAMES.values() for n in names])
            return _cases(
                (said == "", _one("WARN", "missing_scholarship_study_level", F.concat(F.lit("scholarship["), k.cast("string"), F.lit('] "'), _text(r["scholarshipName"]), F.lit('"')))),
                (~known, _one("WARN", "scholarship_level_unmatched", F.concat(F.lit('scholarshipStudyLevel "'), _text(r["scholarshipStudyLevel"]), F.lit('"')))),
            )

        return _each(rows, one)

    return _listed(document, SCHOLARSHIPS, "scholarship", of)


def deposit_issues(document: Column) -> Column:
    """Issues of a deposit document, which states a deposit, fee blocks or both."""
    v = F.try_parse_json(document)
    object_ = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    parsed = F.from_json(document, DEPOSIT)
    bare = (_text(parsed["initialDeposit"]) == "") & (F.coalesce(F.size(parsed["feesMetaData"]), F.lit(0)) < 1)
    return _cases(
        (~object_, _one("ERROR", "json_parse_failed", "Could not parse the deposit document")),
        (bare, _one("WARN", "missing_deposit_fields", "deposit JSON should include initialDeposit and/or feesMetaData")),
    )


def issues(df: DataFrame, key: str, kind: str, document: str) -> DataFrame:
    """(key, kind, severity, code, message) of documents of every kind, by the column that names it."""
    by_kind = {"entry": entry_issues, "english": english_issues, "scholarships": scholarship_issues, "deposit": deposit_issues}
    found = None
    for name, rule in by_kind.items():
        test = F.col(kind) == name
        found = F.when(test, rule(F.col(document))) if found is None else found.when(test, rule(F.col(document)))
    return df.select(key, kind, F.explode(found).alias("i")).select(key, kind, "i.*")


# --- readable forms -------------------------------------------------------------------------------------------------


def _page(title: str, blocks: Column) -> Column:
    """A markdown page of (heading, lines) blocks."""
    shown = F.transform(blocks, lambda b: F.concat(F.lit("## "), b["heading"], F.lit("\n\n"), F.array_join(F.transform(b["lines"], lambda x: F.concat(F.lit("- "), x)), "\n")))
    page = F.concat(F.lit(f"# {title}\n\n"), F.array_join(F.transform(shown, lambda x: F.rtrim(x)), "\n\n"))
    return F.concat(F.rtrim(page, F.lit(" \n")), F.lit("\n"))


def _line(label: Column | str, value: Column) -> Column:
    """`**label:** value`, null for an empty value."""
    name = label if isinstance(label, Column) else F.lit(label)
    return F.when(_text(value) != "", F.concat(F.lit("**"), name, F.lit(":** "), _text(value)))


def _block(heading: Column, default: str, lines: Column) -> Column:
    return F.struct(F.coalesce(F.nullif(_text(heading), F.lit("")), F.lit(default)).alias("heading"), F.array_compact(lines).alias("lines"))


def _joined(description: Column) -> Column:
    return F.array_join(F.filter(F.transform(description, lambda d: _text(d)), lambda d: d != ""), " ")


def scholarships_page(document: Column) -> Column:
    def block(r: Column) -> Column:
        lines = F.array(
            _line("Type", r["scholarshipType"]), _line("Study level", r["scholarshipStudyLevel"]),
            _line("Eligibility", r["Eligibility"]), _line("Amount", r["Amount"]), _line("Description", r["description"]),
        )
        return _block(r["scholarshipName"], "Scholarship", lines)

    return _page("Scholarships", F.transform(F.from_json(document, SCHOLARSHIPS), block))


def entry_page(document: Column, title: str = "Entry Requirements") -> Column:
    def of_program(p: Column) -> Column:
        rows = F.transform(p["requirements"], lambda r: _line(F.coalesce(F.nullif(_text(r["degree"]), F.lit("")), F.lit("Qualification")), r["grade"]))
        none = F.array().cast("array<string>")
        return F.concat(F.array(_line("Program", p["program"])), F.coalesce(rows, none), F.array(_line("Description", _joined(p["description"]))))

    def block(level: Column) -> Column:
        lines = F.flatten(F.transform(level["programs"], of_program))
        return _block(level["studyLevel"], "Entry", F.coalesce(lines, F.array().cast("array<string>")))

    return _page(title, F.transform(F.from_json(document, nested.ENTRY_DOCUMENT)["studyLevels"], block))


def deposit_page(document: Column) -> Column:
    def of(d: Column) -> Column:
        amount = _line("Amount", d["initialDeposit"])
        meta = F.coalesce(d["feesMetaData"], F.array().cast(nested.META))
        blocks = F.transform(meta, lambda b: _block(b["subtitle"], "Deposit", F.array(amount, _line("Description", _joined(b["description"])))))
        bare = F.array(_block(F.lit("Initial Deposit"), "", F.array(amount)))
        none = F.slice(bare, F.lit(1), F.lit(0))
        return F.when(F.size(meta) > 0, blocks).when(_text(d["initialDeposit"]) != "", bare).otherwise(none)

    return _page("Tuition Fee Deposit", let(F.from_json(document, DEPOSIT), of))


def english_page(document: Column) -> Column:
    def of_test(t: Column) -> Column:
        stated = [
            F.when(_text(t[f"{test}MinOverall"]) != "", F.concat(t[f"{test}MinOverall"], F.lit(" overall, "), F.coalesce(t[f"{test}MinSection"], F.lit("")), F.lit(" minimum per section")))
            for test in ("ielts", "toefl", "pte")
        ]
        return _line(F.coalesce(F.nullif(_text(t["TestName"]), F.lit("")), F.lit("Test")), F.coalesce(*stated))

    def block(r: Column) -> Column:
        tests = F.coalesce(F.transform(r["TestRequirements"], of_test), F.array().cast("array<string>"))
        lines = F.concat(F.array(_line("Program", r["ProgramName"])), tests, F.array(_line("Description", _joined(r["description"]))))
        return _block(r["TestStudyLevel"], "Requirements", lines)

    return _page("English Language Requirements", F.transform(F.from_json(document, ENGLISH), block))


# --- rows of the stages ---------------------------------------------------------------------------------------------


def scholarship_type(raw: Column) -> Column:
    """Percentage or Amount, by the words and signs of a text; '' if it says neither."""
    low = F.lower(_text(raw))
    return (
        F.when(low.rlike("%|percent"), "Percentage").when((low == "amount") | low.rlike("amount|£|off"), "Amount").otherwise("")
    )


#: Fields of the first stage that go over as they are. Fixed values.
PLAIN_FIELDS = (
    "initialDeposit", "applicationFee", "applicationDeadline", "ieltsMinOverall", "ieltsMinSection", "toeflMinOverall",
    "toeflMinSection", "pteMinOverall", "pteMinSection",
)


def parsed_row(stage: Column, uni: Column, url: Column, name: Column, degree: Column) -> Column:
    """The course row that the first stage's JSON gives by itself; currency GBP where it says none."""
    at = lambda path: nested.by_path(stage, path)
    none = F.array().cast(nested.META)
    return F.struct(
        uni.alias("uniName"), name.alias("courseName"), name.alias("programmeName"), degree.alias("degreeName"),
        url.alias("courseUrlExternal"), url.alias("courseScraped"),
        numbers.money(at("tuitionFee")).alias("tuitionFee"),
        F.coalesce(F.nullif(F.trim(at("currency")), F.lit("")), F.lit("GBP")).alias("currency"),
        dates.intake_text(at("intakeInfo")).alias("intakeInfo"),
        dates.months_of(at("courseDuration")).alias("courseDuration"),
        *(F.trim(at(c)).alias(c) for c in PLAIN_FIELDS),
        nested.metadata(at("feesMetaData")).alias("feesMetaData"),
        F.array().cast(nested.REQUIREMENTS).alias("requirements"),
        none.alias("AcademicRequirementsMetaData"), none.alias("scholarshipMetaData"), F.lit("ok").alias("Result"),
    )


def model_row(answer: Column, level: str = "") -> Column:
    """The fields that a model's answer may give, in their proper forms; whatever else it says is left out."""
    v = F.to_json(nested.unfenced(answer))
    at = lambda path: nested.by_path(v, path)
    return F.struct(
        nested.requirements(F.from_json(at("requirements"), nested.REQUIREMENTS), level).alias("requirements"),
        nested.academic_only(nested.metadata(at("AcademicRequirementsMetaData"))).alias("AcademicRequirementsMetaData"),
        nested.metadata(at("scholarshipMetaData"), "Scholarships").alias("scholarshipMetaData"),
        F.trim(at("scholarshipName")).alias("scholarshipName"),
        numbers.money(at("scholarshipAmount")).alias("scholarshipAmount"),
        scholarship_type(at("scholarshipType")).alias("scholarshipType"),
    )
