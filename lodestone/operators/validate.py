"""Row validation: ordered rules to an ordered list of errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import dates, nested, numbers
from lodestone.functions.text import any_of, grounded, known_degree

#: Fixed values.
REQUIRED = ("uniName", "programmeName", "degreeName", "courseName", "minDegreeName", "minGpa", "intakeInfo")
NUMBERS = (
    "minGpa", "higherGpa", "tuitionFee", "initialDeposit", "applicationFee", "scholarshipAmount", "ieltsMinOverall",
    "ieltsMinSection", "toeflMinOverall", "toeflMinSection", "pteMinOverall", "pteMinSection",
)
META_FIELDS = ("AcademicRequirementsMetaData", "feesMetaData", "scholarshipMetaData")


def drop_ungrounded(df: DataFrame, columns: list[str], body: str) -> DataFrame:
    """Blanks each named text that the body does not hold and lists what was dropped in `warnings`.

    A null or blank text stays as it is and gives no warning; a null body holds nothing.
    """
    texts = {c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in columns}
    lost = {c: (t != "") & ~grounded(t, F.col(body)) for c, t in texts.items()}
    quoted = {c: F.when(F.contains(t, F.lit("'")) & ~F.contains(t, F.lit('"')), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(t, F.lit("'"), F.lit("\\'")), F.lit("'"))) for c, t in texts.items()}
    notes = [F.when(lost[c], F.concat(F.lit(f"{c}: dropped ungrounded value "), quoted[c])) for c in columns]
    blanked = {c: F.when(lost[c], F.lit("")).otherwise(F.col(c)) for c in columns}
    return df.withColumns(blanked | {"warnings": F.array_compact(F.array(*notes))})


def _cell(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit(""))


def level_mismatch(level: Column, name: Column, meta: Column, declared: Column) -> Column:
    """What is wrong between a course's level and its scholarship's, by the declared level, then by its words; '' if nothing."""
    for_pg = "scholarship study level does not match course (postgraduate got undergraduate scholarship)"
    for_ug = "scholarship study level does not match course (undergraduate/foundation got postgraduate scholarship)"
    match = F.when(level == "postgraduate_research", "postgraduate").otherwise(level)
    hay = F.lower(F.concat_ws("\n", name, nested.meta_text(meta)))
    ug, pg = match.isin("foundation", "undergraduate"), match == "postgraduate"
    said = F.lower(F.coalesce(declared, F.lit("")))
    tokens = F.transform(F.split(said, "[,/&]"), lambda t: F.trim(t))
    fits = any_of(
        [
            (match == lvl) & any_of([F.array_contains(tokens, n) for n in names])
            for lvl, names in nested.LEVEL_NAMES.items()
        ]
    )
    off = (said != "") & ~fits
    has_pg, has_ug = hay.rlike(r"\bpostgraduate\b|\bmasters?\b"), hay.rlike(r"\bundergraduate\b")
    return (
        F.when(name == "", "")
        .when(off & ug & F.contains(said, F.lit("postgraduate")), for_ug)
        .when(off & pg & F.contains(said, F.lit("undergraduate")) & ~F.contains(said, F.lit("postgraduate")), for_pg)
        .when(ug & has_pg & ~has_ug, for_ug)
        .when(pg & has_ug & ~has_pg, for_pg)
        .otherwise("")
    )


def errors(level: Column | None = None, declared: Column | None = None, parsed: dict[str, Column] | None = None) -> Column:
    """The errors of a row, in the order of the rules.

    parsed: columns that hold what is read from the academic blocks (sound,
    entry, english), for callers that have read them already.
    """
    rules: list[tuple[Column, Column]] = []

    def rule(condition: Column, code: str, message) -> None:
        text = message if isinstance(message, Column) else F.lit(message)
        rules.append((condition, F.concat(F.lit(code + ": "), text)))

    missing = F.array_compact(F.array(*(F.when(_cell(c) == "", F.lit(c)) for c in REQUIRED)))
    rule(
        F.size(missing) > 0,
        "MISSING_REQUIRED_FIELD",
        F.concat(F.lit("missing required field(s): "), F.array_join(missing, ", ")),
    )
    name, gpa = _cell("higherDegreeName"), _cell("higherGpa")
    rule((gpa != "") & (name == ""), "MISSING_REQUIRED_FIELD", "higherDegreeName is required when higherGpa is set")
    rule((name != "") & (gpa == ""), "MISSING_REQUIRED_FIELD", "higherGpa is required when higherDegreeName is set")
    for c in NUMBERS:
        wrong = (_cell(c) != "") & ~numbers.is_decimal(F.col(c))
        if c == "higherGpa":
            rule(wrong & (name != ""), "INVALID_FORMAT", "higherGpa must be a number when higherDegreeName is set")
        else:
            rule(wrong, "INVALID_FORMAT", f"{c} must be a number" + ("" if c == "minGpa" else " when set"))
    rule(
        (_cell("courseDuration") != "") & ~_cell("courseDuration").rlike(r"\d"),
        "INVALID_FORMAT",
        "courseDuration must contain a number (months)",
    )
    rule(
        (_cell("intakeInfo") != "") & (F.size(dates.intake_tokens(_cell("intakeInfo"))) == 0),
        "INVALID_FORMAT",
        "intakeInfo must be parseable (e.g. Sep-26, Dec-26 or Sep 2026)",
    )
    for c in META_FIELDS:
        sound = parsed["sound"] if parsed and c == META_FIELDS[0] else nested.is_metadata(F.col(c))
        rule(~sound, "INVALID_JSON", f"{c} must be MetaDataItem[]")
    for c in ("degreeName", "minDegreeName", "higherDegreeName"):
        rule(
            ~known_degree(F.col(c)),
            "UNKNOWN_DEGREE",
            F.concat(
                F.lit('Unknown degree "'), _cell(c), F.lit('" for insert - add "'), _cell(c), F.lit('" to course-degree-level-order.ts')
            ),
        )
    academic = parsed or academic_parts()
    for needle, block in (("entry", "Entry Requirements"), ("english", "English Requirement")):
        rule(
            academic["sound"] & ~academic[needle],
            "INVALID_JSON",
            f"AcademicRequirementsMetaData missing {block} block",
        )
    if level is not None:
        meta = nested.metadata(F.col("scholarshipMetaData"))
        wrong = level_mismatch(level, _cell("scholarshipName"), meta, declared if declared is not None else F.lit(""))
        rule(wrong != "", "INVALID_FORMAT", wrong)
    return F.array_compact(F.array(*(F.when(condition, text) for condition, text in rules)))


def academic_parts() -> dict[str, Column]:
    """Whether the academic blocks are sound, and whether they have an entry and an English block."""
    field = F.col(META_FIELDS[0])
    blocks = nested.metadata(field)
    return {"sound": nested.is_metadata(field), "entry": nested.has_block(blocks, "entry"), "english": nested.has_block(blocks, "english")}


def validated(df: DataFrame, level: Column | None = None, declared: Column | None = None) -> DataFrame:
    """df with errorReason: its errors joined by ' | ', '' for a sound row. The academic blocks are parsed once a row."""
    read = nested.metadata(F.col(META_FIELDS[0]))
    held = df.withColumns({"__sound": nested.is_metadata(F.col(META_FIELDS[0])), "__blocks": read})
    parsed = {"sound": F.col("__sound")} | {n: nested.has_block(F.col("__blocks"), n) for n in ("entry", "english")}
    return held.withColumn("errorReason", F.array_join(errors(level, declared, parsed), " | ")).drop("__sound", "__blocks")


def summary(reviewed: DataFrame) -> DataFrame:
    """One row: how many rows there are, and how many have an error that is not just a comment."""
    real = F.exists(F.split("errorReason", r" \| "), lambda e: (e != "") & ~e.startswith("COMMENT:"))
    return reviewed.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(real.cast("int")).alias("error_rows"))


def inferred(df: DataFrame, field: str, value: Column) -> DataFrame:
    """A blank field filled by `value` where there is one, with the comment in column <field>Comment."""
    fill = (_cell(field) == "") & (F.coalesce(value, F.lit("")) != "")
    return df.withColumns(
        {
            field: F.when(fill, value).otherwise(F.col(field)),
            f"{field}Comment": F.when(
                fill, F.concat(F.lit(f"COMMENT: {field} inferred from dictionary ("), value, F.lit(")"))
            ).otherwise(""),
        }
    )


def reviewed(df: DataFrame, fills: dict[str, Column], level: Column | None = None, declared: Column | None = None) -> DataFrame:
    """Rows with blanks filled from dictionaries, then validated: errorReason ends with a comment for each filled field,
    and `filled` lists these fields in the order of `fills`."""
    rows = df
    for field, value in fills.items():
        rows = inferred(rows, field, value)
    notes = [f"{field}Comment" for field in fills]
    rows = validated(rows, level, declared)
    said = F.filter(F.array(F.col("errorReason"), *(F.col(n) for n in notes)), lambda x: x != "")
    which = F.array_compact(F.array(*(F.when(F.col(n) != "", F.lit(f)) for f, n in zip(fills, notes, strict=True)))) if fills else F.array()
    return rows.withColumns({"errorReason": F.array_join(said, " | "), "filled": which.cast("array<string>")}).drop(*notes)


def header_error(found: list[str], required: tuple[str, ...]) -> str:
    """What is wrong with the header of a file; '' if it has all columns."""
    lacking = [c for c in required if c not in found]
    return f"MISSING_REQUIRED_FIELD: Missing required CSV headers: {', '.join(lacking)}. Found: {', '.join(found)}" if lacking else ""


def file_report(rows: DataFrame, found: list[str], required: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """The report on a file of reviewed() rows, or on one file for each value of `by`: n_rows, error_rows (those with more
    than comments), empty (blank cells of each required column), filled (rows of each filled field) and file_error.

    found: the file's header. A file that lacks columns, or has no rows, has no
    counts of cells and no error rows. With `by`, a file without rows has no row
    to be told by. Everything comes from one aggregate over the rows.
    """
    lacking = header_error(found, required)
    none = F.lit(None).cast("map<string,bigint>")
    counted = [F.count(F.lit(1)).alias("n_rows")]
    if not lacking:
        real = F.exists(F.split("errorReason", r" \| "), lambda e: (e != "") & ~e.startswith("COMMENT:"))
        counted.append(F.coalesce(F.sum(real.cast("long")), F.lit(0)).alias("error_rows"))
        counted += [F.coalesce(F.sum((_cell(c) == "").cast("long")), F.lit(0)).alias(f"__e_{c}") for c in required]
        counted += [F.coalesce(F.sum(F.array_contains("filled", c).cast("long")), F.lit(0)).alias(f"__f_{c}") for c in required]
    out = rows.groupBy(*by).agg(*counted)
    if lacking:
        return out.withColumns({"error_rows": F.lit(0).cast("long"), "empty": none, "filled": none, "file_error": F.lit(lacking)})
    pairs = lambda p: F.create_map(*(x for c in required for x in (F.lit(c), F.col(f"__{p}_{c}"))))
    empty_file = F.when(F.col("n_rows") == 0, "MISSING_REQUIRED_FIELD: CSV contains no data rows.").otherwise("")
    filled = F.map_filter(pairs("f"), lambda _, n: n > 0)
    return out.select(*by, "n_rows", "error_rows", pairs("e").alias("empty"), filled.alias("filled"), empty_file.alias("file_error"))


def page_audit(pages: DataFrame, rules: DataFrame, scope: str, body: str, fields: list[str]) -> DataFrame:
    """Pages with `found`, the text of each field, and `missing`, the names of those without one, by each university's rules.

    rules: (scope, field, place, pattern, least); the first pattern by place
    whose group 1 has `least` or more letters gives the field. A field without
    rules is missing, as are all of a page without a body or of a university
    without rules. The rules of a university are one row, so pages meet one row.
    """
    packed = rules.groupBy(scope).agg(F.array_sort(F.collect_list(F.struct("place", "field", "pattern", "least"))).alias("__rules"))
    rows = pages.join(packed, scope, "left")
    page = F.coalesce(F.col(body), F.lit(""))
    read = F.transform(
        "__rules",
        lambda r: F.struct(
            r["field"].alias("field"), F.trim(F.call_function("regexp_extract", page, r["pattern"], F.lit(1))).alias("text"), r["least"].alias("least")
        ),
    )
    rows = rows.withColumn("__read", F.filter(read, lambda r: (r["text"] != "") & (F.length(r["text"]) >= r["least"])))
    text = lambda c: F.coalesce(F.get(F.filter("__read", lambda r: r["field"] == c), 0)["text"], F.lit(""))
    found = F.create_map(*(x for c in fields for x in (F.lit(c), text(c))))
    rows = rows.withColumn("found", found)
    missing = F.array_compact(F.array(*(F.when(F.col("found")[c] == "", F.lit(c)) for c in fields)))
    return rows.withColumn("missing", missing).drop("__rules", "__read")


def audit_totals(audited: DataFrame, level: str, fields: list[str]) -> DataFrame:
    """(level, n, complete, and a column a field: the pages that lack it) of each level, and of all pages as level `all`.

    A blank level is `unknown`. One aggregate with a rollup.
    """
    named = audited.withColumn("__l", F.coalesce(F.nullif(F.trim(F.col(level)), F.lit("")), F.lit("unknown")))
    counts = [F.sum(F.array_contains("missing", c).cast("long")).alias(c) for c in fields]
    complete = F.sum((F.size("missing") == 0).cast("long")).alias("complete")
    rolled = named.rollup("__l").agg(F.grouping("__l").alias("__g"), F.count(F.lit(1)).alias("n"), complete, *counts)
    return rolled.select(F.when(F.col("__g") == 1, "all").otherwise(F.col("__l")).alias("level"), "n", "complete", *fields)


def document_issues(df: DataFrame, key: str, document: str, required: tuple[str, ...]) -> DataFrame:
    """Issues (key, severity, code, message) of nested entry documents: no JSON, absent levels, programmes without rows."""
    parsed = F.from_json(F.col(document), nested.ENTRY_DOCUMENT)
    levels = F.transform(parsed["studyLevels"], lambda x: F.lower(F.trim(x["studyLevel"])))
    bad = F.try_parse_json(F.col(document)).isNull()
    found = [F.when(bad, F.struct(F.lit("ERROR").alias("severity"), F.lit("INVALID_JSON").alias("code"), F.lit("no JSON").alias("message")))]
    for lvl in required:
        names = nested.LEVEL_NAMES.get(lvl, (lvl,))
        absent = ~bad & ~F.coalesce(any_of([F.array_contains(levels, n) for n in names]), F.lit(False))
        found.append(
            F.when(absent, F.struct(F.lit("WARN").alias("severity"), F.lit("MISSING_LEVEL").alias("code"), F.lit(lvl).alias("message")))
        )
    empty = F.exists(
        F.flatten(F.transform(parsed["studyLevels"], lambda x: x["programs"])),
        lambda p: F.coalesce(F.size(p["requirements"]), F.lit(0)) == 0,
    )
    found.append(
        F.when(
            ~bad & F.coalesce(empty, F.lit(False)),
            F.struct(F.lit("ERROR").alias("severity"), F.lit("EMPTY_REQUIREMENTS").alias("code"), F.lit("a programme has none").alias("message")),
        )
    )
    return df.select(F.col(key), F.explode(F.array_compact(F.array(*found))).alias("i")).select(key, "i.*")


def assert_clean(issues: DataFrame) -> None:
    """Raise if there is an issue of severity ERROR."""
    worst = issues.where("severity = 'ERROR'").limit(1).collect()
    if worst:
        raise ValueError(f"reference documents have errors, such as {worst[0].asDict()}")
