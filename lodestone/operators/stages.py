"""The two stages of a course record: what a page's parser owns, what a model may add, and how both become one row.

A stage is a row; nothing here joins or shuffles. Model answers come as JSON
text or typed columns, pages as the body of a cleaned document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import courses, markdown, nested, numbers
from lodestone.functions.text import ENTRY_DEGREES, any_of
from lodestone.operators.validate import drop_ungrounded

#: Fields that the page decides, even to be empty. Fixed values.
PARSER_OWNED = ("intakeInfo", "courseDuration", "tuitionFee", "currency", "ieltsMinOverall", "ieltsMinSection")
#: Fields of a model's answer that the page must hold. Fixed values.
GROUNDED = (
    "initialDeposit", "applicationFee", "applicationDeadline", "toeflMinOverall", "toeflMinSection", "pteMinOverall",
    "pteMinSection",
)
#: Test scores: the first two only fill blanks of the page, the others replace. Fixed values.
FILLING_SCORES = ("ieltsMinOverall", "ieltsMinSection")
REPLACING_SCORES = ("toeflMinOverall", "toeflMinSection", "pteMinOverall", "pteMinSection")
#: Fields that a model's second stage replaces unless it has none. Fixed values.
MODEL_TEXTS = ("scholarshipName", "scholarshipAmount", "scholarshipType")
MODEL_LISTS = ("AcademicRequirementsMetaData", "scholarshipMetaData")
#: Lines of a page that state an offer where it has no table of them. Fixed values.
OFFER_BULLET = r"^- \*\*(?:A-levels|BTEC):\*\*"
OFFER_MENTION = r"\b(?:BCC|BBB|BBC|CCD|CDD|DDM|DMM)\b"
OFFER_CONTEXT = r"A-level|^[BC]/"

_LINES = "array<string>"


def _said(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def _or(first: Column, second: Column) -> Column:
    return F.when(_said(first) != "", first).otherwise(second)


def fee_on_page(fee: Column, body: Column) -> Column:
    """The page holds the fee, as it is or with thousands marks."""
    marked = F.when(fee.rlike(r"^\d+$"), F.format_number(fee.try_cast("bigint"), 0))
    return (fee != "") & (F.contains(body, fee) | F.coalesce(F.contains(body, marked), F.lit(False)))


def parser_owned(df: DataFrame, body: str, fees: str = "feesMetaData") -> DataFrame:
    """Rows whose PARSER_OWNED fields are the page's, '' where it states none, and whose fees are blocks.

    fees: JSON text of a model. An object gives a fee or a currency that the
    page's parser did not find (a fee only if the page holds it) and turns into
    lines; blocks stay. A known fee is the first line. A null body is an empty
    page: then an object's fee is taken as it is. Unreadable fees are no blocks.
    """
    page = F.coalesce(F.col(body), F.lit(""))
    rows = df.withColumn("__hints", markdown.stage_fields(page)).withColumns({c: F.col(f"__hints.{c}") for c in PARSER_OWNED})
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(fees)).startswith("OBJECT"), F.lit(False))
    rows = rows.withColumns({"__object": is_object, "__fee": F.when(is_object, courses.fee_object(F.col(fees)))})
    own = F.try_variant_get(F.try_parse_json(fees), "$.currency", "string")
    blank = F.col("tuitionFee") == ""
    found = F.coalesce(F.col("__fee.fee"), F.lit(""))
    held = (found != "") & ((page == "") | fee_on_page(found, page))
    # an object's currency counts where its fee was asked for, else only what it says itself
    told = F.when(blank & (found != ""), F.col("__fee.currency")).otherwise("")
    rows = rows.withColumns(
        {
            "tuitionFee": F.when(F.col("__object") & blank & held, found).otherwise(F.col("tuitionFee")),
            "currency": F.when(F.col("__object"), _or(F.col("currency"), _or(told, _said(own)))).otherwise(F.col("currency")),
        }
    )
    stated = F.col("tuitionFee") != ""
    lines = courses.fee_blocks(F.col(fees), F.lit(""), own_fee=~stated)
    blocks = F.when(F.col("__object"), lines).otherwise(nested.metadata(F.col(fees)))
    rows = rows.withColumn("__blocks", F.coalesce(blocks, F.array().cast(nested.META)).cast(nested.META))
    put = F.when(stated, courses.with_fee_line(F.col("__blocks"), F.col("tuitionFee")).cast(nested.META)).otherwise(F.col("__blocks"))
    return rows.withColumn(fees, put).drop("__hints", "__object", "__fee", "__blocks")


def stated_offers(body: Column) -> Column:
    """Entry lines of a page: those of its table, else its bullets and sentences that name an offer."""
    lines = F.transform(markdown.lines_of(body), lambda x: F.trim(x))
    bullet = lambda x: x.rlike(OFFER_BULLET)
    named = F.filter(lines, lambda x: bullet(x) | (x.rlike(OFFER_MENTION) & x.rlike(OFFER_CONTEXT)))
    plain = F.transform(named, lambda x: F.when(bullet(x), F.regexp_replace(x, "^[- ]+", "")).otherwise(x))
    table = markdown.entry_lines(body)
    return F.coalesce(F.when(F.size(table) > 0, table), plain, F.array().cast(_LINES))


def enriched(df: DataFrame, body: str, name: str, url: str) -> DataFrame:
    """A model's first stage made whole by its page: names filled, PARSER_OWNED fields put, GROUNDED ones held against
    the page (`warnings` lists what went), entry lines taken from the page where the answer has none.

    df: courseName, courseUrl, degreeName, GROUNDED as texts, feesMetaData and
    AcademicRequirementsMetaData as JSON text. Nulls count as blank.
    """
    page = F.coalesce(F.col(body), F.lit(""))
    rows = parser_owned(df, body)
    rows = rows.withColumns(
        {
            "courseName": _or(F.col("courseName"), F.col(name)),
            "courseUrl": _or(F.col("courseUrl"), F.col(url)),
            "degreeName": _or(F.col("degreeName"), F.coalesce(courses.degree_of_page(page), F.lit(""))),
        }
    )
    rows = drop_ungrounded(rows, list(GROUNDED), body)
    blocks = nested.metadata(F.col("AcademicRequirementsMetaData"))
    rows = rows.withColumns({"__blocks": blocks, "__offers": stated_offers(page)})
    entry = F.exists(
        "__blocks",
        lambda b: (F.lower(F.trim(b["subtitle"])) == "entry requirements") & F.exists(b["description"], markdown.is_entry_line),
    )
    own = F.array(F.struct(F.lit("Entry Requirements").alias("subtitle"), F.col("__offers").alias("description"))).cast(nested.META)
    put = F.when(~entry & (F.size("__offers") > 0), own).otherwise(F.col("__blocks"))
    return rows.withColumn("AcademicRequirementsMetaData", put).drop("__blocks", "__offers")


def expected_fields(body: Column, name: Column, url: Column, degree: Column) -> Column:
    """JSON text of what a page states, for a model to be held against; its fee options where there are several."""
    line = lambda label: F.trim(F.regexp_extract(body, rf"- {label}\s+([^\n]+)", 1))
    fields = markdown.stage_fields(body)
    abroad = markdown.international_fees(body)
    options = F.array_distinct(markdown.fee_options(abroad))
    option = markdown.primary_fee(options)
    shown = F.transform(
        options,
        lambda o: F.struct(F.lit("Full Time").alias("studyMode"), o["duration"].alias("courseDuration"), o["fee"].alias("tuitionFee")),
    )
    blank = lambda c: F.coalesce(c, F.lit(""))
    currency = F.when(option.isNotNull() | F.contains(abroad, F.lit("£")), "GBP").otherwise("")
    return F.to_json(
        F.struct(
            blank(name).alias("courseName"),
            blank(url).alias("courseUrlExternal"),
            blank(degree).alias("degreeName"),
            *(line(label).alias(key) for label, key in (("Level", "level"), ("Study mode", "studyMode"), ("Award", "award"))),
            fields["intakeInfo"].alias("intakeInfo"),
            _or(fields["courseDuration"], blank(option["duration"])).alias("courseDuration"),
            _or(fields["tuitionFee"], blank(option["fee"])).alias("tuitionFee"),
            _or(fields["currency"], currency).alias("currency"),
            fields["ieltsMinOverall"].alias("ieltsMinOverall"),
            fields["ieltsMinSection"].alias("ieltsMinSection"),
            F.when(F.size(options) > 1, shown).alias("tuitionFeeOptions"),
        )
    )


def _of_level(level: Column, rows) -> Column:
    """rows(level) by the level of the row; a level without rules of its own is '' to rows()."""
    found = None
    for name in ENTRY_DEGREES:
        found = F.when(level == name, rows(name)) if found is None else found.when(level == name, rows(name))
    return found.otherwise(rows(""))


def equivalent_requirements(body: Column, level: Column) -> Column:
    """The school grade that a page's offer or tariff points are worth, for courses that start from school."""
    text = numbers.school_gpa_text(body)
    row = F.array(F.struct(F.lit("HSC").alias("degree"), text.alias("grade"))).cast(nested.REQUIREMENTS)
    return F.when(level.isin("foundation", "undergraduate") & (text != ""), row).otherwise(F.array().cast(nested.REQUIREMENTS))


def merged_stages(df: DataFrame, model: str, body: str, level: str, entry: str, country: str) -> DataFrame:
    """Second-stage rows: the page's row with what the struct column `model` says, by the precedence of each field.

    MODEL_TEXTS and MODEL_LISTS replace unless empty; of test scores IELTS only
    fills blanks and the others replace; a deposit replaces and its fee blocks
    follow, but for subtitles that are there. Requirements are the model's, with
    the country's (JSON `entry`, else page `country`) after them, or instead of
    them where the model has none or, for postgraduates, only school and first
    degrees; what the page's offer is worth comes last. Each row stays once.

    df has the fields as columns, lists as arrays; `model` has the same fields.
    A null in `model`, or a null model, is nothing said.
    """
    lvl = F.coalesce(F.col(level), F.lit(""))
    said = lambda c: F.col(f"{model}.{c}")
    put = {c: _or(said(c), F.col(c)) for c in (*MODEL_TEXTS, *REPLACING_SCORES, "initialDeposit")}
    put |= {c: _or(F.col(c), said(c)) for c in FILLING_SCORES}
    put |= {c: F.when(F.size(said(c)) > 0, said(c)).otherwise(F.col(c)) for c in MODEL_LISTS}
    no_blocks = F.array().cast(nested.META)
    fees = F.transform(
        F.coalesce(said("feesMetaData"), no_blocks),
        lambda b: F.struct(
            F.coalesce(F.nullif(b["subtitle"], F.lit("")), F.lit("Initial tuition Deposit")).alias("subtitle"), b["description"].alias("description")
        ),
    )
    put["feesMetaData"] = nested.merge_by_subtitle(F.coalesce("feesMetaData", no_blocks), fees.cast(nested.META))
    asked = F.when(F.size(said("requirements")) > 0, said("requirements")).otherwise(F.col("requirements"))
    rows = df.withColumns(
        {
            "__own": _of_level(lvl, lambda x: nested.requirements(asked, x)),
            "__country": _of_level(lvl, lambda x: nested.requirements(courses.country_rows(F.col(entry), F.col(country), x), x)),
            "__worth": F.when(_said(F.col(body)) != "", equivalent_requirements(F.col(body), lvl)),
        }
    )
    given = any_of([_said(F.col(c)) != "" for c in (entry, country)]) & (lvl != "")
    low = (lvl == "postgraduate") & F.forall("__own", lambda r: r["degree"].isin(*ENTRY_DEGREES["undergraduate"]))
    instead = given & (F.size("__country") > 0) & ((F.size("__own") == 0) | low)
    after = F.when(given, F.col("__country")).otherwise(F.array().cast(nested.REQUIREMENTS))
    chosen = F.when(instead, F.col("__country")).otherwise(F.concat("__own", after))
    every = F.concat(chosen, F.coalesce("__worth", F.array().cast(nested.REQUIREMENTS)))
    put["requirements"] = nested.distinct_requirements(every)
    return rows.withColumns(put).drop("__own", "__country", "__worth")


def with_stage_blocks(blocks: Column, stage: Column, overall: Column, least: Column) -> Column:
    """Academic blocks with the first stage's entry block in front if they have none, and, where a score is known and no
    English block has lines, an English block that states it."""
    called = lambda b, name: F.lower(F.trim(b["subtitle"])) == name
    entry = F.get(F.filter(stage, lambda b: called(b, "entry requirements")), 0)
    none = F.array().cast(nested.META)
    lacking = ~F.exists(blocks, lambda b: called(b, "entry requirements")) & entry.isNotNull()
    first = F.when(lacking, F.concat(F.array(entry).cast(nested.META), blocks)).otherwise(blocks)
    score, section = _said(overall), _said(least)
    text = F.concat(
        F.lit("IELTS "), score, F.lit(" overall"), F.when(section != "", F.concat(F.lit(" with no element below "), section)).otherwise("")
    )
    english = F.array(F.struct(F.lit("English Requirement").alias("subtitle"), F.array(text).alias("description"))).cast(nested.META)
    spoken = F.exists(blocks, lambda b: called(b, "english requirement") & (F.size(b["description"]) > 0))
    return F.concat(first, F.when((score != "") & ~spoken, english).otherwise(none))
