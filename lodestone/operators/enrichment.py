"""What a page, a university's documents and a model's answer say of a course, joined by fixed precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import nested, numbers, urls
from lodestone.functions.text import blank_to_null

TESTS = ("ielts", "toefl", "pte")
#: What the name of a test holds. Fixed values.
TEST_NAMES = {"ielts": "ielts", "toefl": "toefl", "pte": "pearson|pte"}
#: The levels that an award may name for a course's level, where they differ from it. Fixed values.
AWARD_LEVELS = {
    "foundation": ("foundation", "foundation year"),
    "undergraduate": ("undergraduate",),
    "postgraduate": ("postgraduate", "postgraduate research"),
}


def award_fields(name: Column, kind: Column, eligibility: Column, amount: Column, description: Column) -> Column:
    """Struct of an award's name, whole amount, type and blocks of text; each text once, '' for what is unknown."""
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    value = numbers.scholarship_amount(amount, description)
    whole = F.when(value >= 0, F.floor(value).cast("string")).otherwise("")
    lines = F.array_distinct(F.filter(F.array(text(eligibility), text(amount), text(description)), lambda x: x != ""))
    return F.struct(
        text(name).alias("scholarshipName"),
        whole.alias("scholarshipAmount"),
        F.when(F.lower(text(kind)) == "percentage", "Percentage")
        .when((F.lower(text(kind)) == "amount") | (whole != ""), "Amount")
        .otherwise("")
        .alias("scholarshipType"),
        F.when(F.size(lines) > 0, F.array(F.struct(F.lit("Scholarships").alias("subtitle"), lines.alias("description"))))
        .otherwise(F.array())
        .cast(nested.META)
        .alias("scholarshipMetaData"),
    )


def best_awards(courses: DataFrame, awards: DataFrame, key: str, scope: list[str], levels: dict[str, tuple[str, ...]] = AWARD_LEVELS) -> DataFrame:
    """key and award: of the awards open to each course the one of the highest value, the earlier of equal ones.

    courses: key, the columns of scope, level, name, body. awards: the columns
    of scope, ix (their order), levels (text, parted by comma, slash or &),
    name, kind, eligibility, amount, description. A course whose name or page
    says MBA takes awards that name the MBA, where there is one; other
    postgraduate courses take none of these. Courses without an open award
    have no row. The best awards of each scope and level are chosen first, so
    that the equi-join by scope and level gives each course one row however many
    awards there are; pages are read for the word before the join.
    """
    heard = F.concat_ws("\n", "name", "body").rlike(r"(?i)\bmba\b")
    asked = courses.select(F.col(key), *scope, F.lower(F.trim("level")).alias("level"), heard.alias("__mba"))
    of_token = {}
    for level, tokens in levels.items():
        for token in tokens:
            of_token.setdefault(token, []).append(level)
    known = F.create_map(*(x for t, ls in of_token.items() for x in (F.lit(t), F.array(*map(F.lit, ls)))))
    own = lambda t: F.filter(F.array(t), lambda x: ~x.isin(*levels))  # noqa: E731  a level without entry is its own name
    token = F.transform(F.split("levels", "[,/&]"), lambda x: F.lower(F.trim(x)))
    named = F.flatten(F.transform(token, lambda t: F.concat(F.coalesce(F.try_element_at(known, t), F.array().cast("array<string>")), own(t))))
    value = numbers.scholarship_amount(F.col("amount"), F.col("description"))
    offered = awards.select(
        *scope,
        F.explode(F.array_distinct(F.filter(named, lambda x: x != ""))).alias("level"),
        F.contains(F.lower(F.coalesce("name", F.lit(""))), F.lit("mba")).alias("__of_mba"),
        F.struct(value.alias("value"), (-F.col("ix")).alias("place")).alias("__rank"),
        award_fields(*(F.col(c) for c in ("name", "kind", "eligibility", "amount", "description"))).alias("award"),
    )
    # of each scope and level only two awards can be the best: one for courses of the MBA, one for others
    ranked = lambda own: F.struct(own.alias("own"), F.col("__rank").alias("rank"), F.col("award"))
    plain = ~F.col("__of_mba") | (F.col("level") != "postgraduate")
    best = offered.groupBy(*scope, "level").agg(
        F.max(ranked(F.col("__of_mba"))).alias("__mine"), F.max(F.when(plain, ranked(F.lit(False)))).alias("__other")
    )
    picked = F.when(F.col("__mba"), F.col("__mine")).otherwise(F.col("__other"))
    open_ = asked.join(best, [*scope, "level"]).select(key, picked.alias("best")).where("best is not null")
    return open_.groupBy(key).agg(F.max("best")["award"].alias("award"))


def entry_blocks(page_lines: Column, document_lines: Column, country: Column) -> Column:
    """One block of entry requirements: the page's lines, then those of the document and of the country's text that are new.

    The country's text is parted where a line says only `or`, and each part
    becomes one line. An empty array without any line.
    """
    none = F.array().cast("array<string>")
    parts = F.transform(
        F.split(F.coalesce(country, F.lit("")), r"\n\s*or\s*\n"),
        lambda p: F.array_join(F.filter(F.transform(F.split(p, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != ""), " "),
    )
    own = F.coalesce(page_lines, none)
    more = F.array_except(F.concat(F.coalesce(document_lines, none), F.filter(parts, lambda x: x != "")), own)
    lines = F.concat(own, more)
    return (
        F.when(F.size(lines) > 0, F.array(F.struct(F.lit("Entry Requirements").alias("subtitle"), lines.alias("description"))))
        .otherwise(F.array())
        .cast(nested.META)
    )


def english_fields(answer: dict[str, Column], tests: Column, text: Column, page: dict[str, Column], blocks: Column, lines: Column) -> dict[str, Column]:
    """The six test scores, '' where unknown, and the blocks on English.

    answer: the model's scores. tests: array of structs (TestName and the six
    fields) of the course's programme, null without one: a test that it has
    stands for what `text` says of that test, even to be blank; of several
    tests of a kind the last counts. page: scores read on the course's page,
    which win. Of the blocks, those of `lines` (the programme's words) replace
    the others; where there are none at all, the IELTS scores make a sentence.
    """
    from_text = numbers.test_scores(F.coalesce(text, F.lit("")))
    out = {}
    for test in TESTS:
        name = lambda t: F.lower(F.coalesce(t["TestName"], F.lit("")))
        rest = [TEST_NAMES[t] for t in TESTS[: TESTS.index(test)]]
        mine = F.filter(tests, lambda t: name(t).rlike(TEST_NAMES[test]) & (~name(t).rlike("|".join(rest)) if rest else F.lit(True)))  # noqa: B023
        for part in ("Overall", "Section"):
            field = f"{test}Min{part}"
            told = F.when(F.coalesce(F.size(mine), F.lit(0)) > 0, F.coalesce(F.trim(F.element_at(mine, -1)[field]), F.lit(""))).otherwise(from_text[field])
            first = [blank_to_null(page[field])] if field in page else []
            out[field] = F.coalesce(*first, blank_to_null(answer[field]), told)
    overall, section = out["ieltsMinOverall"], out["ieltsMinSection"]
    said = F.concat(F.lit("IELTS "), overall, F.lit(" overall"), F.when(section != "", F.concat(F.lit(" with no element below "), section)).otherwise(""))
    block = lambda d: F.array(F.struct(F.lit("English Requirement").alias("subtitle"), d.alias("description"))).cast(nested.META)
    out["blocks"] = (
        F.when(F.coalesce(F.size(lines), F.lit(0)) > 0, block(lines))
        .when(F.coalesce(F.size(blocks), F.lit(0)) > 0, blocks.cast(nested.META))
        .when(overall != "", block(F.array(said)))
        .otherwise(F.array().cast(nested.META))
    )
    return out


def diagnostics(document: Column, level: Column, subtitle: str = "Entry Requirements", key: str = "AcademicRequirementsMetaData") -> dict[str, Column]:
    """Columns on a record's JSON: how many requirement rows it has, the keys of the first, how many are sound, its text."""
    rows = nested.by_path(document, "requirements")
    listed = F.coalesce(F.json_array_length(rows), F.lit(0))
    read = F.from_json(rows, nested.REQUIREMENTS)
    sound = nested.requirements(read)
    for name in nested.ENTRY_DEGREES:
        sound = F.when(level == name, nested.requirements(read, name)).otherwise(sound)
    return {
        "req_count": listed.cast("string"),
        "req_first_keys": F.when(listed > 0, nested.signature(rows)).otherwise("empty"),
        "req_normalized_count": F.coalesce(F.size(sound), F.lit(0)).cast("string"),
        "has_degree": (F.trim(nested.by_path(document, "degreeName")) != "").cast("string"),
        "entry_text": nested.meta_text(nested.metadata(nested.by_path(document, key)), subtitle),
    }


def programme_by_rule(courses: DataFrame, programmes: DataFrame, rules: DataFrame, key: str, scope: list[str]) -> DataFrame:
    """key and programme: of each course the programme that the first rule for its level and subject finds; null for none.

    courses: key, the columns of scope, level, subject, text (address and
    title). programmes: the columns of scope, ix (order), level, subject, name.
    rules: level and subject of courses (subject '' for those that have no rule
    of their own), rank, pattern that the text must match, wanted (level of
    programmes), needle that the name must hold ({subject} stands for the
    subject), decides: no later rule counts once such a rule's pattern matches,
    found or not. All by joins on equal columns: each needle's first programme
    of a scope and subject is found first, so that a course has one row for each
    of its rules however many programmes there are; names and texts are compared
    without regard to case.
    """
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    own = rules.select(F.lower("level").alias("level"), F.lower("subject").alias("subject"), F.lit(True).alias("__own")).distinct()
    asked = courses.select(key, *scope, low(F.col("level")).alias("level"), low(F.col("subject")).alias("subject"), low(F.col("text")).alias("__text"))
    asked = asked.join(own, ["level", "subject"], "left").withColumn("rule_of", F.when(F.col("__own"), F.col("subject")).otherwise(""))
    told = rules.select(F.lower("level").alias("level"), F.lower("subject").alias("rule_of"), "rank", "pattern", F.lower("wanted").alias("wanted"), F.lower("needle").alias("needle"), "decides")
    tried = (
        asked.where("subject <> ''")
        .join(told, ["level", "rule_of"])
        .where(F.expr("rlike(__text, pattern)"))
        .withColumn("needle", F.replace("needle", F.lit("{subject}"), F.col("subject")))
        .select(key, *scope, "subject", "wanted", "needle", "rank", "decides")
    )
    listed = programmes.select(*scope, low(F.col("level")).alias("wanted"), low(F.col("subject")).alias("subject"), F.col("ix").alias("__ix"), F.col("name").alias("__name"))
    # what a needle finds is the same for all courses of a scope and subject: it is looked for once
    looked = [*scope, "wanted", "subject", "needle"]
    needles = told.select("wanted", "rule_of", "needle").distinct()
    rule_of = F.explode(F.array_distinct(F.array(F.col("subject"), F.lit("")))).alias("rule_of")
    tested = listed.select("*", rule_of).join(needles, ["wanted", "rule_of"]).withColumn("needle", F.replace("needle", F.lit("{subject}"), F.col("subject")))
    firsts = tested.where(F.contains(F.lower("__name"), F.col("needle"))).groupBy(*looked).agg(F.min(F.struct("__ix", "__name")).alias("first"))
    found = tried.join(firsts, looked, "left")
    best = F.min(F.when(F.col("first").isNotNull(), F.struct("rank", F.col("first.__ix"), F.col("first.__name"))))
    cut = F.min(F.when(F.col("decides"), F.col("rank")))
    picked = found.groupBy(key).agg(best.alias("best"), cut.alias("cut"))
    name = F.when(F.col("cut").isNull() | (F.col("best.rank") <= F.col("cut")), F.col("best.__name"))
    return courses.select(key).join(picked.select(key, name.alias("programme")), key, "left")


def band_tests(rows: DataFrame, bands: DataFrame, overrides: DataFrame) -> DataFrame:
    """rows with tests (array of name, overall, section) and notes of the band of their IELTS scores; empty arrays for none.

    rows: overall and section, besides others. bands: overall, section, others
    (array of the same structs for the other tests), notes. overrides: overall,
    section, like_overall, like_section: scores that take another band's
    equivalents. The row's own IELTS scores stay.
    """
    clean = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    as_ = overrides.select(F.col("overall").alias("__o"), F.col("section").alias("__s"), "like_overall", "like_section")
    table = bands.select(F.col("overall").alias("like_overall"), F.col("section").alias("like_section"), "others", F.col("notes").alias("__notes"))
    out = rows.withColumns({"__o": clean("overall"), "__s": clean("section")}).join(as_, ["__o", "__s"], "left")
    out = out.withColumns({"like_overall": F.coalesce("like_overall", "__o"), "like_section": F.coalesce("like_section", "__s")})
    out = out.join(table, ["like_overall", "like_section"], "left")
    kind = "array<struct<name:string,overall:string,section:string>>"
    own = F.array(F.struct(F.lit("IELTS Academic").alias("name"), F.col("__o").alias("overall"), F.col("__s").alias("section"))).cast(kind)
    return out.select(
        *rows.columns,
        F.when(F.col("others").isNotNull(), F.concat(own, F.col("others").cast(kind))).otherwise(F.array().cast(kind)).alias("tests"),
        F.coalesce("__notes", F.array().cast("array<string>")).alias("notes"),
    )


def reset_progress(completed: DataFrame, groups: DataFrame, seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is left of completed (url) and of groups (key: scope::name) once the scopes of the seeds (scope, url) start anew.

    Addresses of the same listing as a seed go, at whatever page; so do the
    groups of a seed's scope. A seed without an address only resets its scope.
    """
    families = seeds.where("url is not null").select(urls.family_key(F.col("url")).alias("__f")).distinct()
    left = completed.withColumn("__f", urls.family_key(F.col("url"))).join(families, "__f", "left_anti").drop("__f")
    scopes = seeds.where("scope <> ''").select(F.col("scope").alias("__s")).distinct()
    own = F.when(F.contains("key", F.lit("::")), F.substring_index("key", "::", 1))
    return left, groups.withColumn("__s", own).join(scopes, "__s", "left_anti").drop("__s")


def phase_summary(states: DataFrame, done: str = "done") -> DataFrame:
    """phase and n: how many universities have finished each phase of states (university, phase, status), and how many there are."""
    finished = F.count_distinct(F.when(F.col("status") == done, F.col("university")))
    phases = states.groupBy("phase").agg(finished.alias("n"))
    return states.agg(F.lit("universities").alias("phase"), F.count_distinct("university").alias("n")).unionByName(phases)
