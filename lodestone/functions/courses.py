"""Facts of course pages that are put together from several places, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import nested, numbers, text
from lodestone.functions.markdown import front_matter, lines_of, section
from lodestone.functions.text import any_of, award_label, let


def _first(*found: Column) -> Column:
    return F.coalesce(*(F.nullif(f, F.lit("")) for f in found), F.lit(""))


def degree_of_page(page: Column) -> Column:
    """The award of a page: its `- Award` line, else the first plain line of its overview, else its source file's name."""
    line = F.regexp_extract(page, r"(?i)- Award\s+([^\n]+)", 1)
    plain = F.filter(
        F.transform(lines_of(section(page, "Course overview")), lambda x: F.trim(x)),
        lambda x: (x != "") & ~x.startswith("- ") & ~F.lower(x).rlike("^(placement year|with foundation)"),
    )
    source = F.regexp_replace(F.regexp_extract(page, r"(?is)^---.*?source_html:\s*([^\n]+)", 1), r"\.html", "")
    parts = F.filter(F.transform(F.reverse(F.split(source, " - ")), award_label), lambda x: x != "")
    return F.when(line != "", award_label(line)).otherwise(
        _first(award_label(F.coalesce(F.get(plain, 0), F.lit(""))), F.coalesce(F.get(parts, 0), F.lit("")))
    )


def degree_by_rules(name: Column, page: Column, level: Column) -> Column:
    """The award of the page, else of the name, else PhD for research courses."""
    return _first(
        degree_of_page(F.coalesce(page, F.lit(""))),
        text.degree_of_name(F.coalesce(name, F.lit(""))),
        F.when(level == "postgraduate_research", "PhD").otherwise(""),
    )


def excerpt(page: Column, chars: int = 2500) -> Column:
    """What a model needs to tell a degree: level, address, title and three sections, cut with an ellipsis."""
    meta, body = front_matter(page)
    told = [
        F.when(F.coalesce(meta[k], F.lit("")) != "", F.concat(F.lit(f"{k}: "), meta[k])) for k in ("study_level", "course_url")
    ]
    head = F.trim(F.regexp_extract(body, r"(?m)^#\s+(.+)$", 1))
    told.append(F.when(head != "", F.concat(F.lit("title: "), head)))
    for name in ("Key information", "Course overview", "Entry requirements"):
        part = F.trim(section(body, name), F.lit(" \n"))
        told.append(F.when(part != "", F.concat(F.lit(f"## {name}\n"), part)))
    whole = F.concat_ws("\n\n", *told)
    return F.when(F.length(whole) > chars, F.concat(F.rtrim(F.substring(whole, 1, chars - 3)), F.lit("..."))).otherwise(whole)


def snippet(body: Column, value: Column) -> Column:
    """The first line of a page that holds a value: where it was read."""
    lines = F.transform(lines_of(body), lambda x: F.trim(x))
    return F.when(value != "", F.coalesce(F.get(F.filter(lines, lambda x: F.contains(x, value)), 0), F.lit(""))).otherwise("")


def for_offers(lines: Column, course_text: Column) -> Column:
    """Lines that start with an offer (`AAB — …`) stay only where the course names that offer; others stay."""
    offer = lambda x: F.regexp_extract(F.trim(x), r"^([A-D]{3})\s*[—\-–]", 1)
    return let(
        text.offer_grades(course_text),
        lambda own: F.when(F.size(own) == 0, lines).otherwise(
            F.filter(lines, lambda x: (offer(x) == "") | F.array_contains(own, offer(x)))
        ),
    )


def country_descriptions(document: Column, level: str) -> Column:
    """Description lines of the first programme of a level of a nested entry document."""
    names = nested.LEVEL_NAMES.get(level, (level,))
    levels = F.filter(
        F.from_json(document, nested.ENTRY_DOCUMENT)["studyLevels"], lambda x: F.lower(F.trim(x["studyLevel"])).isin(*names)
    )
    lines = F.transform(F.get(F.get(levels, 0)["programs"], 0)["description"], lambda x: F.trim(x))
    return F.coalesce(F.filter(lines, lambda x: x != ""), F.array().cast("array<string>"))


def country_rows(document: Column, page: Column, level: str) -> Column:
    """Requirement rows of a country: of the JSON document, else of a page's bullets, else of its sentences."""
    from_json = nested.requirements(nested.country_requirements(document, level), level)
    block = F.regexp_extract(page, r"(?is)#{2,4}\s*Bangladesh\s*\n(.*?)(?=\n#{2,4}\s|\z)", 1)
    part = F.when(block != "", block).otherwise(F.coalesce(page, F.lit("")))

    def row(degree: str, *patterns: tuple[str, str, str]) -> Column:
        found = [
            F.when(F.regexp_extract(part, p, 1) != "", F.concat(F.lit(before), F.regexp_extract(part, p, 1), F.lit(after)))
            for p, before, after in patterns
        ]
        grade = F.coalesce(*found)
        return F.when(grade.isNotNull(), F.struct(F.lit(degree).alias("degree"), grade.alias("grade")))

    rows = {
        "foundation": [row("HSC", (r"(?i)CGPA\s*([\d.]+)", "CGPA ", ""), (r"(\d+)\s*%", "", "%"))],
        "undergraduate": [
            row("HSC", (r"(?i)HSC[^\d]*CGPA\s*([\d.]+)", "CGPA ", "")),
            row("Diploma", (r"(?i)Diploma[^\d]*(\d+)\s*%", "", "%")),
        ],
        "postgraduate": [
            row("BSc", (r"(?i)bachelor[^\d]*(\d+)\s*%", "", "%"), (r"(?i)bachelor[^\d]*CGPA\s*([\d.]+)", "CGPA ", "")),
            row("MSc", (r"(?i)master[^\d]*(\d+)\s*%", "", "%"), (r"(?i)master[^\d]*CGPA\s*([\d.]+)", "CGPA ", "")),
        ],
    }.get(level, [])
    told = F.array_compact(F.array(*rows)) if rows else F.array().cast(nested.REQUIREMENTS)
    bullet = nested.bullets(part)
    return F.when(F.size(from_json) > 0, from_json).when(F.size(bullet) > 0, bullet).otherwise(told)


def academic_blocks(entry: Column, country: Column, english: Column, overall: Column, least: Column) -> Column:
    """Entry and English blocks: entry lines of the page, then of the country, each once; English lines, else a sentence
    of the scores. Empty blocks go."""
    lines = F.array_distinct(F.concat(entry, country))
    sentence = F.concat(
        F.lit("IELTS "),
        overall,
        F.lit(" overall"),
        F.when(least != "", F.concat(F.lit(" with no element below "), least)).otherwise(""),
    )
    spoken = F.when(F.size(english) > 0, english).when(overall != "", F.array(sentence)).otherwise(F.array().cast("array<string>"))
    blocks = F.array(
        F.struct(F.lit("Entry Requirements").alias("subtitle"), lines.alias("description")),
        F.struct(F.lit("English Requirement").alias("subtitle"), spoken.alias("description")),
    )
    return F.filter(blocks, lambda b: F.size(b["description"]) > 0)


def fee_object(json: Column) -> Column:
    """Struct (fee, currency) of a fees object: its own tuitionFee, else of its first key that says international."""
    v = F.try_parse_json(json)
    own = numbers.fee_number(F.coalesce(F.try_variant_get(v, "$.tuitionFee", "string"), F.lit("")))
    said = F.coalesce(F.trim(F.try_variant_get(v, "$.currency", "string")), F.lit(""))
    keys = F.filter(
        F.json_object_keys(F.to_json(v)),
        lambda k: F.contains(F.lower(k), F.lit("international")) & ~F.lower(k).isin("tuitionfee", "currency", "placementyearfee"),
    )
    entries = F.from_json(json, "map<string,string>")

    def one(k: Column) -> Column:
        inner = F.try_parse_json(entries[k])
        fee = F.coalesce(
            F.try_variant_get(inner, "$.fee", "string"), F.try_variant_get(inner, "$.tuitionFee", "string"), entries[k]
        )
        return F.struct(
            numbers.fee_number(fee).alias("fee"),
            F.coalesce(F.nullif(F.trim(F.try_variant_get(inner, "$.currency", "string")), F.lit("")), F.lit("GBP")).alias("currency"),
        )

    first = F.get(F.filter(F.transform(keys, one), lambda s: s["fee"] != ""), 0)
    return F.when(
        own != "", F.struct(own.alias("fee"), F.when(said == "", "GBP").otherwise(said).alias("currency"))
    ).otherwise(F.coalesce(first, F.struct(F.lit("").alias("fee"), F.lit("").alias("currency"))))


def _shown(fee: Column) -> Column:
    whole = F.replace(fee, F.lit(","), F.lit("")).try_cast("bigint")
    return F.concat(F.lit("£"), F.coalesce(F.format_number(whole, 0), fee))


def fee_blocks(json: Column, fee: Column, own_fee: Column | None = None) -> Column:
    """A fees object as a block of lines: the international fee (given, else its own) and the placement year's.

    own_fee: where false, the line of the international fee is left out.
    """
    v = F.try_parse_json(json)
    own = F.coalesce(F.nullif(fee, F.lit("")), F.try_variant_get(v, "$.tuitionFee", "string"))
    placement = F.try_variant_get(v, "$.placementYearFee", "string")
    lines = F.array_compact(
        F.array(
            F.when(
                (F.coalesce(own, F.lit("")) != "") & (F.lit(True) if own_fee is None else own_fee),
                F.concat(F.lit("International tuition fee: "), _shown(own), F.lit(" (full-time, per year)")),
            ),
            F.when(F.coalesce(placement, F.lit("")) != "", F.concat(F.lit("Placement year fee: "), _shown(placement))),
        )
    )
    block = F.array(F.struct(F.lit("Fees").alias("subtitle"), lines.alias("description")))
    return F.filter(block, lambda b: F.size(b["description"]) > 0)


def with_fee_line(blocks: Column, fee: Column) -> Column:
    """The fee as first line of the Fees blocks, whose placeholder lines go; a new block in front where there is none."""
    line = F.concat(F.lit("International tuition fee: "), _shown(fee))
    is_fees = lambda b: F.lower(F.trim(b["subtitle"])) == "fees"
    put = F.transform(
        blocks,
        lambda b: F.when(
            is_fees(b),
            F.struct(
                b["subtitle"].alias("subtitle"),
                F.concat(
                    F.array(line),
                    F.filter(
                        b["description"],
                        lambda d: ~F.lower(d).rlike(r"find out more about the international student fee|example\.com"),
                    ),
                ).alias("description"),
            ),
        ).otherwise(F.struct(b["subtitle"].alias("subtitle"), b["description"].alias("description"))),
    )
    new = F.array(F.struct(F.lit("Fees").alias("subtitle"), F.array(line).alias("description")))
    return F.when(F.exists(blocks, is_fees), put).otherwise(F.concat(new, blocks))


def research_fee(body: Column) -> Column:
    return F.replace(
        F.regexp_extract(body, r"(?is)difference between.*?tuition fees is\s*£([\d,]+)", 1), F.lit(","), F.lit("")
    )


def research_duration(body: Column) -> Column:
    """A stated duration with a number of years or months, else the full-time years of its completion table."""
    said = [
        F.trim(F.regexp_extract(body, p, 1))
        for p in (
            r"(?i)\*\*Duration:\*\*\s*([^\n]+)",
            r"(?i)Programme length:\s*([^\n]+)",
            r"(?i)-\s*\*\*Type:\*\*\s*Research\s*\(([^)]+)\)",
        )
    ]
    table = F.regexp_extract(body, r"(?is)Completion\s+(?:dates|times)\s*\n+(.*?)(?=\n##\s|\nFor further guidance|\z)", 1)
    years = r"(\d+(?:\.\d+)?(?:-\d+(?:\.\d+)?)?\s*years?)"
    listed = [
        F.regexp_extract(table, rf"(?i){who}:\s*full-time\s+{years}", 1)
        for who in ("PhD", r"PhD via progression[^:\n]*", "MPhil")
    ]
    return _first(*(F.when(s.rlike(r"(?i)\d+\s*(?:year|month)"), s).otherwise("") for s in said), *listed)


def starting_fee(body: Column) -> Column:
    """The fee next to 'International students starting', before or after it."""
    return F.replace(
        _first(
            *(
                F.regexp_extract(body, p, 1)
                for p in (
                    r"(?i)£([\d,]+)\s+International students starting",
                    r"(?i)\*\*£([\d,]+)\*\*\s*International students starting",
                    r"(?i)International students starting[^£\n]{0,40}\*\*£([\d,]+)\*\*",
                    r"(?i)International students starting[^.\n]{0,80}£([\d,]+)\s*(?:\(|per year|full-time)",
                )
            )
        ),
        F.lit(","),
        F.lit(""),
    )


def key_information(body: Column) -> Column:
    """Struct of intake, duration and fee of a page's key information section; '' where it has none."""
    part = section(body, "Key information")
    under = lambda h: F.trim(F.regexp_extract(part, rf"(?i)### {h}[^\n]*\n+-\s*([^\n]+)", 1))
    month, years = under("Month of entry"), F.regexp_extract_all(under("Year of entry"), F.lit(r"\b(20\d{2})\b"), F.lit(1))
    ordered = F.sort_array(F.array_distinct(years), asc=False)
    of_year = (
        F.when(F.size(ordered) == 1, F.concat(F.lit("September "), F.get(ordered, 0)))
        .when(F.size(ordered) > 1, F.concat(F.lit("January "), F.get(ordered, 0), F.lit(", September "), F.get(ordered, 1)))
        .otherwise("")
    )
    academic = F.regexp_extract(part, r"(?i)### Fees for (\d{4})/\d{2}", 1)
    dated = F.when(
        (academic != "") & ~month.rlike(r"\b(19|20)\d{2}\b") & (month != ""),
        F.concat(F.trim(F.get(F.split(month, ","), 0)), F.lit(" "), academic),
    ).otherwise(month)
    span = under("Duration of study")
    least = F.array_min(F.transform(F.regexp_extract_all(span, F.lit(r"(?i)(\d+)\s*years?"), F.lit(1)), lambda x: x.try_cast("int")))
    fee = _first(
        F.regexp_extract(under(r"Fees for \d{4}/\d{2}"), r"(?i)International[^£]*£([\d,]+)", 1),
        F.regexp_extract(section(body, "Fees and funding"), r"(?i)International[^£\n]*£([\d,]+)", 1),
    )
    return F.struct(
        _first(of_year, dated).alias("intakeInfo"),
        F.coalesce(F.concat(least.cast("string"), F.lit(" years")), span).alias("courseDuration"),
        F.replace(fee, F.lit(","), F.lit("")).alias("tuitionFee"),
    )


def row_scores(table: Column, label: Column) -> Column:
    """Struct of IELTS minima in a pipe table's row of the label; the label is taken literally."""
    p = F.concat(
        F.lit(r"(?i)\|?\s*"), F.regexp_replace(label, r"([^A-Za-z0-9 ])", r"\\$1"),
        F.lit(r"\s*\|\s*(?:IELTS[^|]*?)?([\d.]+)\s+overall with no element below\s+([\d.]+)"),
    )
    return F.struct(
        F.call_function("regexp_extract", table, p, F.lit(1)).alias("ieltsMinOverall"),
        F.call_function("regexp_extract", table, p, F.lit(2)).alias("ieltsMinSection"),
    )


def row_label(table: Column, name: Column, default: str = "") -> Column:
    """The label of the first table row that is the course's name or a longer part of it and states scores."""
    cells = lambda x: F.transform(F.split(F.regexp_replace(F.trim(x), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    low = F.lower(name)

    def fits(x: Column) -> Column:
        label = F.lower(F.get(cells(x), 0))
        near = (label == low) | ((F.length(label) > 8) & F.contains(low, label))
        return F.contains(x, F.lit("|")) & near & F.coalesce(F.get(cells(x), 1).rlike(r"(?i)\d\.\d|overall|minimum"), F.lit(False))

    rows = F.filter(lines_of(table), fits)
    return F.when(F.size(rows) > 0, F.get(cells(F.get(rows, 0)), 0)).otherwise(default)


def study_options(body: Column) -> Column:
    """The first line that is not blank after a line 'Study options'; '' if there is none."""
    return F.trim(F.regexp_extract(body, r"(?im)^[ \t]*Study options[ \t]*\n\s*([^\n]+)", 1))


def excluded_page(body: Column, url: Column, kinds: list[str] = (), urls_: list[str] = ()) -> Column:
    """A part-time-only page, one whose course type matches a pattern, or one whose address does."""
    kind = F.trim(F.regexp_extract(body, r"(?im)^[-*\s]*\**Course type:?\**:?\s*([^\n]+)$", 1))
    tests = [text.part_time_only(study_options(body))]
    tests += [(kind != "") & text.wildcard(kind, p) for p in kinds]
    tests += [text.wildcard(url, p) for p in urls_]
    return any_of(tests)


def letter_page(url: Column) -> Column:
    """A page of an A-Z list: a letter in the query and a-z in the path."""
    return url.rlike(r"[?&]letter=") & F.lower(F.regexp_replace(url, r"[?#].*$", "")).rlike("a-to-z|atoz|a-z")


def first_of(labels: Column, order: list[str]) -> Column:
    """The value of the first key of a map that is there and not blank: an ordered list of preferences."""
    return _first(*(F.coalesce(labels[k], F.lit("")) for k in order))


def pairs_of(lines: Column) -> Column:
    """Map of label lines to the line after each, of lines that come in turns; blank lines do not count."""
    full = F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")
    even = F.filter(full, lambda x, k: k % 2 == 0)
    odd = F.filter(full, lambda x, k: k % 2 == 1)
    rows = F.zip_with(even, odd, lambda k, v: F.struct(F.lower(k).alias("key"), F.coalesce(v, F.lit("")).alias("value")))
    seen = F.array_distinct(F.transform(rows, lambda r: r["key"]))
    return F.map_from_entries(
        F.transform(
            seen,
            lambda k: F.struct(k.alias("key"), F.get(F.filter(rows, lambda r: r["key"] == k), 0)["value"].alias("value")),
        )
    )


def facts_block(labels: Column, order: list[str]) -> Column:
    """`- **Label:** value` lines of a map, in the order given, blanks left out."""
    return F.concat_ws(
        "\n", *(F.when(F.coalesce(labels[k.lower()], F.lit("")) != "", F.concat(F.lit(f"- **{k}:** "), labels[k.lower()])) for k in order)
    )


def unspaced_title(name: Column, url: Column) -> Column:
    """A title set in spaced letters replaced by the words of its address."""
    last = F.regexp_extract(F.regexp_replace(url, "/+$", ""), "([^/]*)$", 1)
    return F.when(name.rlike(r"^(?:\S ){4,}\S$"), F.initcap(F.replace(last, F.lit("-"), F.lit(" ")))).otherwise(name)


def without_when_both(body: Column, one: str, other: str, drop) -> Column:
    """drop(body) where both headings are there, else the body."""
    has = reduce(lambda a, b: a & b, [body.rlike(rf"(?im)^#+\s+{h}\s*$") for h in (one, other)])
    return F.when(has, drop(body)).otherwise(body)
