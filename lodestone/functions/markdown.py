"""Markdown sections, lines and fields as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.dates import intake_text
from lodestone.functions.text import any_of, let, wildcard

#: Signs that a sentence is no entry requirement. Fixed values.
SKIP_ENTRY = (
    r"^see\s+", "see information about application", r"\bielts\b", r"\btoefl\b", r"\bpearson pte\b", r"\bpte academic\b",
    "english is not your first language", "english language requirement", "proficient in english", "command of english",
    "previously been taught in english", "sufficient command of english", "taught in english", "check the section",
    "please contact", "contact aru", "admissions@",
    "mailto:", "guide only", "treat everyone as an individual", "should still consider applying",
    "our decision will be based", "studying for other qualifications should contact", r"^international students$", r"^standard entry requirements$", r"^requirement \d+$",
    r"^applicants must have:\s*$", "did not achieve our required grades", "life/work skills", "whole application", "personal circumstances",
    "equivalent english", "welcome applications from international", "computer and reliable internet",
    "digital audition", "portfolios? and auditions", "clearing auditions",
)
#: Signs that a sentence is one. Fixed values.
KEEP_ENTRY = (
    r"\b2:2\b", r"\b2:1\b", r"\b3:2\b", r"\bbachelor", r"\bmaster", r"\bdegree\b", r"\bgcse\b", r"\bucas\b", r"\ba[- ]?level",
    r"\bbtec\b", r"\bib\b", r"\bhonou?rs\b", r"\bqualifications\b", r"\bnormally a minimum\b", "applicants must have:",
    r"\bphd\b", r"\bmphil\b", r"\blower second\b", r"\bupper second\b", r"\btariff points\b", r"\bdiploma\b",
    "you'll need a", "you will need a", "pass in", "at grade", r"\bcccs?\b", r"\bpoints\b",
)


def lines_of(text: Column) -> Column:
    return F.split(text, r"\r?\n")


def front_matter(text: Column) -> tuple[Column, Column]:
    """The header of a document as a map, and its body; an empty map and the text where there is no header."""
    head = F.regexp_extract(text, r"(?s)^---(.*?)---", 1)
    has = text.rlike(r"(?s)^---.*?---")
    pairs = F.filter(lines_of(F.trim(head)), lambda x: F.contains(x, F.lit(":")))
    meta = F.map_from_entries(
        F.transform(
            F.array_distinct(F.transform(pairs, lambda x: F.trim(F.regexp_extract(x, "^([^:]*):", 1)))),
            lambda k: F.struct(
                k.alias("key"),
                F.element_at(
                    F.filter(
                        F.transform(
                            pairs,
                            lambda x: F.when(
                                F.trim(F.regexp_extract(x, "^([^:]*):", 1)) == k, F.trim(F.regexp_extract(x, "^[^:]*:(.*)$", 1))
                            ),
                        ),
                        lambda v: v.isNotNull(),
                    ),
                    -1,
                ).alias("value"),
            ),
        )
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    body = F.regexp_replace(F.regexp_replace(text, r"(?s)^---.*?---", ""), r"^\n+", "")
    return F.when(has, meta).otherwise(empty), F.when(has, body).otherwise(text)


def title(body: Column, url: Column, skip: tuple[str, ...] = ()) -> Column:
    """The first level-1 heading that no skipped pattern matches, else the URL's last segment as words."""
    heads = F.filter(F.transform(lines_of(body), lambda x: F.trim(x)), lambda x: x.startswith("# "))
    names = F.transform(heads, lambda x: F.trim(F.substring(x, F.lit(3), F.length(x))))
    names = F.filter(names, lambda x: ~any_of([wildcard(x, p) for p in skip] or [F.lit(False)]))
    last = F.regexp_extract(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", ""), r"([^/]*)$", 1)
    return F.coalesce(F.nullif(F.get(names, 0), F.lit("")), F.initcap(F.replace(last, F.lit("-"), F.lit(" "))))


def section(body: Column, heading: str, level: int = 2) -> Column:
    """The text under a heading of a level up to the next heading of that level or above; '' if none."""
    p = rf"(?ims)^\#{{{level}}}[ \t]+{heading}[ \t]*$\n?(.*?)(?=^\#{{1,{level}}}[ \t]|\z)"
    return F.regexp_extract(body, p, 1)


def without_section(body: Column, heading: str, level: int, until: int | None = None) -> Column:
    """All sections that start at a matching heading (wildcards allowed) of a level and end before the next heading of
    level `until` or above are dropped."""
    stop = until or level
    text = F.concat(F.lit("\n"), F.array_join(lines_of(body), "\n"))
    white = r"[ \t\x0B\f\r]+"

    def parts(x: Column, hashes: str) -> Column:
        return F.split(x, rf"(?=\n#{{{hashes}}}{white}\S)")

    def hit(x: Column) -> Column:
        head = F.regexp_extract(x, rf"^\n#{{{level}}}{white}(.*)", 1)
        return x.rlike(rf"^\n#{{{level}}}{white}\S") & wildcard(head, heading)

    def before_hit(x: Column) -> Column:
        return let(
            parts(x, str(level)),
            lambda inner: let(
                F.array_position(F.transform(inner, hit), True).cast("int"),
                lambda at: F.array_join(F.when(at == 0, inner).otherwise(F.slice(inner, F.lit(1), F.greatest(at - 1, F.lit(0)))), ""),
            ),
        )

    # a section that a heading above ends loses all from its own heading on; one that a heading of its level or below ends is one part
    outer = parts(text, f"1,{stop}")
    kept = F.transform(outer, before_hit) if stop < level else F.filter(outer, lambda x: ~hit(x))
    return F.substring(F.array_join(kept, ""), F.lit(2), F.length(text))


def without_sections(body: Column, rules: list[tuple[str, int]]) -> Column:
    for heading, level in rules:
        body = without_section(body, heading, level)
    return body


def tidy(text: Column) -> Column:
    """No-break spaces as spaces, no spaces before line ends, at most one empty line, trimmed."""
    t = F.replace(text, F.lit(" "), F.lit(" "))
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n"))


def without_lines(text: Column, patterns: list[str]) -> Column:
    """Lines that match none of the patterns."""
    return F.array_join(F.filter(lines_of(text), lambda x: ~any_of([x.rlike(p) for p in patterns])), "\n")


def is_entry_line(text: Column) -> Column:
    """A sentence about academic entry: no sign against it and some sign for it."""
    low = F.lower(F.trim(text))
    return (low != "") & ~low.rlike("|".join(SKIP_ENTRY)) & low.rlike("|".join(KEEP_ENTRY))


def entry_lines(body: Column) -> Column:
    """Entry requirements of a course page: rows of its table as `name: value`, and its tariff and GCSE sentences."""
    lines = F.filter(F.transform(lines_of(section(body, "Entry requirements")), lambda x: F.trim(x)), lambda x: x != "")

    def read(x: Column) -> Column:
        cells = F.transform(F.split(F.regexp_replace(x, r"^\|+|\|+$", ""), r"\|"), lambda x: F.trim(x))
        rule = F.get(cells, 0).rlike("^-+$") & F.get(cells, 1).rlike("^-+$")
        head = F.lower(F.get(cells, 0)).isin("qualification", "entry requirements")
        row = F.when((F.size(cells) >= 2) & ~rule & ~head, F.concat_ws(": ", F.get(cells, 0), F.get(cells, 1)))
        ucas = F.when(x.endswith("."), x).otherwise(F.concat(x, F.lit(".")))
        gcse = x.rlike(r"(?i)\bgcse\b") & x.rlike("(?i)grade|at grade|c/4|4 or above")
        return F.when(x.startswith("|") & F.contains(F.substring(x, F.lit(2), F.length(x)), F.lit("|")), row).otherwise(
            F.when(x.rlike(r"(?i)\bucas tariff points\b"), ucas).when(gcse, x)
        )

    return F.array_distinct(F.filter(F.array_compact(F.transform(lines, read)), is_entry_line))


def international_fees(body: Column) -> Column:
    """What a page says of fees under its heading of international students."""
    return F.regexp_extract(body, r"(?is)### International students\s*(.*?)(?:--END--|\z)", 1)


def fee_options(section_: Column) -> Column:
    """(duration, fee) of each `- Full Time` line that a duration line and a fee line follow."""
    p = r"(?im)^-\s*Full Time[ \t]*\n[ \t]*- ([^\n]+)\n[ \t]*- (£[^\n]+)"
    return F.zip_with(
        F.regexp_extract_all(section_, F.lit(p), F.lit(1)),
        F.regexp_extract_all(section_, F.lit(p), F.lit(2)),
        lambda d, f: F.struct(F.trim(d).alias("duration"), F.trim(f).alias("fee")),
    )


def primary_fee(options: Column) -> Column:
    """The first option that is no placement, else the first."""
    return F.coalesce(
        F.get(F.filter(options, lambda o: ~F.contains(F.lower(o["duration"]), F.lit("placement"))), 0), F.get(options, 0)
    )


#: How pages state a start, a year's fee, a duration and the scores of a test; the first that is found counts. Fixed values.
START_DATES = (
    r"(?i)-\s*\*\*Start date:\*\*\s*([^\n]+)",
    r"(?i)-\s*\*\*Start:\*\*\s*([^\n]+)",
    r"(?i)- Start date\s+([^\n]+)",
    r"(?i)\*\*Start date\*\*\s*\n+\s*([^\n#]+)",
    r"(?i)Starting:\s*([^\n]+)",
)
YEAR_FEE = r"(?i)(?:Annual tuition fees|First year tuition fee):\s*\|\s*£([\d,]+)"
DURATION = r"(?i)\*\*Duration:\*\*\s*([^\n]+)"
IELTS_SCORES = (
    r"(?i)IELTS\s+([\d.]+)\s+overall\s+with\s+no\s+less\s+than\s+([\d.]+)\s+in\s+each\s+band",
    r"(?i)IELTS\s+([\d.]+)\s+with\s+no\s+element\s+below\s+([\d.]+)\b",
    r"(?i)IELTS\s+score\s+of\s+([\d.]+)\s*\(\s*with\s+no\s+element\s+below\s+([\d.]+)\s*\)",
)


def stage_fields(body: Column) -> Column:
    """Struct of intake, duration, fee, currency and IELTS minima of a cleaned course page; '' where it has none."""
    first = lambda ps, g=1: F.coalesce(*(F.nullif(F.trim(F.regexp_extract(body, p, g)), F.lit("")) for p in ps))
    start = first(START_DATES)
    abroad = international_fees(body)
    option = primary_fee(fee_options(abroad))
    fee = F.coalesce(
        first([YEAR_FEE]),
        F.nullif(F.regexp_extract(option["fee"], r"£([\d,]+)", 1), F.lit("")),
    )
    fee = F.coalesce(F.replace(fee, F.lit(","), F.lit("")), F.lit(""))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(
        blank(intake_text(start)).alias("intakeInfo"),
        blank(F.coalesce(first([DURATION]), option["duration"])).alias("courseDuration"),
        fee.alias("tuitionFee"),
        F.when((fee != "") | F.contains(abroad, F.lit("£")), "GBP").otherwise("").alias("currency"),
        blank(first(IELTS_SCORES, 1)).alias("ieltsMinOverall"),
        blank(first(IELTS_SCORES, 2)).alias("ieltsMinSection"),
    )


def audit(body: Column, entry_min_chars: int = 40, loose: bool = False) -> Column:
    """The names of the facts that a page lacks, of entry, intakeInfo, courseDuration, tuitionFee and ielts, in that order."""
    f = stage_fields(body)
    ielts = f["ieltsMinOverall"] != ""
    if loose:
        ielts = ielts | body.rlike(r"(?i)\bIELTS\b[^\n]{0,40}\d")
    return F.array_compact(
        F.array(
            F.when(F.length(F.trim(section(body, "Entry requirements"))) < entry_min_chars, "entry"),
            F.when(f["intakeInfo"] == "", "intakeInfo"),
            F.when(f["courseDuration"] == "", "courseDuration"),
            F.when(f["tuitionFee"] == "", "tuitionFee"),
            F.when(~ielts, "ielts"),
        )
    )


def with_level(text: Column, level: Column) -> Column:
    """The document with study_level in its header set, the header being added where there is none."""
    line = F.concat(F.lit("study_level: "), level)
    has = text.rlike(r"(?s)^---\n.*?\n---")
    known = text.rlike(r"(?s)^---\n(?:[^\n]*\n)*?study_level:[^\n]*\n")
    return (
        F.when(has & known, F.regexp_replace(text, r"(?m)\A(?s)(---\n.*?)study_level:[^\n]*", F.concat(F.lit("$1"), line)))
        .when(has, F.regexp_replace(text, r"\A---\n", F.concat(F.lit("---\n"), line, F.lit("\n"))))
        .otherwise(F.concat(F.lit("---\n"), line, F.lit("\n---\n"), text))
    )


def drop_column(table: Column, header: str) -> Column:
    """A pipe table without the column whose header is `header` (no regard to case); unchanged if there is none."""
    cells = lambda x: F.transform(F.split(F.regexp_replace(F.trim(x), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = F.filter(lines_of(table), lambda x: F.trim(x) != "")
    at = F.array_position(F.transform(cells(F.get(rows, 0)), F.lower), header.lower()).cast("int")
    put = F.transform(
        rows,
        lambda x: F.concat(
            F.lit("| "), F.array_join(F.filter(cells(x), lambda c, k: k + 1 != at), " | "), F.lit(" |")
        ),
    )
    return F.when(at > 0, F.array_join(put, "\n")).otherwise(table)
