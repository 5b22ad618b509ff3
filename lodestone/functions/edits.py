"""Edits of markdown that name where they end: sections up to a stop, labelled bullets, facts of two sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.text import let

#: A heading with the academic year it is for, and the fee of full-time study in the table under it. Fixed values.
YEAR_HEADING = r"### (\d{4})/\d{2}[ \t]*\n"
FULL_TIME = r"(?i)\|\s*Full-time\s*\|\s*£([\d,]+)\s*per year"


def _quoted(text: str) -> str:
    return r"\Q" + text.strip().replace(r"\E", r"\E\\E\Q") + r"\E"


def without_until(body: Column, heading: str, level: int, stops: list[str]) -> Column:
    """A section of a level goes, and all after it up to a heading of that level or above that is one of `stops`.

    Names are compared without regard to case. Other headings do not end what
    goes; where no stop follows, all the rest goes. Without stops that is so
    wherever the section stands.
    """
    end = r"\z"
    if stops:
        end = rf"^#{{1,{level}}}[ \t]+(?:{'|'.join(map(_quoted, stops))})[ \t]*$|\z"
    start = rf"^#{{{level}}}[ \t]+{_quoted(heading)}[ \t]*$"
    cut = F.regexp_replace(body, rf"(?imsu){start}.*?(?={end})", "")
    return F.when(cut == body, body).otherwise(F.regexp_replace(cut, r"\n\z", ""))


def latest_full_time_fee(section: Column, year: str = YEAR_HEADING, fee: str = FULL_TIME) -> Column:
    """Digits of the full-time fee of the latest year, of two blocks of that year the later one's; null without any.

    A block that also has a part-time fee is for students from home and is passed over.
    """
    def read(block: Column, at: Column) -> Column:
        table = F.regexp_extract(F.regexp_replace(block, rf"\A{year}\s*", ""), r"(?s)\A(.*?)(?:\n\n|\z)", 1)
        return F.struct(
            F.regexp_extract(block, rf"\A{year}", 1).try_cast("int").alias("year"),
            at.alias("at"),
            F.replace(F.regexp_extract(table, fee, 1), F.lit(",")).alias("fee"),
            table.rlike("(?i)part-time").alias("home"),
        )

    blocks = F.transform(F.split(section, f"(?={year})"), read)
    return F.array_max(F.filter(blocks, lambda b: b["year"].isNotNull() & (b["fee"] != "") & ~b["home"]))["fee"]


def _label(bullet: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(bullet), r"^-\s*\*\*([^:*]+):", 1))


def with_bullets(body: Column, heading: str, bullets: Column) -> Column:
    """The bullets put into the section of a heading line: one whose label stands there takes its place, others follow.

    A label is what stands before the colon of `- **Label:** value`, in any
    case. Of new bullets of one label the last counts, at the place of the first.
    Bullets without a label are left out; lines of the section that are no bold
    bullets go. A body without the heading, and null bullets, change nothing.
    """
    at = F.instr(body, heading)
    rest = F.substring(body, at + len(heading), F.length(body))
    part = F.regexp_extract(rest, r"(?s)^(.*?)(?=\r?\n##\s|\z)", 1)
    tail = F.substring(rest, F.length(part) + 1, F.length(rest))
    held = F.filter(F.split(part, r"\r?\n"), lambda x: F.trim(x).startswith("- **"))
    named = F.filter(bullets, lambda x: _label(x) != "")
    last = lambda label: F.element_at(F.filter(named, lambda x: _label(x) == label), -1)
    has = lambda rows, label: F.exists(rows, lambda x: _label(x) == label)

    def put(held: Column) -> Column:
        kept = F.transform(held, lambda x: F.when((_label(x) != "") & has(named, _label(x)), last(_label(x))).otherwise(x))
        fresh = F.filter(F.array_distinct(F.transform(named, _label)), lambda label: ~has(held, label))
        return F.concat(kept, F.transform(fresh, last))

    head = F.regexp_replace(F.substring(body, F.lit(1), at - 1), r"\s+\z", "")
    made = F.concat(
        head, F.lit(f"\n\n{heading}\n\n"), F.array_join(let(held, put), "\n"), F.lit("\n"), F.regexp_replace(tail, r"\A\s+", "")
    )
    return F.when((at == 0) | bullets.isNull(), body).otherwise(made)


def merged_facts(first: Column, second: Column, keys: list[str]) -> Column:
    """The facts of the first map, those of `keys` from the second wherever it has them; null maps are empty."""
    empty = F.create_map().cast("map<string,string>")
    first, second = F.coalesce(first, empty), F.coalesce(second, empty)
    over = F.map_filter(second, lambda k, v: k.isin(*keys) & (F.coalesce(v, F.lit("")) != ""))
    return let(over, lambda o: F.map_concat(F.map_filter(first, lambda k, v: ~F.map_contains_key(o, k)), o))


def first_section(text: Column, patterns: list[str]) -> Column:
    """Group 1 of the first pattern that matches, trimmed; '' if none does."""
    found = [F.when(text.rlike(p), F.regexp_replace(F.regexp_extract(text, p, 1), r"\A\s+|\s+\z", "")) for p in patterns]
    return F.coalesce(*found, F.lit(""))


def is_foundation(level: Column, header_level: Column, body: Column) -> Column:
    """A foundation course by its row's level, by its page's header or by a foundation year in the page."""
    named = lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))) == "foundation"
    return named(level) | named(header_level) | F.coalesce(body.rlike(r"(?i)\bfoundation year\b"), F.lit(False))
