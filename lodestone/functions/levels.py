"""Study levels: classification of URLs by ordered rules, aliases, priorities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.urls import path_of

#: Fixed values.
LEVELS = ("undergraduate", "postgraduate", "postgraduate_research", "foundation", "other")
#: The order in which levels are tried, and in which they win. Fixed values.
PRIORITY = ("foundation", "postgraduate_research", "postgraduate", "undergraduate")
#: The order of work and of samples. Fixed values.
WORK_ORDER = ("foundation", "undergraduate", "postgraduate", "postgraduate_research", "other")
#: Fixed values.
ALIASES = {
    "ug": "undergraduate",
    "under": "undergraduate",
    "undergrad": "undergraduate",
    "undergraduate": "undergraduate",
    "pg": "postgraduate",
    "post": "postgraduate",
    "postgrad": "postgraduate",
    "postgraduate": "postgraduate",
    "pgr": "postgraduate_research",
    "research": "postgraduate_research",
    "postgraduate_research": "postgraduate_research",
    "foundation": "foundation",
    "other": "other",
}
#: Patterns of the default classifier. Fixed values.
FOUNDATION = r"(?i)foundation"
RESEARCH = r"(?i)courses-phd|(?:^|[-_/])(?:phd|mres)(?:[-_/]|$)"
POSTGRADUATE = r"(?i)(?:^|[-_/])(?:msc|mba|llm|pgdip|pgcert|ma)(?:[-_/]|$)"


def classify(url: Column, name: Column | None = None, patterns: dict[str, list[str]] | None = None) -> Column:
    """The level of a course URL. With own patterns the first level in PRIORITY that matches, else `other`."""
    path = path_of(url)
    hay = F.concat_ws("\n", url, path, *([name] if name is not None else []))
    if patterns and any(patterns.values()):
        out = None
        for level in PRIORITY:
            for p in patterns.get(level, ()):
                hit = path.rlike(f"(?i){p}") | hay.rlike(f"(?i){p}")
                out = F.when(hit, level) if out is None else out.when(hit, level)
        return out.otherwise("other")
    return (
        F.when(hay.rlike(FOUNDATION), "foundation")
        .when(path.rlike(RESEARCH) | url.rlike(RESEARCH), "postgraduate_research")
        .when(path.rlike(POSTGRADUATE), "postgraduate")
        .otherwise("undergraduate")
    )


def from_scope(scope: Column) -> Column:
    """The level that a scope names, else ''."""
    key = F.lower(F.regexp_replace(F.trim(scope), "[- ]", "_"))
    return F.when(key.isin(*LEVELS), key).otherwise("")


def parse(raw: Column) -> Column:
    """The level that an alias or scope names, else null."""
    key = F.lower(F.regexp_replace(F.trim(raw), "[- ]", "_"))
    table = F.create_map(*(F.lit(x) for kv in ALIASES.items() for x in kv))
    return F.coalesce(table[key], F.nullif(from_scope(raw), F.lit("")))


def tag(
    url: Column, scope: Column, patterns: dict[str, list[str]] | None = None, scope_decides: bool = False
) -> Column:
    """The level of a scraped URL: the scope where it decides, else own patterns (the scope where they say other),
    else the scope, else the default classifier."""
    of_scope = F.nullif(from_scope(scope), F.lit(""))
    if scope_decides:
        return F.coalesce(of_scope, tag(url, scope, patterns))
    if patterns and any(patterns.values()):
        own = classify(url, patterns=patterns)
        return F.when((own == "other") & of_scope.isNotNull(), of_scope).otherwise(own)
    return F.coalesce(of_scope, classify(url))


def rank(level: Column, order: tuple[str, ...] = PRIORITY) -> Column:
    """Place of a level in an order, from 0; levels outside come last."""
    out = F.lit(len(order))
    for k, name in reversed(list(enumerate(order))):
        out = F.when(level == name, k).otherwise(out)
    return out


def primary(levels: Column) -> Column:
    """Of an array of levels the first in PRIORITY, then other, then the least; '' if empty."""
    out = F.when(F.array_contains(levels, "other"), F.lit("other")).otherwise(
        F.coalesce(F.array_min(F.filter(levels, lambda x: F.trim(x) != "")), F.lit(""))
    )
    for name in reversed(PRIORITY):
        out = F.when(F.array_contains(levels, name), F.lit(name)).otherwise(out)
    return out


def collapse_double_tag(url: Column, levels: Column) -> Column:
    """Levels without foundation where a URL is tagged foundation and undergraduate and its path says undergraduate."""
    both = F.array_contains(levels, "foundation") & F.array_contains(levels, "undergraduate")
    return F.when(both & (classify(url) == "undergraduate"), F.array(F.lit("undergraduate"))).otherwise(levels)


def folder(level: Column) -> Column:
    """The folder of a level; unknown ones go with undergraduate."""
    key = F.lower(F.regexp_replace(F.trim(level), "-", "_"))
    return F.when(key.isin(*LEVELS), key).otherwise("undergraduate")


def bucket(level: Column) -> Column:
    """The three levels that entry and English documents know."""
    key = F.lower(F.regexp_replace(F.trim(level), "-", "_"))
    return (
        F.when(key == "foundation", "foundation")
        .when(key.isin("postgraduate", "postgraduate_research"), "postgraduate")
        .otherwise("undergraduate")
    )


def resume_key(level: Column, slug: Column) -> Column:
    return F.concat_ws("::", folder(level), slug)
