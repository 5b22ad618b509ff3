"""Normalised records to the 30 columns of the course table, and flat audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import nested, urls
from lodestone.functions.text import degree_of_name

#: Fixed values.
COLUMNS = (
    "uniName", "programmeName", "courseName", "minDegreeName", "minGpa", "higherDegreeName", "higherGpa",
    "AcademicRequirementsMetaData", "intakeInfo", "courseDuration", "tuitionFee", "currency", "initialDeposit",
    "applicationFee", "feesMetaData", "commission", "applicationDeadline", "ieltsMinOverall", "ieltsMinSection",
    "toeflMinOverall", "toeflMinSection", "pteMinOverall", "pteMinSection", "scholarshipName", "scholarshipAmount",
    "scholarshipType", "scholarshipMetaData", "degreeName", "courseUrlExternal", "studyLevel",
)


def cell(value: Column, kind: str) -> Column:
    """A CSV cell: '' for null, nested values as JSON text."""
    nested_kind = kind.startswith(("array", "struct", "map"))
    return F.coalesce(F.to_json(value) if nested_kind else value.cast("string"), F.lit(""))


def course_rows(records: DataFrame, uni: Column, base_url: Column, level: Column, portal: Column | None = None, degree: Column | None = None) -> DataFrame:
    """The 30 columns of each normalised record.

    portal: struct (programmeName, degreeName) of tiered lookup, null for no
    hit: its programme always replaces the record's, '' included; its degree
    fills a blank only. degree: a dictionary's degree, the last resort.
    """
    kinds = dict(records.dtypes)
    own = F.coalesce(F.nullif(F.trim(F.col("degreeName")), F.lit("")), F.nullif(degree_of_name(F.col("courseName")), F.lit("")))
    if portal is not None:
        own = F.coalesce(own, F.nullif(portal["degreeName"], F.lit("")))
    if degree is not None:
        own = F.coalesce(own, F.nullif(degree, F.lit("")))
    put = {
        "uniName": uni,
        "programmeName": F.coalesce(portal["programmeName"], F.lit("")) if portal is not None else F.lit(""),
        "commission": F.lit(""),
        "degreeName": F.coalesce(own, F.lit("")),
        "courseUrlExternal": urls.rebase(F.col("courseUrl"), base_url),
        "studyLevel": F.trim(level),
    }
    return records.select(
        *(F.coalesce(put[c], F.lit("")).alias(c) if c in put else cell(F.col(c), kinds[c]).alias(c) for c in COLUMNS)
    )


def audit_rows(reviewed: DataFrame, parts: dict[str, tuple[DataFrame, list[str]]], key: str) -> DataFrame:
    """Reviewed rows with one column a (part, path) of JSON documents (columns key, json), '' where there is none.

    The columns are named part.path; a generated select, not a fixed list.
    """
    out = reviewed
    for name, (table, paths) in parts.items():
        read = table.select(F.col(key), *(nested.by_path(F.col("json"), p).alias(f"{name}.{p}") for p in paths))
        out = out.join(read, key, "left").withColumns(
            {f"{name}.{p}": F.coalesce(F.col(f"`{name}.{p}`"), F.lit("")) for p in paths}
        )
    return out


def matching(reviewed: DataFrame, all_empty: list[str] = (), any_empty: list[str] = ()) -> DataFrame:
    """Rows where all of some fields are empty and, if given, any of others."""
    from lodestone.functions.text import any_of, is_empty

    out = reviewed
    for c in all_empty:
        out = out.where(is_empty(F.col(c)))
    return out.where(any_of([is_empty(F.col(c)) for c in any_empty])) if any_empty else out


def merge_stages(parsed: DataFrame, model: DataFrame, key: str, fill_only: list[str], override: list[str]) -> DataFrame:
    """Parsed and model fields by key: `override` fields come from the model unless blank, `fill_only` ones only where
    the parsed field is blank."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    m = model.select(key, *(F.col(c).alias(f"__{c}") for c in [*fill_only, *override]))
    out = parsed.join(m, key, "left")
    return out.withColumns(
        {c: F.coalesce(blank(F.col(f"__{c}")), blank(F.col(c)), F.lit("")) for c in override}
        | {c: F.coalesce(blank(F.col(c)), blank(F.col(f"__{c}")), F.lit("")) for c in fill_only}
    ).drop(*(f"__{c}" for c in [*fill_only, *override]))


def combine_parts(parts: list[DataFrame], key: str, lists: list[str]) -> DataFrame:
    """Parts of a record joined by key; the arrays named in `lists` are put one after the other."""
    out = None
    for k, part in enumerate(parts):
        own = part.withColumnsRenamed({c: f"{c}__{k}" for c in lists if c in part.columns})
        out = own if out is None else out.join(own, key, "full")
    for c in lists:
        cols = [x for x in out.columns if x.startswith(f"{c}__")]
        kind = dict(out.dtypes)[cols[0]]
        out = out.withColumn(c, F.concat(*(F.coalesce(F.col(x), F.array().cast(kind)) for x in cols))).drop(*cols)
    return out
