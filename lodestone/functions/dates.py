"""Intakes, deadlines and durations as Column expressions. The day of reference is always a parameter."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)
_NAMES = "|".join(MONTHS)
_TOKEN = rf"(?i)^(?:(\d{{1,2}})(?:st|nd|rd|th)?\s+)?({_NAMES})(?:\s+((?:19|20)\d{{2}}))?$"


def month_number(name: Column) -> Column:
    out = None
    for k, m in enumerate(MONTHS, 1):
        out = F.when(F.lower(name) == m, k) if out is None else out.when(F.lower(name) == m, k)
    return out


def _title(name: Column) -> Column:
    return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substring(name, 2, 20)))


def date_token(token: Column, reference: datetime.date) -> Column:
    """'[day] Month [year]' with the year filled in: this year, or the next where the date has passed. Others stay."""
    t = F.coalesce(F.trim(token), F.lit(""))
    day = F.regexp_extract(t, _TOKEN, 1)
    name = F.regexp_extract(t, _TOKEN, 2)
    year = F.regexp_extract(t, _TOKEN, 3)
    month = month_number(name)
    dated = F.try_to_date(
        F.concat(F.lit(str(reference.year)), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(day, 2, "0")),
        "yyyy-MM-dd",
    )
    guess = (
        F.when(year != "", year)
        .when((day != "") & (dated < F.lit(reference)), str(reference.year + 1))
        .when((day == "") & (month < reference.month), str(reference.year + 1))
        .otherwise(str(reference.year))
    )
    put = F.concat_ws(" ", F.when(day != "", day.try_cast("int").cast("string")), _title(name), guess)
    return F.when(name == "", t).when((day != "") & (year == "") & dated.isNull(), t).otherwise(put)


def date_list(value: Column, reference: datetime.date) -> Column:
    """A comma list of date tokens, each with its year."""
    tokens = F.filter(F.transform(F.split(value, r",\s*"), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(
        F.array_join(F.filter(F.transform(tokens, lambda x: date_token(x, reference)), lambda x: x != ""), ", "), F.lit("")
    )


def months_of(raw: Column) -> Column:
    """Months of a duration, years first, fractions cut; '' if there is no number."""
    t = F.lower(raw)
    years = F.regexp_extract(t, r"([\d.]+)\s*year", 1).try_cast("double")
    months = F.regexp_extract(t, r"([\d.]+)\s*month", 1).try_cast("double")
    bare = F.regexp_extract(t, r"^\s*([\d.]+)\s*$", 1).try_cast("double")
    return F.coalesce(F.coalesce((years * 12).cast("int"), months.cast("int"), bare.cast("int")).cast("string"), F.lit(""))


def whole_months(raw: Column) -> Column:
    """Months of a duration, months first, whole numbers only; '' if there is none."""
    t = F.trim(raw)
    months = F.nullif(F.regexp_extract(t, r"(?i)(\d+)\s*months?\b", 1), F.lit(""))
    years = (F.regexp_extract(t, r"(?i)(\d+)\s*years?\b", 1).try_cast("int") * 12).cast("string")
    return F.coalesce(months, years, F.when(t.rlike(r"^\d+$"), t), F.lit(""))


def short_month(text: Column) -> Column:
    """'Sep 2027' as 'September 2027'; others trimmed."""
    t = F.coalesce(F.trim(text), F.lit(""))
    word, year = F.regexp_extract(t, r"^([A-Za-z]{3,})\s+(\d{4})$", 1), F.regexp_extract(t, r"^([A-Za-z]{3,})\s+(\d{4})$", 2)
    out = None
    for m in MONTHS:
        hit = F.lower(F.substring(word, 1, 3)) == m[:3]
        put = F.concat(F.lit(m.title() + " "), year)
        out = F.when(hit, put) if out is None else out.when(hit, put)
    return F.when(word == "", t).otherwise(out.otherwise(t))


def intake_text(text: Column) -> Column:
    """An intake line: of a comma list the parts with a year or month, else all 'Month YYYY' in it, else a short month spelt out."""
    t = F.coalesce(F.trim(text), F.lit(""))
    parts = F.filter(F.transform(F.split(t, ","), lambda x: F.trim(x)), lambda x: x != "")
    dated = F.filter(parts, lambda x: x.rlike(r"\b(19|20)\d{2}\b") | x.rlike(rf"(?i)\b({_NAMES})\b"))
    p = rf"(?i)\b({_NAMES})\s+((?:19|20)\d{{2}})\b"
    pairs = F.zip_with(
        F.regexp_extract_all(t, F.lit(p), F.lit(1)),
        F.regexp_extract_all(t, F.lit(p), F.lit(2)),
        lambda m, y: F.concat(_title(m), F.lit(" "), y),
    )
    listed = F.when(F.size(dated) > 0, F.array_join(dated, ", ")).otherwise(t)
    return F.when(F.contains(t, F.lit(",")), listed).when(F.size(pairs) > 0, F.array_join(pairs, ", ")).otherwise(short_month(t))


def intake_tokens(raw: Column) -> Column:
    """'Sep-26' and 'Sep 2026' as 'sep 2026': the tokens of a comma list that can be read."""
    parts = F.transform(F.split(raw, ","), lambda x: F.trim(x))
    p = r"^([A-Za-z]{3,9})[-\s](\d{2}|\d{4})$"
    known = [*MONTHS, *(m[:3] for m in MONTHS), "sept"]

    def one(x: Column) -> Column:
        word, year = F.lower(F.regexp_extract(x, p, 1)), F.regexp_extract(x, p, 2)
        full = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
        return F.when(word.isin(*known), F.concat_ws(" ", F.substring(word, 1, 3), full))

    return F.coalesce(F.array_compact(F.transform(parts, one)), F.array().cast("array<string>"))


def sort_intakes(values: Column) -> Column:
    """'Month YYYY' texts by time, those that cannot be read last, in their order."""
    p = rf"(?i)^({_NAMES})\s+(\d{{4}})$"

    def key(x: Column, k: Column) -> Column:
        year = F.regexp_extract(F.trim(x), p, 2).try_cast("int")
        month = month_number(F.regexp_extract(F.trim(x), p, 1))
        return F.struct(F.coalesce(year, F.lit(9999)).alias("y"), F.coalesce(month, F.lit(99)).alias("m"), k.alias("k"), x.alias("x"))

    return F.transform(F.array_sort(F.transform(values, key)), lambda s: s["x"])
