"""Grades, money and scores as Column expressions."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.text import any_of, let

#: Percent to grade point, school certificates. Fixed values.
SCHOOL_SCALE = {80: 5.0, 70: 4.0, 60: 3.5, 50: 3.0, 40: 2.0, 33: 1.0}
#: Percent to grade point, degrees. Fixed values.
DEGREE_SCALE = {80: 4.0, 75: 3.75, 70: 3.5, 65: 3.25, 60: 3.0, 55: 2.75, 50: 2.5, 45: 2.25, 40: 2.0}
#: Tariff points of one subject. Fixed values.
TARIFF = {"A*": 56, "A": 48, "B": 40, "C": 32, "D": 24, "E": 16}
#: Three-subject offers to school grade points. Fixed values.
OFFER_POINTS = {
    "AAA": 5.0, "AAB": 5.0, "ABB": 5.0, "BBB": 4.0, "BBC": 4.0, "BCC": 3.5, "CCC": 3.5, "CCD": 3.5, "CDD": 3.5, "DDD": 2.0,
}
#: Words of degree classes to grade points. Fixed values.
CLASS_POINTS = (
    ("FIRST CLASS", 4.0), ("UPPER SECOND", 3.0), ("2:1", 3.0), ("LOWER SECOND", 2.5), ("2:2", 2.5), ("THIRD CLASS", 2.0),
)
#: Words dropped before a grade is read. Fixed values.
FILLERS = ("MINIMUM", "AT LEAST", "OVERALL", "OR ABOVE", "EQUIVALENT", "NORMALLY")
#: Text that says there is no international fee yet. Fixed values.
NO_FEE = (
    r"(?i)international students\s*\(\d{4}/\d{2}\)\s*:\s*\[",
    r"(?i)find out more about the international student fee",
    r"(?i)fee not available",
    r"(?i)fees.{0,40}not confirmed",
    r"(?i)available to uk students only",
)
#: Lines about placements and deposits. Fixed values.
NOT_TUITION = r"(?i)placement\s+year|during\s+placement|\bdeposit\b|pay\s+a\s+deposit"
#: Ordered patterns of explicit fees. Fixed values.
EXPLICIT_FEE = (
    r"(?i)International tuition fee:\s*£([\d,]+)",
    r"(?i)(?:international|tuition fee)[^.\n]{0,40}£([\d,]+)",
    r"(?i)International students starting[^£\n]{0,40}£([\d,]+)",
    r"(?i)\*\*£([\d,]+)\*\*\s*International students",
)


def band(value: Column, scale: dict[float, float], default: float = 0.0) -> Column:
    """The value of the largest threshold that is not above: a banded lookup as one CASE."""
    out = F.lit(default)
    for threshold in sorted(scale):
        out = F.when(value >= threshold, scale[threshold]).otherwise(out)
    return F.when(value.isNull(), None).otherwise(out)


def offer_of_points(subjects: int = 3) -> dict[int, str]:
    """For each sum of tariff points the last of the offers that make it, in the order of their letters."""
    found: dict[int, list[str]] = {}
    for combo in combinations_with_replacement(TARIFF, subjects):
        found.setdefault(sum(TARIFF[g] for g in combo), []).append("".join(combo))
    return {points: max(offers) for points, offers in found.items()}


def tariff_points(text: Column) -> Column:
    return F.regexp_extract(text, r"(?i)(\d{2,3})\s*UCAS\s+Tariff\s+points", 1).try_cast("int")


def offer(text: Column) -> Column:
    """The first word of three letters A to D of upper-cased text; '' if none."""
    return F.regexp_extract(F.upper(text), r"\b([A-D]{3})\b", 1)


def points_to_offer(points: Column) -> Column:
    table = offer_of_points()
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[points]


def offer_gpa(combo: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in OFFER_POINTS.items() for x in kv))[F.upper(F.trim(combo))]


def number_text(x: Column) -> Column:
    """A number without closing zeros; whole ones with .0, as grade points print."""

    def put(v: Column) -> Column:
        short = F.regexp_replace(F.regexp_replace(F.format_string("%.2f", v), "0+$", ""), r"\.$", "")
        return F.when(v.isNull(), None).when(v % 1 == 0, F.format_string("%.1f", v)).otherwise(short)

    return let(x, put)


def school_gpa_text(text: Column) -> Column:
    """'GPA 3.5' for the offer or tariff points that a text names; '' if it names none on the scale."""
    combo = F.coalesce(F.nullif(offer(text), F.lit("")), points_to_offer(tariff_points(text)))
    gpa = offer_gpa(combo)
    short = F.regexp_replace(number_text(gpa), r"\.0$", "")
    return F.coalesce(F.concat(F.lit("GPA "), short), F.lit(""))


def gpa(text: Column, degree: Column, scale: dict[float, float] | None = None) -> Column:
    """Grade points of a grade text, null if it names none.

    A stated GPA wins. Else the least of: an offer on the scale, else tariff
    points; and a class of degree. A bare percentage counts only where none of
    these is, on the school scale (or `scale`) for school certificates and
    diplomas, else on the degree scale.
    """
    up = F.upper(F.trim(text))
    for filler in FILLERS:
        up = F.replace(up, F.lit(filler), F.lit(""))
    return let(up, lambda u: _gpa_of(u, degree, scale))


def _gpa_of(up: Column, degree: Column, scale: dict[float, float] | None) -> Column:
    # a plain search tells cheaply where an expression cannot match
    has = lambda *marks: any_of([F.contains(up, F.lit(m)) for m in marks])
    stated = F.when(
        has("GPA"), F.round(F.regexp_extract(up, r"(?:GPA|CGPA)\s*[:\-]?\s*([\d.]+)", 1).try_cast("double"), 2)
    )
    exact = F.nullif(F.regexp_extract(up, rf"\b({'|'.join(OFFER_POINTS)})\b", 1), F.lit(""))
    words = [w for w, _ in CLASS_POINTS]
    word = F.when(has(*words), F.regexp_extract(up, "|".join(words), 0)).otherwise("")
    percent = F.when(has("%"), F.regexp_extract(up, r"([\d.]+)\s*%", 1).try_cast("double"))
    points = F.when(has("UCAS"), tariff_points(up))

    def least(v: Column) -> Column:
        of_points = F.when(
            v["exact"].isNull() & v["points"].isNotNull(),
            offer_gpa(F.coalesce(F.nullif(offer(up), F.lit("")), points_to_offer(v["points"]))),
        )
        of_class = None
        for w, points in CLASS_POINTS:
            of_class = F.when(v["word"] == w, points) if of_class is None else of_class.when(v["word"] == w, points)
        of_percent = F.when(
            v["exact"].isNull() & (v["word"] == ""),
            F.when(degree.isin("HSC", "Diploma"), band(v["percent"], scale or SCHOOL_SCALE)).otherwise(
                band(v["percent"], DEGREE_SCALE)
            ),
        )
        return F.array_min(F.array_compact(F.array(offer_gpa(v["exact"]), of_points, of_class, of_percent)))

    parts = F.struct(
        exact.alias("exact"), points.alias("points"), word.alias("word"), percent.alias("percent")
    )
    return F.coalesce(stated, let(parts, least))


def money(raw: Column) -> Column:
    """The first number of a text, without thousands marks; '' if none."""
    return F.coalesce(F.replace(F.regexp_extract(raw.cast("string"), r"[\d,]+(?:\.\d+)?", 0), F.lit(","), F.lit("")), F.lit(""))


def fee_number(value: Column) -> Column:
    """All digits of a text as a number with at most two places; '' if none."""
    digits = F.regexp_replace(value, r"[^\d.]", "")
    number = digits.try_cast("double")
    text = F.when(
        number.isNotNull(), F.regexp_replace(F.regexp_replace(F.format_string("%.2f", number), "0+$", ""), r"\.$", "")
    )
    return F.coalesce(F.when(digits == "", "").otherwise(F.coalesce(text, digits)), F.lit(""))


def pounds(amount: Column) -> Column:
    digits = F.regexp_replace(amount, r"[^\d]", "").try_cast("bigint")
    return F.coalesce(F.concat(F.lit("£"), F.format_number(digits, 0)), F.lit(""))


def stated_deposit(text: Column) -> Column:
    """The first deposit that a text states, as £1,234; '' if none."""
    p = r"(?i)(?:deposit(?:\s+of)?|pay\s+a)\s+£([\d,]+)|£([\d,]+)\s+deposit"
    return pounds(F.coalesce(F.nullif(F.regexp_extract(text, p, 1), F.lit("")), F.regexp_extract(text, p, 2)))


def amount_in(amount: Column, text: Column) -> Column:
    """The amount stands in the text as it is or with thousands marks."""
    a = F.coalesce(F.trim(amount), F.lit(""))
    commas = F.when(a.rlike(r"^\d+$"), F.format_number(a.try_cast("bigint"), 0))
    t = F.coalesce(text, F.lit(""))
    return (a != "") & (F.contains(t, a) | F.coalesce(F.contains(t, commas), F.lit(False)))


def fee_in_text(text: Column, explicit_only: Column | None = None) -> Column:
    """The fee that a text states by an explicit pattern, else its largest £ amount off placement and deposit lines; '' if none."""
    stated = [F.nullif(money(F.regexp_extract(text, p, 1)), F.lit("")) for p in EXPLICIT_FEE]
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: ~x.rlike(NOT_TUITION))
    amounts = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(r"£([\d,]+)"), F.lit(1))))
    best = F.array_max(F.transform(amounts, lambda a: F.replace(a, F.lit(","), F.lit("")).try_cast("bigint"))).cast("string")
    if explicit_only is not None:
        best = F.when(explicit_only, None).otherwise(best)
    return F.coalesce(*stated, best, F.lit(""))


def no_international_fee(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.transform(F.split(t, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    lone = (F.size(lines) == 1) & F.coalesce(
        F.get(lines, 0).rlike(r"(?i)^International students\s*\(\d{4}/\d{2}\)$"), F.lit(False)
    )
    return any_of([t.rlike(p) for p in NO_FEE]) | lone


def example_amounts(text: Column) -> Column:
    """Text that repeats the amounts or the host of a prompt's example."""
    t = F.coalesce(text, F.lit(""))
    return t.rlike(r"(?i)\bAUD\s*42,?500\b") | t.rlike(r"\b18,?570\b") | F.contains(F.lower(t), F.lit("example.com"))


def sane_fee(fee: Column, currency: Column, meta: Column, source: Column, listed: Column) -> Column:
    """Struct (fee, currency): a fee that nothing supports is dropped, and what the metadata states is put in its place."""
    f, c = F.coalesce(F.trim(fee), F.lit("")), F.upper(F.coalesce(F.trim(currency), F.lit("")))
    based = listed | amount_in(f, source) | amount_in(f, meta)
    example = ((f == "42500") & (c == "AUD")) | ((f == "18570") & (c == "GBP"))
    near = F.coalesce(meta, F.lit("")).rlike(r"(?i)(?:international|tuition fee)[^.\n]{0,40}£[\d,]+")
    drop = ~based & (
        example
        | (c == "AUD")
        | no_international_fee(meta)
        | (example_amounts(meta) & (f != "") & ~near)
        | ((f != "") & (fee_in_text(F.coalesce(meta, F.lit(""))) != ""))
    )
    again = F.when(no_international_fee(meta), "").otherwise(
        fee_in_text(F.coalesce(meta, F.lit("")), explicit_only=example_amounts(meta))
    )
    none = (f == "") & (c == "")
    return F.when(none | ~drop, F.struct(fee.alias("fee"), currency.alias("currency"))).otherwise(
        F.struct(again.alias("fee"), F.when(again != "", "GBP").otherwise("").alias("currency"))
    )


def is_decimal(raw: Column) -> Column:
    """Blank, or a finite number, thousands marks allowed."""
    t = F.replace(F.coalesce(F.trim(raw), F.lit("")), F.lit(","), F.lit(""))
    x = t.try_cast("double")
    return (F.trim(F.coalesce(raw, F.lit(""))) == "") | F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def pages_of(total: Column, size: Column) -> Column:
    return F.floor((total + size - 1) / size).cast("int")


def test_scores(text: Column) -> dict[str, Column]:
    """Overall and section minima of IELTS, TOEFL and PTE in a text; '' where it has none."""
    section = {
        "ielts": r"[^0-9]*(?:with\s+)?(?:no\s+(?:less\s+than|element|individual)\s+|no.*?below|min(?:imum)?\s+(?:of\s+)?|at\s+least\s+)",
        "toefl": r"[^0-9]*(?:with\s+)?(?:a\s+)?(?:minimum\s+of\s+|min(?:imum)?\s+)",
        "pte": r"[^0-9]*(?:with\s+)?(?:a\s+)?(?:minimum\s+(?:score\s+)?of\s+|min(?:imum)?\s+)",
    }
    out = {}
    for test, middle in section.items():
        head = rf"(?i){test.upper()}[^0-9]*(\d+\.?\d*)"
        both = rf"{head}{middle}[^0-9]*(\d+\.?\d*)"
        has = F.regexp_extract(text, both, 1) != ""
        out[f"{test}MinOverall"] = F.coalesce(
            F.when(has, F.regexp_extract(text, both, 1)).otherwise(F.regexp_extract(text, head, 1)), F.lit("")
        )
        out[f"{test}MinSection"] = F.coalesce(F.regexp_extract(text, both, 2), F.lit(""))
    return out


def scholarship_amount(amount: Column, description: Column) -> Column:
    """The largest £ of the amount, else a stated total or value, else the largest £ of the description, else -1."""
    top = lambda c: F.array_max(
        F.transform(
            F.regexp_extract_all(c, F.lit(r"£([\d,]+(?:\.\d+)?)"), F.lit(1)),
            lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"),
        )
    )
    one = lambda p: F.replace(F.regexp_extract(description, p, 1), F.lit(","), F.lit("")).try_cast("double")
    return F.coalesce(
        top(F.coalesce(amount, F.lit(""))),
        one(r"(?i)£([\d,]+(?:\.\d+)?)\s+total\b"),
        one(r"(?i)(?:scholarship value|value)\s*:\s*£([\d,]+(?:\.\d+)?)"),
        top(F.coalesce(description, F.lit(""))),
        F.lit(-1.0),
    )
