"""Classes of degree, defaults of a level and A-level offers, turned into requirements by tables that are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.numbers import offer_gpa

#: Phrases that name a class of degree, the longer ones first, and single tokens. Fixed values.
CLASS_TOKENS = (
    r"first\s+class(?:\s+honou?rs)?|upper\s+second(?:\s+class(?:\s+honou?rs)?)?|lower\s+second(?:\s+class(?:\s+honou?rs)?)?"
    r"|third\s+class(?:\s+honou?rs)?|good\s+honou?rs(?:\s+degree)?|successful\s+completion|[123](?:st|nd|rd)|2:1|2:2|3:2"
)
#: Ranks of A-level grades, the best first. Fixed value.
GRADES = "ABCDE"


def _plain(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))


def class_phrase(text: Column) -> Column:
    """The first words of a text that name a class of degree, in lower case; '' where there are none."""
    return _plain(F.regexp_extract(_plain(text), rf"\b(?:{CLASS_TOKENS})\b", 0))


def class_requirements(rows: DataFrame, scope: str, text: str, aliases: DataFrame, mapping: DataFrame) -> DataFrame:
    """rows with uk_class, degree, grade and note of the class of degree that a text names, null where it names none.

    aliases: (scope, phrase, uk_class), what a university calls its classes;
    mapping: (scope, uk_class, degree, grade, note). A text that is an alias as
    a whole counts before the first phrase in it. A class that the university
    does not map has no requirement, but is told. Both tables hold one row for
    each of their keys; Spark sends them along while they are small.
    """
    whole, part = F.col("__whole"), F.col("__part")
    named = lambda name: aliases.select(scope, F.lower("phrase").alias(f"__{name}"), F.col("uk_class").alias(f"__{name}_class"))
    found = (
        rows.withColumn("__whole", _plain(F.col(text)))
        .withColumn("__part", class_phrase(F.col(text)))
        .join(named("whole"), [scope, "__whole"], "left")
        .join(named("part"), [scope, "__part"], "left")
    )
    token = F.when(part.rlike("^[123]:[12]$"), part)  # such a token stands for itself
    return (
        found.withColumn("uk_class", F.coalesce("__whole_class", F.when(whole != "", F.coalesce("__part_class", token))))
        .drop("__whole", "__part", "__whole_class", "__part_class")
        .join(mapping.select(scope, "uk_class", "degree", "grade", "note"), [scope, "uk_class"], "left")
    )


def level_defaults(rows: DataFrame, key: str, scope: str, level: str, text: str, rules: DataFrame) -> DataFrame:
    """rows with degree and grade of the first rule of their university and level whose pattern the text matches.

    rules: (scope, level, place, pattern, degree, grade); an empty pattern fits
    any text. Rows that no rule fits have nulls.
    """
    met = rows.select(key, scope, level, F.coalesce(text, F.lit("")).alias("__text")).join(rules, [scope, level])
    met = met.where((F.col("pattern") == "") | F.expr("__text rlike concat('(?i)', pattern)"))
    first = met.groupBy(key).agg(F.min_by(F.struct("degree", "grade"), "place").alias("__first"))
    return rows.join(first, key, "left").select(*rows.columns, "__first.degree", "__first.grade")


def rank_sum(combo: Column) -> Column:
    """How weak an offer is: the sum of its grades' ranks, 0 for each A."""
    return F.aggregate(F.split(combo, ""), F.lit(0), lambda n, x: n + F.instr(F.lit(GRADES), x) - F.when(x == "", 0).otherwise(1))


def offer_of(text: Column) -> Column:
    """Three grades in order, the best first; null where a text is no offer."""
    up = F.upper(F.trim(text))
    return F.when(up.rlike(f"^[{GRADES}]{{3}}$"), F.array_join(F.array_sort(F.split(up, "")), ""))


def weaker(low: Column, high: Column) -> Column:
    """Of two offers the one with the larger rank sum, the first of equal ones; where only one is an offer, that."""
    a, b = offer_of(low), offer_of(high)
    return F.when(a.isNull() | b.isNull(), F.coalesce(a, b)).when(rank_sum(a) >= rank_sum(b), a).otherwise(b)


def offer_label(text: Column) -> Column:
    """`AAB-ABB` or `ABB` of the first offer marked (A-level) in a text, a range before a single one; ''."""
    span = r"(?i)\b([A-D]{3})\s*[-–]\s*([A-D]{3})\s*\(A-level\)"
    single = F.regexp_extract(text, r"(?i)\b([A-D]{3})\s*\(A-level\)", 1)
    both = F.concat(F.regexp_extract(text, span, 1), F.lit("-"), F.regexp_extract(text, span, 2))
    return F.upper(F.when(text.rlike(span), both).otherwise(F.coalesce(single, F.lit(""))))


def offer_points(rows: DataFrame, scope: str, label: str, bands: DataFrame, standard: DataFrame) -> DataFrame:
    """rows with offer (what counts of the label), points (text) and by (band, standard or scale), null where nothing fits.

    bands: (scope, label, points) for labels as they stand, ranges too;
    standard: (scope, offer, points). A range without a band counts as its
    weaker end, on the university's standard, else on the common scale.
    """
    up = F.upper(F.trim(F.coalesce(label, F.lit(""))))
    ends = F.split(F.col("__label"), "-")
    both = weaker(F.get(ends, 0), F.get(ends, 1))
    known = offer_gpa(F.col("__offer"))
    scale = F.when(known.isNotNull(), F.regexp_replace(F.format_string("%.2f", known), r"\.?0+$", ""))
    found = (
        rows.withColumn("__label", up)
        .withColumn("__offer", F.when(F.contains(F.col("__label"), F.lit("-")), both).otherwise(offer_of(F.col("__label"))))
        .join(bands.select(scope, F.upper("label").alias("__label"), F.col("points").alias("__band")), [scope, "__label"], "left")
        .join(standard.select(scope, F.upper("offer").alias("__offer"), F.col("points").alias("__standard")), [scope, "__offer"], "left")
    )
    by = F.when(F.col("__band").isNotNull(), "band").when(F.col("__standard").isNotNull(), "standard").when(scale.isNotNull(), "scale")
    return found.select(
        *rows.columns, F.col("__offer").alias("offer"), F.coalesce("__band", "__standard", scale).alias("points"), by.alias("by")
    )
