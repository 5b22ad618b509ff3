"""The record normaliser: one raw record a row to the 26 fields of the production schema, in two selects."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import dates, nested, numbers

#: Schema of a raw record. Nested fields of unsure shape come as JSON text. Fixed values.
RAW = (
    "courseName string, courseUrl string, degreeName string, requirements array<struct<degree:string,grade:string>>,"
    "academicRequirementsMetaData string, intakeInfo string, courseDuration string,"
    "tuitionFeeCandidates array<struct<label:string,amount:string>>, tuitionFee string, currency string,"
    "initialDeposit string, applicationFee string, feesMetaData string, applicationDeadline string,"
    "englishRequirementText array<string>, ieltsMinOverall string, ieltsMinSection string, toeflMinOverall string,"
    "toeflMinSection string, pteMinOverall string, pteMinSection string,"
    "scholarships array<struct<name:string,amount:string,type:string,details:array<string>>>,"
    "scholarshipName string, scholarshipAmount string, scholarshipType string, scholarshipMetaData string"
)
SCORES = (
    "ieltsMinOverall", "ieltsMinSection", "toeflMinOverall", "toeflMinSection", "pteMinOverall", "pteMinSection",
)
#: Fixed values.
FIELDS = (
    "courseName", "courseUrl", "degreeName", "minDegreeName", "minGpa", "higherDegreeName", "higherGpa",
    "AcademicRequirementsMetaData", "intakeInfo", "courseDuration", "tuitionFee", "currency", "initialDeposit",
    "applicationFee", "feesMetaData", "applicationDeadline", *SCORES, "scholarshipName", "scholarshipAmount",
    "scholarshipType", "scholarshipMetaData",
)


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _best_gpa(ranked: Column, chosen: Column) -> Column:
    """The highest grade point among rows of the chosen row's degree, as text."""
    same = F.filter(ranked, lambda r: r["degree"] == chosen["degree"])
    return F.coalesce(
        numbers.number_text(F.array_max(F.transform(same, lambda r: numbers.gpa(r["grade"], r["degree"])))), F.lit("")
    )


def normalize(raw: DataFrame, reference: datetime.date, keep: list[str] = ()) -> DataFrame:
    """The 26 fields of each raw record, texts never null, after the columns of `keep`.

    `reference` is the day that dates without a year are held against.
    Explicit international fee candidates win over the scalar fee, stated test
    scores over those in text, a list of scholarships over scalar ones.
    """
    listed = F.filter(
        "tuitionFeeCandidates", lambda c: F.upper(F.coalesce(c["label"], F.lit(""))).rlike("INTERNATIONAL|OVERSEAS|NON-UK")
    )
    amounts = F.transform(listed, lambda c: numbers.money(c["amount"]).try_cast("double"))
    top = F.array_max(amounts)
    whole = F.when(top % 1 == 0, top.cast("bigint").cast("string")).otherwise(top.cast("string"))
    english = F.array_join(
        F.concat(
            F.coalesce("englishRequirementText", F.array().cast("array<string>")),
            F.flatten(
                F.transform(
                    F.filter("__academic", lambda b: F.contains(F.lower(b["subtitle"]), F.lit("english"))),
                    lambda b: b["description"],
                )
            ),
        ),
        " ",
    )
    best = F.element_at(
        F.array_sort(
            F.transform(
                "scholarships",
                lambda s, k: F.struct(
                    F.coalesce(numbers.money(s["amount"]).try_cast("double"), F.lit(-1.0)).alias("value"),
                    (-k).alias("place"),
                    s.alias("s"),
                ),
            ),
            lambda a, b: F.when(a["value"] != b["value"], F.signum(a["value"] - b["value"])).otherwise(
                F.signum((a["place"] - b["place"]).cast("double"))
            ).cast("int"),
        ),
        -1,
    )["s"]
    told = F.flatten(
        F.transform(
            "scholarships",
            lambda s: F.filter(
                F.concat(F.array(s["name"]), F.coalesce(s["details"], F.array().cast("array<string>"))),
                lambda x: F.coalesce(x, F.lit("")) != "",
            ),
        )
    )
    has = F.coalesce(F.size("scholarships"), F.lit(0)) > 0
    parts = raw.withColumns(
        {
            "__academic": nested.metadata(F.col("academicRequirementsMetaData")),
            "__fees": nested.metadata(F.col("feesMetaData")),
            "__ranked": nested.ranked_requirements(F.col("requirements")),
            "__listed": F.coalesce(whole, F.lit("")),
        }
    )
    least, higher = nested.least_and_higher(F.col("__ranked"))
    fee = F.when(F.col("__listed") != "", F.col("__listed")).otherwise(numbers.money(F.col("tuitionFee")))
    parts = parts.withColumns(
        {
            "__least": least,
            "__higher": higher,
            "__english": english,
            "__best": best,
            "__told": told,
            "__sane": numbers.sane_fee(
                fee, _text("currency"), nested.meta_text(F.col("__fees")), F.lit(""), F.col("__listed") != ""
            ),
        }
    )
    scores = numbers.test_scores(F.col("__english"))
    spread = F.when(F.size("__told") > 0, F.array(F.struct(F.lit("Scholarships").alias("subtitle"), F.col("__told").alias("description"))))
    pick = lambda field, scalar: F.when(has, F.coalesce(F.col("__best")[field], F.lit(""))).otherwise(scalar)
    return parts.select(
        *keep,
        _text("courseName").alias("courseName"),
        _text("courseUrl").alias("courseUrl"),
        F.trim(_text("degreeName")).alias("degreeName"),
        F.coalesce(F.col("__least")["degree"], F.lit("")).alias("minDegreeName"),
        _best_gpa(F.col("__ranked"), F.col("__least")).alias("minGpa"),
        F.coalesce(F.col("__higher")["degree"], F.lit("")).alias("higherDegreeName"),
        _best_gpa(F.col("__ranked"), F.col("__higher")).alias("higherGpa"),
        F.col("__academic").alias("AcademicRequirementsMetaData"),
        dates.date_list(F.col("intakeInfo"), reference).alias("intakeInfo"),
        dates.months_of(F.col("courseDuration")).alias("courseDuration"),
        F.col("__sane")["fee"].alias("tuitionFee"),
        F.col("__sane")["currency"].alias("currency"),
        numbers.money(F.col("initialDeposit")).alias("initialDeposit"),
        numbers.money(F.col("applicationFee")).alias("applicationFee"),
        F.col("__fees").alias("feesMetaData"),
        dates.date_list(F.col("applicationDeadline"), reference).alias("applicationDeadline"),
        *(
            F.coalesce(F.nullif(F.trim(F.col(k)), F.lit("")), scores[k]).alias(k)
            for k in SCORES
        ),
        pick("name", _text("scholarshipName")).alias("scholarshipName"),
        F.when(has, numbers.money(F.col("__best")["amount"])).otherwise(numbers.money(F.col("scholarshipAmount"))).alias("scholarshipAmount"),
        pick("type", _text("scholarshipType")).alias("scholarshipType"),
        F.when(has, F.coalesce(spread, F.array().cast(nested.META)))
        .otherwise(nested.metadata(F.col("scholarshipMetaData")))
        .alias("scholarshipMetaData"),
    )
