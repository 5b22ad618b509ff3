"""Requirement payloads of any shape, walked as variants inside the row to a bounded depth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.nested import REQUIREMENTS
from lodestone.functions.text import requirement_degree, requirement_grade
from lodestone.functions.tree import bind

#: Fields that hold further entries, and those whose texts tell of an entry, in order. Fixed values.
LISTS = ("degrees", "requirements", "entryrequirements", "entry_requirements")
TEXTS = ("degree", "qualification", "grade", "description", "requirement", "requirements", "entryrequirements", "entry_requirements")


def _said(v: Column) -> Column:
    """A value as text: a list's items joined, anything else as it prints; '' for null."""
    kind = F.schema_of_variant(v)
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.trim(F.coalesce(x.cast("string"), F.lit(""))))
    joined = F.array_join(F.filter(items, lambda x: x != ""), " ")
    return F.coalesce(F.when(F.startswith(kind, F.lit("ARRAY")), joined).otherwise(F.trim(v.cast("string"))), F.lit(""))


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit(kind)), F.lit(False))


def payload_requirements(payload: Column, read: Callable[[Column], Column], depth: int = 4) -> Column:
    """Array of (degree, grade) of a JSON payload in the order of its entries, each pair once.

    A payload is a text, an entry {degree, grade, …}, or lists of these, nested
    up to `depth`, where the rest is read as text. Keys count without regard to
    case. An entry with a list of further entries counts as these, or as itself
    where they tell nothing. A text, and an entry without both a degree and a
    grade, is read by `read`, from a text to an array of (degree, grade).
    Payloads that are no JSON are texts; null and empty ones, and pairs with a
    blank side, give nothing.
    """
    none = F.array().cast(REQUIREMENTS)

    def field(entry: Column, name: str) -> Column:
        return F.get(F.filter(F.map_entries(entry), lambda e: F.lower(F.trim(e["key"])) == name), 0)["value"]

    def own(entry: Column) -> Column:
        degree = requirement_degree(_said(field(entry, "degree")))
        grade = bind(F.coalesce(F.nullif(_said(field(entry, "grade")), F.lit("")), _said(field(entry, "grades"))), requirement_grade)
        texts = F.array_join(F.filter(F.array(*(_said(field(entry, n)) for n in TEXTS)), lambda x: x != ""), " ")
        return bind(
            F.struct(degree.alias("degree"), grade.alias("grade")),
            lambda x: F.when((x["degree"] != "") & (x["grade"] != ""), F.array(x).cast(REQUIREMENTS)).otherwise(bind(texts, read)),
        )

    def walk(v: Column, left: int) -> Column:
        text = bind(_said(v), lambda s: F.when(s == "", none).otherwise(read(s)))
        if not left:
            return text
        entry = F.when(_is(v, "OBJECT"), F.try_variant_get(v, "$", "map<string,variant>"))

        def of(entry: Column) -> Column:
            lists = [F.when(_is(field(entry, n), "ARRAY"), F.try_variant_get(field(entry, n), "$", "array<variant>")) for n in LISTS]
            items = F.when(_is(v, "ARRAY"), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.coalesce(*lists))
            inner = F.coalesce(F.flatten(F.transform(items, lambda x: walk(x, left - 1))), none)
            return bind(
                inner,
                lambda rows: F.when(_is(v, "ARRAY") | (F.size(rows) > 0), rows).when(entry.isNotNull(), own(entry)).otherwise(text),
            )

        return bind(entry, of)

    whole = F.coalesce(F.try_parse_json(payload), F.to_variant_object(F.array(F.coalesce(payload, F.lit("")))))
    rows = F.transform(
        bind(whole, lambda v: walk(v, depth)),
        lambda r: F.struct(F.trim(r["degree"]).alias("degree"), F.trim(F.regexp_replace(r["grade"], r"([%\d])\.+$", "$1")).alias("grade")),
    )
    return F.coalesce(F.array_distinct(F.filter(rows, lambda r: (r["degree"] != "") & (r["grade"] != ""))), none)
