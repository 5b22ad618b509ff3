"""Nested metadata, requirements and polymorphic JSON as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.text import (
    ENTRY_DEGREES,
    degree_enum,
    is_empty,
    requirement_degree,
    requirement_grade,
)

META = "array<struct<subtitle:string,description:array<string>>>"
REQUIREMENTS = "array<struct<degree:string,grade:string>>"
#: Names of a level in reference documents. Fixed values.
LEVEL_NAMES = {
    "foundation": ("foundation", "foundation year"),
    "undergraduate": ("undergraduate",),
    "postgraduate": ("postgraduate", "postgraduate research"),
}
#: Rank of a degree, from school certificates to doctorates. Fixed values.
DEGREE_RANK = {"HSC": 0, "Diploma": 0, "BA": 1, "BSc": 1, "BBA": 1, "BEng": 1, "BCom": 1, "MA": 2, "MSc": 2, "MBA": 2, "PhD": 3}


def _strings(v: Column) -> Column:
    """A variant as an array of texts: a list's items, else a text itself; nulls and blanks dropped."""
    listed = F.try_variant_get(v, "$", "array<string>")
    one = F.try_variant_get(v, "$", "string")
    raw = F.when(F.schema_of_variant(v).startswith("ARRAY"), listed).otherwise(F.array(one))
    return F.filter(raw, lambda x: x.isNotNull() & (x != ""))


def metadata(raw: Column, default_subtitle: str = "") -> Column:
    """JSON text of blocks as an array of (subtitle, description): one object counts as a list of one, a text as a
    description of one line, `title` as a subtitle; falsy lines go. Anything else is an empty array."""
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    blocks = F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(
        kind.startswith("OBJECT"), F.array(v)
    )
    put = F.transform(
        F.filter(blocks, lambda b: F.schema_of_variant(b).startswith("OBJECT")),
        lambda b: F.struct(
            F.coalesce(
                F.nullif(F.try_variant_get(b, "$.subtitle", "string"), F.lit("")),
                F.nullif(F.try_variant_get(b, "$.title", "string"), F.lit("")),
                F.lit(default_subtitle),
            ).alias("subtitle"),
            F.coalesce(_strings(F.try_variant_get(b, "$.description", "variant")), F.array().cast("array<string>")).alias(
                "description"
            ),
        ),
    )
    return F.coalesce(put, F.array()).cast(META)


def is_metadata(raw: Column) -> Column:
    """True where a text is blank or a JSON list of objects whose descriptions are missing or lists of texts."""
    v = F.try_parse_json(raw)
    items = F.try_variant_get(v, "$", "array<variant>")

    def fits(b: Column) -> Column:
        d = F.try_variant_get(b, "$.description", "variant")
        kind = F.schema_of_variant(d)
        return F.schema_of_variant(b).startswith("OBJECT") & (
            d.isNull() | kind.isin("VOID", "ARRAY<STRING>", "ARRAY<VOID>")
        )

    return is_blank(raw) | F.coalesce(F.schema_of_variant(v).startswith("ARRAY") & F.forall(items, fits), F.lit(False))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def has_block(items: Column, needle: str) -> Column:
    """Some block whose subtitle contains the word has a line that is not blank."""
    return F.exists(
        items,
        lambda b: F.contains(F.lower(F.trim(b["subtitle"])), F.lit(needle))
        & F.exists(b["description"], lambda d: F.trim(d) != ""),
    )


def meta_text(items: Column, subtitle: str | None = None, sep: str = "\n") -> Column:
    """All lines of the blocks, or of those with the subtitle, joined."""
    chosen = items if subtitle is None else F.filter(items, lambda b: F.lower(F.trim(b["subtitle"])) == subtitle.lower())
    return F.array_join(F.flatten(F.transform(chosen, lambda b: b["description"])), sep)


def merge_by_subtitle(first: Column, second: Column) -> Column:
    """The blocks of both, those of the second only where the first has no such subtitle."""
    key = lambda b: F.lower(F.trim(b["subtitle"]))
    return F.concat(
        first, F.filter(second, lambda b: (key(b) == "") | ~F.exists(first, lambda a: key(a) == key(b)))
    )


def academic_only(items: Column) -> Column:
    """Entry and English blocks under their proper subtitles; blocks without one that speak of IELTS are English ones."""

    def repaired(b: Column) -> Column:
        sub = F.lower(F.trim(b["subtitle"]))
        speaks = F.exists(b["description"], lambda d: F.lower(d).rlike("ielts|overall"))
        english = (sub == "") & speaks
        lines = F.transform(
            b["description"],
            lambda d: F.when(
                english & (F.trim(d) != "") & ~d.rlike(r"(?i)\bIELTS\b") & d.rlike(r"\d\.\d"),
                F.concat(F.lit("IELTS "), F.trim(d)),
            ).otherwise(d),
        )
        name = F.when(english | (sub == "english requirement"), "English Requirement").when(
            sub == "entry requirements", "Entry Requirements"
        )
        return F.struct(name.alias("subtitle"), lines.alias("description"))

    return F.filter(
        F.transform(F.filter(items, lambda b: F.size(b["description"]) > 0), repaired), lambda b: b["subtitle"].isNotNull()
    )


def requirements(raw: Column, level: str = "") -> Column:
    """Rows (degree, grade) under their proper labels; incomplete rows go, and degrees that the level does not allow."""
    put = F.transform(
        raw,
        lambda r: F.struct(
            requirement_degree(F.coalesce(r["degree"], F.lit(""))).alias("degree"),
            F.trim(F.coalesce(r["grade"], F.lit(""))).alias("grade"),
        ),
    )
    keep = F.filter(put, lambda r: (r["degree"] != "") & (r["grade"] != ""))
    if level in ENTRY_DEGREES:
        keep = F.filter(keep, lambda r: r["degree"].isin(*ENTRY_DEGREES[level]))
    return F.coalesce(keep, F.array().cast(REQUIREMENTS))


def distinct_requirements(rows: Column) -> Column:
    """The first of rows that are equal without regard to case, in order."""
    key = lambda r: F.lower(F.concat_ws("\x01", F.trim(r["degree"]), F.trim(r["grade"])))
    keys = F.transform(rows, key)
    return F.transform(
        F.filter(
            F.zip_with(rows, F.sequence(F.lit(1), F.greatest(F.size(rows), F.lit(1))), lambda r, k: F.struct(r.alias("r"), k.alias("k"))),
            lambda s: s["r"].isNotNull() & (F.array_position(keys, key(s["r"])) == s["k"]),
        ),
        lambda s: s["r"],
    )


ENTRY_DOCUMENT = (
    "struct<studyLevels:array<struct<studyLevel:string,programs:array<struct<program:string,"
    "requirements:array<struct<degree:string,grade:string>>,description:array<string>>>>>>"
)


def country_requirements(document: Column, level: str) -> Column:
    """All requirement rows of a level of a nested entry document (JSON text), under their proper labels."""
    names = LEVEL_NAMES.get(level, (level,))
    levels = F.filter(
        F.from_json(document, ENTRY_DOCUMENT)["studyLevels"], lambda x: F.lower(F.trim(x["studyLevel"])).isin(*names)
    )
    rows = F.flatten(F.transform(F.flatten(F.transform(levels, lambda x: x["programs"])), lambda p: p["requirements"]))
    put = F.transform(
        rows,
        lambda r: F.struct(
            requirement_degree(F.coalesce(r["degree"], F.lit(""))).alias("degree"),
            requirement_grade(F.coalesce(r["grade"], F.lit(""))).alias("grade"),
        ),
    )
    return F.coalesce(F.filter(put, lambda r: (r["degree"] != "") & (r["grade"] != "")), F.array().cast(REQUIREMENTS))


def bullets(text: Column) -> Column:
    """Requirement rows of `- **Label:** value` lines."""
    p = r"(?m)^\s*-\s*\*\*([^:*]+):\*\*\s*(.+)$"
    rows = F.zip_with(
        F.regexp_extract_all(text, F.lit(p), F.lit(1)),
        F.regexp_extract_all(text, F.lit(p), F.lit(2)),
        lambda a, b: F.struct(requirement_degree(a).alias("degree"), requirement_grade(b).alias("grade")),
    )
    return F.filter(rows, lambda r: (F.lower(r["degree"]) != "description") & (r["degree"] != "") & (r["grade"] != ""))


def ranked_requirements(rows: Column) -> Column:
    """Rows as (rank, place, degree, grade), sorted by rank and place; rows without a known degree go."""
    rank = F.create_map(*(F.lit(x) for kv in DEGREE_RANK.items() for x in kv))
    placed = F.transform(
        rows,
        lambda r, k: F.struct(
            rank[degree_enum(F.coalesce(r["degree"], F.lit("")))].alias("rank"),
            k.alias("place"),
            degree_enum(F.coalesce(r["degree"], F.lit(""))).alias("degree"),
            r["grade"].alias("grade"),
        ),
    )
    return F.array_sort(F.filter(placed, lambda r: r["degree"] != ""))


def least_and_higher(ranked: Column) -> tuple[Column, Column]:
    """The lowest entry row; and the highest postgraduate row, else, over a school certificate, the first bachelor row."""
    least = F.get(ranked, 0)
    post = F.filter(ranked, lambda r: r["rank"] >= 2)
    top = F.get(F.filter(post, lambda r: r["rank"] == F.array_max(F.transform(post, lambda q: q["rank"]))), 0)
    bachelor = F.when(least["rank"] == 0, F.get(F.filter(ranked, lambda r: r["rank"] == 1), 0))
    return least, F.coalesce(top, bachelor)


def by_path(json: Column, path: str) -> Column:
    """The text at a path like a.b.0.c of a JSON text; '' if there is none."""
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    v = F.try_variant_get(F.try_parse_json(json), f"${steps}", "variant")
    plain = F.try_variant_get(v, "$", "string")
    return F.coalesce(F.when(F.schema_of_variant(v).rlike("^(ARRAY|OBJECT)"), F.to_json(v)).otherwise(plain), F.lit(""))


def signature(rows: Column) -> Column:
    """The sorted keys of the first object of a JSON list: the shape of its rows."""
    first = F.get(F.try_variant_get(F.try_parse_json(rows), "$", "array<variant>"), 0)
    return F.coalesce(F.array_join(F.array_sort(F.json_object_keys(F.to_json(first))), ","), F.lit(""))


def unfenced(text: Column) -> Column:
    """A model's answer without the code fence around it, parsed; null if it is no JSON."""
    return F.try_parse_json(F.regexp_replace(F.trim(text), r"(?s)^```(?:json)?\s*|\s*```$", ""))


def missing_names(fields: list[str]) -> Column:
    """The names of the empty ones among columns, in order."""
    return F.array_compact(F.array(*(F.when(is_empty(F.col(f)), F.lit(f)) for f in fields)))
