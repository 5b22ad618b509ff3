"""Catalogue settings, onboarding templates, document sections and index rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.functions.markdown import front_matter
from lodestone.sources.readers import settings

#: Scopes of catalogue settings. Fixed values.
SCOPES = ("UNDERGRADUATE", "POSTGRADUATE", "POSTGRADUATE_RESEARCH", "FOUNDATION")
#: Headings of the documents of a university. Fixed values.
SECTION_TITLES = {
    "bangladesh-entry.md": "Bangladesh Entry Requirements",
    "english-requirements.md": "English Language Requirements",
    "scholarships.md": "Scholarships",
    "deposit.md": "Tuition Fee Deposit",
}
#: Columns of the matrix of a template. Fixed values.
TEMPLATE_COLUMNS = (
    "programme", "all_listing", "page_1", "page_2", "detail", "entry", "english", "scholarship", "deposit", "comments",
)
#: Folders that a saved page can lie in. Fixed values.
SAVED_FOLDERS = ("course_listing", "course_detail", "uni_req")


#: How a specification states its intake points, and what ends the list. Fixed values.
INTAKE_POINTS = r"Standard\s+intake\s+points?\s*(?:\([^)]*\))?\s*:?\s*([A-Za-z][A-Za-z0-9,./;&\s-]*?)"
INTAKE_ENDS = r"(?=\s{2,}|\.|Course\s|Final\s+award|Length\s+of|UCAS|Credit\s+level|$)"


def setting_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(path, key, value) of every settings file below a folder: one row a setting, for any number of files."""
    read = F.udf(lambda text: list(settings(text or "").items()), "array<struct<key:string,value:string>>")
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.env")
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )
    return files.select("path", F.explode(read("text")).alias("s")).select("path", "s.key", F.trim("s.value").alias("value"))


def catalogue_sources(rows: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(path, scope, catalogue_url, catalogue_html, domain, source) of the scopes that settings (path, key, value) name.

    scope '' is the setting without one. A scope with a saved page but no URL
    takes the URL that the page (path, html) says it was saved from; one that
    has no sound URL then is an error row: source is 'error'.
    """
    p = rf"^(?:({'|'.join(SCOPES)})_)?COURSE_CATALOGUE_(URL|HTML)$"
    said = rows.select("path", F.regexp_extract("key", p, 1).alias("scope"), F.regexp_extract("key", p, 2).alias("what"), "value")
    one = said.where("what <> '' and value <> ''").groupBy("path", "scope").agg(
        F.max(F.when(F.col("what") == "URL", F.col("value"))).alias("url"),
        F.max(F.when(F.col("what") == "HTML", F.col("value"))).alias("html"),
    )
    if pages is not None:
        saved = pages.select(F.col("path").alias("html"), urls.source_url(F.col("html")).alias("saved_from"))
        one = one.join(saved, "html", "left")
    else:
        one = one.withColumn("saved_from", F.lit(None).cast("string"))
    url = F.regexp_replace(F.coalesce("url", F.nullif("saved_from", F.lit("")), F.lit("")), "/+$", "")
    host = urls.host_of(url)
    return one.select(
        "path",
        "scope",
        url.alias("catalogue_url"),
        F.coalesce("html", F.lit("")).alias("catalogue_html"),
        F.lower(host).alias("domain"),
        F.when(F.coalesce(host, F.lit("")) == "", "error").when(F.col("html").isNotNull(), "html").otherwise("url").alias("source"),
    )


def listing_seeds(rows: DataFrame) -> DataFrame:
    """(path, scope, at, url, search_path) of COURSE_LISTING_PAGE_1, _2 and so on, up to the first that is missing;
    a URL counts once, where it comes first."""
    from pyspark.sql import Window

    p = rf"^(?:({'|'.join(SCOPES)})_)?COURSE_LISTING_PAGE_(\d+)$"
    found = rows.select(
        "path", F.regexp_extract("key", p, 1).alias("scope"), F.regexp_extract("key", p, 2).try_cast("int").alias("at"), "value"
    ).where("at >= 1 and value <> ''")
    in_scope = Window.partitionBy("path", "scope").orderBy("at")
    gapless = found.withColumn("n", F.row_number().over(in_scope)).where("n = at").drop("n")
    url = urls.normalized(F.col("value"), keep_query=True)
    once = gapless.select("path", "scope", "at", url.alias("url")).groupBy("path", "scope", "url").agg(F.min("at").alias("at"))
    return once.withColumn("search_path", urls.path_key(F.col("url")))


def template(spark: SparkSession, path: str) -> DataFrame:
    """Rows of onboarding templates: file, course_type, university_name, university_url and the matrix's columns.

    The first lines are told by their first cell, so files of any number and
    order are read by one scan each in whole. A quoted cell may hold line breaks.
    """
    schema = ", ".join(f"c{k} string" for k in range(len(TEMPLATE_COLUMNS)))
    read = spark.read.options(multiLine=True, quote='"', escape='"').schema(schema).csv(path)
    cell = lambda k: F.regexp_replace(F.coalesce(F.col(f"c{k}"), F.lit("")), "^﻿?[ \r]*|[ \r]+$", "").alias(f"c{k}")
    cells = read.select(F.col("_metadata.file_path").alias("file"), *map(cell, range(len(TEMPLATE_COLUMNS))))
    low = F.lower("c0")
    head = cells.groupBy("file").agg(
        F.max(F.when(low == "course type", F.col("c1"))).alias("course_type"),
        F.max(F.when(low == "uni name", F.col("c1"))).alias("university_name"),
        F.max(F.when(low == "uni link", F.col("c1"))).alias("university_url"),
    )
    body = cells.where(~low.isin("", "course type", "uni name", "uni link", "programme"))
    named = body.select("file", *(F.col(f"c{k}").alias(name) for k, name in enumerate(TEMPLATE_COLUMNS)))
    return named.join(head, "file")


def section_text(name: Column, markdown: Column) -> Column:
    """A document of a university under its heading, with the file it came from; '' for none."""
    _, body = front_matter(markdown)
    known = F.create_map(*(F.lit(x) for kv in SECTION_TITLES.items() for x in kv))
    words = F.initcap(F.replace(F.regexp_replace(name, r"\.md$", ""), F.lit("-"), F.lit(" ")))
    text = F.concat(F.lit("# "), F.coalesce(known[name], words), F.lit("\n\nSource file: clean/uni/"), name, F.lit("\n\n"), F.trim(body, F.lit(" \n\r\t")))
    return F.coalesce(F.when(markdown.isNotNull(), text), F.lit(""))


def index_entries(index: DataFrame) -> DataFrame:
    """Index rows trimmed, with course_url and clean_md, the path of the cleaned page under clean/courses/."""
    cell = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    md = cell("md_file")
    clean = F.when(md.startswith("clean/"), md).otherwise(F.concat(F.lit("clean/courses/"), md))
    return index.select(
        *(cell(c).alias(c) for c in ("uniName", "courseName", "degreeName", "courseUrlExternal", "md_file", "study_level")),
        cell("courseUrlExternal").alias("course_url"),
        F.replace(clean, F.lit("\\"), F.lit("/")).alias("clean_md"),
    )


def with_artefacts(entries: DataFrame, files: DataFrame, names: list[str]) -> DataFrame:
    """Entries with a column a name: the path, under the extraction folder, of that file of the course, '' for none.

    files: path, as level/slug/name. One pivot by name and one join by course,
    not a look at the file system a row.
    """
    split = files.select("path", F.split("path", "/").alias("p")).where(F.size("p") >= 3)
    keyed = split.select(
        F.get("p", F.size("p") - 3).alias("study_level"), F.get("p", F.size("p") - 2).alias("slug"), F.get("p", F.size("p") - 1).alias("name"), "path"
    )
    wide = keyed.groupBy("study_level", "slug").pivot("name", names).agg(F.max("path"))
    out = entries.withColumn("slug", urls.slug(F.col("course_url"))).join(wide, ["study_level", "slug"], "left")
    return out.withColumns({n: F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names})


def with_record(entries: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries that have a normalised record (study_level, slug, ...), with it; and those that have none."""
    keyed = entries.withColumn("slug", urls.slug(F.col("course_url")))
    keys = ["study_level", "slug"]
    return keyed.join(records, keys), keyed.join(records.select(*keys), keys, "left_anti")


def selected(
    entries: DataFrame,
    md_file: str | None = None,
    url_list: list[str] | None = None,
    levels: list[str] | None = None,
    index: int | None = None,
    limit: int | None = None,
    order: str = "course_url",
) -> DataFrame:
    """The entries that a run works on: by file, else by URLs, else by levels, else the index-th, else the first `limit`.

    With URLs or levels a limit holds too. Order is that of a column. A choice
    that names nothing is for the caller to report.
    """
    if md_file:
        name = md_file.rsplit("/", 1)[-1]
        return entries.where(F.regexp_extract("md_file", "([^/]*)$", 1) == name)
    if url_list:
        bare = [re.sub(r"[?#].*$", "", u.strip()).rstrip("/") for u in url_list]
        out = entries.where(urls.normalized(F.col("course_url")).isin(bare))
    elif levels:
        out = entries.where(F.col("study_level").isin(levels))
    elif index is not None:
        if index < 1:
            raise ValueError("index starts at 1")
        return entries.orderBy(order, "md_file").offset(index - 1).limit(1)
    else:
        out = entries
    return out.orderBy(order, "md_file").limit(limit) if limit is not None else out


def derive_candidates(body: Column, level: Column, levels: list[str], heading: str, signs: list[str]) -> Column:
    """Whether a page of one of the levels has a section whose text shows one of the signs (patterns)."""
    section = F.regexp_extract(body, rf"(?ims)^##[ \t]+{heading}[ \t]*$\n?(.*?)(?=^##[ \t]|\z)", 1)
    hit = F.lit(False)
    for sign in signs:
        hit = hit | section.rlike(sign)
    return F.lower(F.trim(level)).isin(levels) & (section != "") & hit


def portable_path(value: Column, kind: str = "course_listing") -> Column:
    """A saved page's path from any machine as ../folder/name; paths that are relative already stay."""
    raw = F.trim(value, F.lit(" \"'"))
    posix = F.replace(raw, F.lit("\\"), F.lit("/"))
    folder = "|".join(SAVED_FOLDERS)
    within = F.regexp_extract(posix, rf"(?:^|/)((?:{folder})(?:/.*)?)$", 1)
    absolute = raw.rlike(r"^(/|~|[A-Za-z]:)")
    last = F.regexp_extract(posix, r"([^/]*)/*$", 1)
    return (
        F.when(F.coalesce(raw, F.lit("")) == "", value)
        .when(within != "", F.concat(F.lit("../"), F.regexp_replace(within, "/+", "/")))
        .when(posix.rlike(r"^\.{1,2}/"), posix)
        .when(absolute | ~F.contains(posix, F.lit("/")), F.concat(F.lit(f"../{kind}/"), last))
        .otherwise(posix)
    )


def css_name(value: Column) -> Column:
    """A name as a CSS identifier: signs other than letters, digits, _ and - behind a backslash."""
    return F.regexp_replace(value, r"([^a-zA-Z0-9_-])", r"\\$1")


def intake_points(text: Column) -> Column:
    """Months of `Standard intake points (months): Feb, Sep` in a specification's text, in full, each once, in order."""
    from lodestone.functions.dates import MONTHS

    flat = F.regexp_replace(text, r"\s+", " ")
    said = F.regexp_extract(flat, f"(?i){INTAKE_POINTS}{INTAKE_ENDS}", 1)
    parts = F.transform(F.split(said, r"(?i)[,/&;]+|\s+and\s+"), lambda x: F.lower(F.regexp_replace(x, "[^A-Za-z]", "")))
    month = F.create_map(*(x for m in MONTHS for name in {m, m[:3], *(["sept"] if m == "september" else [])} for x in (F.lit(name), F.lit(m.title()))))
    return F.array_distinct(F.array_compact(F.transform(parts, lambda x: F.try_element_at(month, x))))


def log_events(df: DataFrame, run: str, level: Column, message: Column) -> DataFrame:
    """Rows of a run's log (run, at, level, message), to be appended to a table; levels START, INFO, OK, ERROR, END."""
    return df.select(F.lit(run).alias("run"), F.current_timestamp().alias("at"), level.alias("level"), message.alias("message"))
