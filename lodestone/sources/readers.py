"""Readers. Paths go to Spark's own sources, so that they may lie in any store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.markdown import front_matter, title

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def csv(spark: SparkSession, path: str | list[str], required: list[str] = (), sep: str = ",") -> DataFrame:
    """A CSV with a header, all columns text and trimmed, quotes and line breaks in quotes allowed; rows that are blank
    throughout go. Missing required columns are an error."""
    df = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    df = df.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in df.columns})
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    df = df.select(*(F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in df.columns))
    return df.where(F.concat_ws("", *(F.col(f"`{c}`") for c in df.columns)) != "")


def index_csv(spark: SparkSession, path: str, schema: list[str]) -> DataFrame:
    """An index file whose first line may be `sep=`; tab or comma, told by the header line."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^﻿?sep="))
    header = lines.where(F.regexp_replace("value", "[﻿\"]", "").startswith(schema[0])).limit(1).collect()
    if not header:
        raise FileNotFoundError(f"{path} has no header that starts with {schema[0]}")
    sep = "\t" if "\t" in header[0]["value"] else ","
    names = [c.strip().strip('"') for c in header[0]["value"].lstrip("﻿").split(sep)]
    read = F.from_csv("value", ", ".join(f"`{c}` string" for c in names), {"sep": sep, "escape": '"'})
    rows = lines.where(F.col("value") != header[0]["value"]).select(read.alias("r")).select("r.*")
    rows = rows.select(*(F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in names))
    return rows.where(F.concat_ws("", *(F.col(f"`{c}`") for c in names)) != "")


def course_urls(spark: SparkSession, path: str) -> DataFrame:
    """course_url of a URL list with a header course_url or url, else of the first cell that is a URL."""
    df = csv(spark, path)
    named = [F.nullif(F.col(c), F.lit("")) for c in ("course_url", "url") if c in df.columns]
    cells = F.filter(F.array(*(F.col(f"`{c}`") for c in df.columns)), lambda x: x.startswith("http"))
    return df.select(F.coalesce(*named, F.get(cells, 0)).alias("course_url")).where("course_url is not null")


def url_levels(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(course_url, study_level, source_scope) of the level files, each pair once; a scope beats a blank one."""
    df = csv(spark, paths, ["course_url", "study_level"])
    scope = F.nullif(F.col("source_scope"), F.lit("")) if "source_scope" in df.columns else F.lit(None).cast("string")
    return (
        df.where("course_url <> '' and study_level <> ''")
        .groupBy("course_url", "study_level")
        .agg(F.coalesce(F.max(scope), F.lit("")).alias("source_scope"))
    )


def progress_levels(spark: SparkSession, path: str) -> DataFrame:
    """(course_url, study_level, source_scope) of the url_levels of a progress file."""
    doc = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", "url_levels map<string,map<string,string>>")["url_levels"]).alias("course_url", "m")
    )
    return doc.select("course_url", F.explode("m").alias("study_level", "source_scope"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """course_url of a file of any of the known forms: a JSON object (courses or urls), a JSON list, or lines, with
    comments after #."""
    text = spark.read.text(path, wholetext=True)
    v = F.try_parse_json("value")
    item = "array<variant>"
    listed = F.coalesce(
        F.try_variant_get(v, "$.courses", item), F.try_variant_get(v, "$.urls", item), F.try_variant_get(v, "$", item)
    )
    from_json = F.transform(
        listed, lambda x: F.coalesce(F.try_variant_get(x, "$.course_url", "string"), F.try_variant_get(x, "$", "string"))
    )
    from_lines = F.transform(F.split("value", r"\r?\n"), lambda x: F.trim(F.get(F.split(x, ","), 0)))
    return text.select(F.explode(F.coalesce(from_json, from_lines)).alias("course_url")).where(
        "course_url like 'http%'"
    )


def json_files(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """All files of a name below a folder, one row each with its path."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", name)
        .option("multiLine", True)
        .schema(schema)
        .json(folder)
        .select("*", F.col("_metadata.file_path").alias("path"))
    )


def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, meta, body, title) of all markdown files below a folder."""
    df = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.md")
        .text(folder, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )
    meta, body = front_matter(F.col("value"))
    return df.select("path", meta.alias("meta"), body.alias("body")).withColumn(
        "title", title(F.col("body"), F.coalesce(F.col("meta")["course_url"], F.col("path")))
    )


def html_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, html) of all saved pages below a folder."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.html")
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    )


def saved_pages(spark: SparkSession, folder: str, page_map: DataFrame | None = None) -> DataFrame:
    """(course_url, path, html) of a university's saved pages: those of its page map, else all in its folder.

    page_map: course_url and html_path (or html_file), below `folder`. Rows
    without a path, or whose page is not there, do not count. Only where none
    is left are all pages of `folder`/course_pages read and asked for their own
    address, so no job reads both. A folder without pages gives no rows.
    """
    from lodestone.functions.urls import source_url

    def read(paths: list[str] | str, **options) -> DataFrame:
        reader = spark.read.options(**options).option("ignoreMissingFiles", True)
        return reader.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))

    hadoop = spark._jvm.org.apache.hadoop.fs
    there = lambda path: hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop.Path(path))
    root = folder.rstrip("/")
    if page_map is not None:
        names = [F.nullif(F.trim(c), F.lit("")) for c in ("html_path", "html_file") if c in page_map.columns]
        listed = page_map.select(F.coalesce("course_url", F.lit("")).alias("course_url"), F.coalesce(*names).alias("name")).where("name is not null")
        tail = lambda p: F.regexp_replace(F.url_decode(F.regexp_replace(p, r"\+", "%2B")), r"^.*?/course_pages/", "course_pages/")
        if there(f"{root}/course_pages"):
            # the listing of names alone tells which pages are there
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/course_pages").select("path")
            known = files.select(tail(F.col("path")).alias("name"), "path")
            found = listed.join(known, "name")
            if not found.isEmpty():
                pages = read(f"{root}/course_pages", recursiveFileLookup=True).withColumn("name", tail(F.col("path")))
                return found.select("course_url", "name").join(pages, "name").select(F.trim("course_url").alias("course_url"), "path", "html")
    if not there(f"{root}/course_pages"):
        return spark.createDataFrame([], "course_url string, path string, html string")
    pages = read(f"{root}/course_pages", pathGlobFilter="*.html")
    return pages.select(source_url(F.col("html")).alias("course_url"), "path", "html")


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(level, key, value) of a dictionary file: {key: value}, {"global": {...}}, or with byStudyLevel; level null for all."""
    text = spark.read.text(path, wholetext=True)
    v = F.try_parse_json("value")
    flat = "map<string,string>"
    whole = F.coalesce(F.try_variant_get(v, "$.global", flat), F.try_variant_get(v, "$", flat))
    rows = text.select(F.lit(None).cast("string").alias("level"), F.explode(whole).alias("key", "value"))
    levels = text.select(F.explode(F.try_variant_get(v, "$.byStudyLevel", f"map<string,{flat}>")).alias("level", "m"))
    return rows.unionByName(levels.select("level", F.explode("m").alias("key", "value"))).where("value is not null")


def registry(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of a pipe table in a markdown file, in the file's order of columns."""
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = spark.read.text(path).where(F.trim("value").startswith("|")).select(cells.alias("c"))
    rows = rows.where((F.size("c") >= len(columns)) & ~F.get("c", 0).rlike("^:?-+:?$") & (F.lower(F.get("c", 0)) != columns[0].lower()))
    return rows.select(*(F.get("c", k).alias(name) for k, name in enumerate(columns)))


def settings(text: str) -> dict[str, str]:
    """KEY=VALUE lines of a settings text; values in quotes may run over lines."""
    found: dict[str, str] = {}
    lines = iter(text.splitlines())
    for line in lines:
        if not line.strip() or line.lstrip().startswith("#") or "=" not in line:
            continue
        key, value = (x.strip() for x in line.split("=", 1))
        if value[:1] in ("'", '"'):
            quote, value = value[0], value[1:]
            while not value.rstrip().endswith(quote):
                more = next(lines, None)
                if more is None:
                    break
                value += "\n" + more
            value = value.rstrip().removesuffix(quote)
        found[key] = value
    return found


def setting_list(value: str | None) -> list[str]:
    """Items of a setting parted by line breaks or semicolons, without comments."""
    import re

    items = [x.strip().strip("\"'") for x in re.split(r"[\n;]+", value or "")]
    return [x for x in items if x and (not x.startswith("#") or re.match(r"#\w", x))]


def stage_parts(stored: DataFrame, combined: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """Parts of stored records, where one is missing the same field of the combined record."""
    c = combined.select(key, *(F.col(p).alias(f"__{p}") for p in parts))
    return stored.join(c, key, "full").select(key, *(F.coalesce(F.col(p), F.col(f"__{p}")).alias(p) for p in parts))


def links(pages: DataFrame, key: Column, html: Column, base: Column) -> DataFrame:
    """One row an anchor: key and the absolute URL without its fragment and query."""
    from lodestone.functions.html import absolute, anchors
    from lodestone.functions.urls import normalized, redirect_target

    rows = pages.select(key.alias("key"), base.alias("base"), F.explode(anchors(html)).alias("href"))
    return rows.select("key", "href", normalized(redirect_target(absolute(F.col("href"), F.col("base")))).alias("url"))
