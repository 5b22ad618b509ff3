"""Levels of URLs and programmes of courses, resolved by tiers; accepted answers of a model; index updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.levels import PRIORITY, classify, primary, rank
from lodestone.functions.text import english_group, name_key
from lodestone.functions.urls import path_key, trimmed


def levels_of(df: DataFrame, known: DataFrame, url: str, order: str = "ix") -> DataFrame:
    """`levels` of each URL: those known for it, else for it without closing slashes, else for the first URL of its path,
    else the classifier's. known: (course_url, study_level, order)."""
    per_url = known.groupBy("course_url").agg(
        F.array_sort(F.collect_set("study_level")).alias("l"), F.min(order).alias("at"), F.min(path_key(F.col("course_url"))).alias("p")
    )
    exact = per_url.select(F.col("course_url").alias("__u1"), F.col("l").alias("__l1"))
    bare = per_url.select(F.col("course_url").alias("__u2"), F.col("l").alias("__l2"))
    by_path = per_url.where("p <> ''").groupBy(F.col("p").alias("__u3")).agg(F.min_by("l", "at").alias("__l3"))
    rows = df.withColumns({"__u1": F.trim(F.col(url)), "__u2": trimmed(F.col(url)), "__u3": path_key(F.col(url))})
    rows = rows.join(exact, "__u1", "left").join(bare, "__u2", "left").join(by_path, "__u3", "left")
    return rows.withColumn("levels", F.coalesce("__l1", "__l2", "__l3", F.array(classify(F.col(url))))).drop(
        "__u1", "__u2", "__u3", "__l1", "__l2", "__l3"
    )


def course_level(df: DataFrame, known: DataFrame, index: DataFrame, url: str, name: str) -> DataFrame:
    """`level` of each course: the primary level known for its path, else the index's, else the classifier's."""
    by_path = known.groupBy(path_key(F.col("course_url")).alias("__p")).agg(primary(F.collect_set("study_level")).alias("__l1"))
    of_index = index.groupBy(path_key(F.col("course_url")).alias("__p")).agg(F.max_by("study_level", "ix").alias("__l2"))
    rows = df.withColumn("__p", path_key(F.col(url))).join(by_path.where("__p <> ''"), "__p", "left")
    rows = rows.join(of_index.where("__p <> ''"), "__p", "left")
    return rows.withColumn("level", F.coalesce("__l1", "__l2", classify(F.col(url), F.col(name)))).drop("__p", "__l1", "__l2")


def english_programme(courses: DataFrame, programmes: DataFrame, key: str, score: Column, scope: list[str]) -> DataFrame:
    """For each course its English programme: of its group by name, else, among those of its level, the best score over
    0, else the first. courses: (key, level, name, body); programmes: (ix, level, programme); score over both.

    scope: columns of both, such as the university, within which a course meets
    programmes; a university has a few of each level, so the join stays linear.
    Without one every course of a level would meet every programme of it.
    """
    if not scope:
        raise ValueError("scope names no column")
    group = english_group(F.coalesce("body", F.lit("")), F.coalesce("name", F.lit("")))
    c = courses.withColumn("__g", F.lower(group))
    p = programmes.withColumnsRenamed({"level": "__pl"} | {s: f"__of_{s}" for s in scope})
    within = F.lit(True)
    for s in scope:
        within = within & (F.col(s) == F.col(f"__of_{s}"))
    own = c.join(p, within & (F.col("__g") == F.lower(F.trim("programme")))).withColumn("__t", F.lit(0))
    same = c.join(p, within & (F.col("level") == F.col("__pl"))).withColumn("__t", F.lit(1))
    rows = own.unionByName(same).withColumn("__s", F.when(F.col("__t") == 0, 0).otherwise(score))
    w = Window.partitionBy(key).orderBy("__t", F.desc("__s"), "ix")
    return rows.withColumn("__n", F.row_number().over(w)).where("`__n` = 1").select(key, "programme", F.col("__s").alias("score"))


def accepted_answers(answers: DataFrame, asked: DataFrame, allowed: DataFrame) -> DataFrame:
    """(name, value) of a model's answers (column json) that name what was asked and a value of the closed list.

    An answer may be a list of objects under `matches`, an object under it, or
    a flat object.
    """
    v = F.try_parse_json("json")
    listed = F.transform(
        F.try_variant_get(v, "$.matches", "array<variant>"),
        lambda x: F.struct(
            F.try_variant_get(x, "$.courseName", "string").alias("key"), F.try_variant_get(x, "$.programmeName", "string").alias("value")
        ),
    )
    flat = "map<string,string>"
    pairs = F.coalesce(
        listed,
        F.map_entries(F.try_variant_get(v, "$.matches", flat)),
        F.map_entries(F.try_variant_get(v, "$", flat)),
    )
    rows = answers.select(F.explode(pairs).alias("p")).select(name_key(F.col("p.key")).alias("k"), F.lower(F.trim("p.value")).alias("v"))
    names = asked.select("name", name_key(F.col("name")).alias("k"))
    values = allowed.select(F.col("value"), F.lower(F.trim("value")).alias("v"))
    return rows.join(names, "k").join(values, "v").select("name", "value").distinct()


def index_update(index: DataFrame, done: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """Index rows with the columns of `done` put in by path, else by file name where that is the index's only one.

    File names are counted by an aggregate and resolved to the path of their
    only row, so the index is joined by path alone: a name that a third of the
    rows share is no key of a join.
    """
    base = F.regexp_extract(F.col(path), "([^/]*)$", 1)
    exact = done.select(F.col(path), F.struct(*columns).alias("__put"))
    # of several with one file name the least path
    by_name = done.join(index.select(path), path, "left_anti").groupBy(base.alias("__b")).agg(
        F.struct(*(F.min_by(F.col(c), F.col(path)).alias(c) for c in columns)).alias("__put")
    )
    only = index.groupBy(base.alias("__b")).agg(F.count(F.lit(1)).alias("__c"), F.min(path).alias(path)).where("`__c` = 1")
    named = only.join(by_name, "__b").select(path, "__put").join(done.select(path), path, "left_anti")
    rows = index.join(exact.unionByName(named), path, "left")
    put = {c: F.when(F.col("__put").isNotNull(), F.col(f"__put.{c}")).otherwise(F.col(c)) for c in columns}
    return rows.withColumns(put).select(*index.columns)


def gap_counts(rows: DataFrame, url: str, order: str, gaps: list[str], least: int = 2) -> DataFrame:
    """(url, n) of courses whose last row has `least` or more gaps."""
    last = rows.groupBy(url).agg(F.max_by(F.struct(*gaps), order).alias("r"))
    n = sum((F.coalesce(F.col(f"r.{g}"), F.lit(False)).cast("int") for g in gaps), F.lit(0))
    return last.select(url, n.alias("n")).where(F.col("n") >= least)


def compared(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, status): match, mismatch, missing_left or missing_right of a value on both sides."""
    both = left.select(key, F.col(value).alias("l")).join(right.select(key, F.col(value).alias("r")), key, "full")
    status = (
        F.when(F.coalesce("l", F.lit("")) == "", "missing_left")
        .when(F.coalesce("r", F.lit("")) == "", "missing_right")
        .when(F.col("l") == F.col("r"), "match")
        .otherwise("mismatch")
    )
    return both.select(key, status.alias("status"))


def shallowest(files: DataFrame, slug: str, path: str) -> DataFrame:
    """For each slug its file nearest to the root."""
    return files.groupBy(slug).agg(F.min_by(path, F.struct(F.size(F.split(F.col(path), "/")), F.col(path))).alias(path))


def grouped_rows(lines: DataFrame, key: str, department: str, award: str) -> DataFrame:
    """(department, award, course) of list lines under headings that carry department and award forward, each once."""
    w = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    head = lambda p: F.last(F.nullif(F.regexp_extract("line", p, 1), F.lit("")), ignorenulls=True).over(w)
    rows = lines.select(head(department).alias("department"), head(award).alias("award"), F.trim(F.regexp_extract("line", r"^\s*[-*]\s+(.+)$", 1)).alias("course"))
    rows = rows.where("course <> ''")
    return rows.groupBy(*(F.lower(F.coalesce(F.col(c), F.lit(""))) for c in ("department", "award", "course"))).agg(
        *(F.min(c).alias(c) for c in ("department", "award", "course"))
    ).select("department", "award", "course")


def by_priority(df: DataFrame, keys: list[str], level: str, value: str) -> DataFrame:
    """For each key the value of its level of the highest priority."""
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(rank(F.col(level), PRIORITY), F.col(value))).alias(value))
