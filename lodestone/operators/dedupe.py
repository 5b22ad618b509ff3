"""Latest-version and canonical-variant dedupe: one row a group by an explicit, total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.functions.levels import rank
from lodestone.functions.text import name_key


def first_per(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """The first row of each group by a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def ranked_intake(df: DataFrame, url: str, level: Column, order: Column, scope: list[str] = ()) -> DataFrame:
    """Each row with its place (__place, from 1) among the intakes of its course: same level, same slug but for the year.

    Later years come first, then the greater URL, then the row's own order.
    `scope` names columns, such as the university, that part the input.
    """
    slug = urls.slug(F.col(url))
    w = Window.partitionBy(*scope, level, urls.identity(slug)).orderBy(
        urls.intake_year(slug).desc(), F.lower(F.col(url)).desc(), order
    )
    return df.withColumn("__place", F.row_number().over(w))


def latest_intake(df: DataFrame, url: str, level: Column, order: Column, scope: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped): the latest intake of each course, and the rest. Rows without a URL are in neither."""
    placed = ranked_intake(df.where(F.coalesce(F.trim(F.col(url)), F.lit("")) != ""), url, level, order, scope)
    return placed.where("__place = 1").drop("__place"), placed.where("__place > 1").drop("__place")


def latest_by_name(df: DataFrame, name: str, path: str, scope: list[str] = ()) -> DataFrame:
    """One row a course name: the latest intake year of its path, then the greater path."""
    stem = F.regexp_extract(F.regexp_replace(F.col(path), r"/[^/]*$", ""), r"([^/]*)$", 1)
    key = F.coalesce(F.nullif(name_key(F.col(name)), F.lit("")), stem)
    return first_per(df, [*scope, key], [urls.intake_year(stem).desc(), F.lower(F.col(path)).desc()])


def variant_priority(file_name: Column, url: Column) -> list[Column]:
    """slug.md before slug-2.md before others, then by number and name."""
    stem, slug = F.regexp_replace(file_name, r"\.[^.]*$", ""), urls.slug(url)
    rest = F.substring(stem, F.length(slug) + 1, F.length(stem))
    number = F.regexp_extract(rest, r"^-(\d+)$", 1).try_cast("int")
    numbered = stem.startswith(slug) & number.isNotNull()
    tier = F.when(stem == slug, 0).when(numbered, 1).otherwise(2)
    return [tier, F.when(numbered, number).otherwise(0), F.lower(file_name)]


def canonical_variant(df: DataFrame, file_name: str, url: str, level: str, scope: list[str] = ()) -> DataFrame:
    """One file a (level, URL); a blank level counts as undergraduate, rows without a URL go."""
    lvl = F.coalesce(F.nullif(F.trim(F.col(level)), F.lit("")), F.lit("undergraduate"))
    rows = df.where(F.coalesce(F.trim(F.col(url)), F.lit("")) != "")
    return first_per(rows, [*scope, lvl, F.trim(F.col(url))], variant_priority(F.col(file_name), F.col(url)))


def export_rows(df: DataFrame, url: str, level: str, foundation: Column, exists: Column, scope: list[str] = ()) -> DataFrame:
    """One row a (course path, level): the level that the path's rows prefer, then rows with an artefact, then by level."""
    key, lvl = urls.path_key(F.col(url)), F.lower(F.trim(F.col(level)))
    marked = df.withColumn("__f", F.max(foundation.cast("int")).over(Window.partitionBy(*scope, key, lvl)))
    wanted = F.when(F.col("__f") == 1, "foundation").otherwise("undergraduate")
    order = [F.when(lvl == wanted, 0).otherwise(1), F.when(exists, 0).otherwise(1), lvl, F.col(url)]
    return first_per(marked, [*scope, key, lvl], order).drop("__f")


def ordered_unique(df: DataFrame, url: str, order: Column, scope: list[str] = ()) -> DataFrame:
    """The first row of each trimmed URL; blank ones go."""
    key = urls.trimmed(F.col(url))
    return first_per(df.where(key != ""), [*scope, key], [order])


def merge_by_key(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of both, those of `incoming` in the place of rows of `existing` with the same key."""
    return incoming.unionByName(existing.join(incoming.select(*keys).distinct(), keys, "left_anti"))


def replace_scope(existing: DataFrame, incoming: DataFrame, scope: list[str]) -> DataFrame:
    """The incoming rows, and the existing ones of every scope, such as a university, that has no incoming row: a run that
    found nothing takes nothing away."""
    return incoming.unionByName(existing.join(incoming.select(*scope).distinct(), scope, "left_anti"))


def upsert_first(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Of the rows of existing with an incoming key the first is replaced and the others stay; new keys are appended."""
    w = Window.partitionBy(F.trim(F.col(key))).orderBy(order)
    old = existing.withColumn("__n", F.row_number().over(w)).withColumn("__k", F.trim(F.col(key)))
    new = incoming.withColumn("__k", F.trim(F.col(key)))
    stay = old.join(new.select("__k").distinct().withColumn("__n", F.lit(1)), ["__k", "__n"], "left_anti")
    return stay.drop("__n", "__k").unionByName(new.drop("__k"))


def best_seed(df: DataFrame, url: str) -> DataFrame:
    """For each listing path the URL of the least page and that page."""
    return df.groupBy(urls.path_key(F.col(url)).alias("path_key")).agg(
        F.min_by(F.col(url), F.struct(urls.page_number(F.col(url)), F.col(url))).alias("seed"),
        F.min(urls.page_number(F.col(url))).alias("page"),
    )


def primary_per(df: DataFrame, keys: list[str], level: str) -> DataFrame:
    """For each key its level of the highest priority."""
    return df.groupBy(*keys).agg(F.min_by(F.col(level), F.struct(rank(F.col(level)), F.col(level))).alias("primary_level"))
