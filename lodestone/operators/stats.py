"""Completeness statistics, error histograms and template mining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import any_of, error_bucket, is_empty
from lodestone.functions.urls import page_number, path_of, path_template


def page_steps(df: DataFrame, url: str, by: list[str]) -> DataFrame:
    """The step between a listing's two least page numbers, at least 1; 1 where it has one URL. One row a listing (`by`)."""
    order = Window.partitionBy(*by).orderBy("__p")
    return (
        df.select(*by, page_number(F.col(url)).alias("__p"))
        .withColumn("__n", F.row_number().over(order))
        .where("__n <= 2")
        .groupBy(*by)
        .agg(F.greatest(F.lit(1), F.max("__p") - F.min("__p")).alias("page_step"))
    )


def missing_required(df: DataFrame, level: Column, required: list[str]) -> DataFrame:
    """Per level: rows, rows that miss a required field, and their share in percent."""
    missing = F.when(any_of([is_empty(F.col(c)) for c in required]), 1).otherwise(0)
    return (
        df.groupBy(level.alias("level"))
        .agg(F.count(F.lit(1)).alias("total"), F.sum(missing).alias("missing_required"))
        .withColumn("percent", F.round(100 * F.col("missing_required") / F.col("total"), 1))
    )


def missing_matrix(df: DataFrame, level: Column, fields: list[str]) -> DataFrame:
    """Long form (level, field, missing): how many rows of a level have an empty field."""
    wide = df.groupBy(level.alias("level")).agg(
        *(F.sum(F.when(is_empty(F.col(c)), 1).otherwise(0)).alias(c) for c in fields)
    )
    return wide.unpivot("level", fields, "field", "missing")


def error_histogram(df: DataFrame, level: Column, reason: str) -> DataFrame:
    return df.groupBy(level.alias("level"), error_bucket(F.col(reason)).alias("error_key")).agg(F.count(F.lit(1)).alias("n"))


def empty_columns(df: DataFrame, fields: list[str]) -> DataFrame:
    """Long form (field, empty): rows whose field is null or blank."""
    wide = df.agg(*(F.sum(F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", 1).otherwise(0)).alias(c) for c in fields))
    return wide.withColumn("__one", F.lit(1)).unpivot("__one", fields, "field", "empty").drop("__one")


def level_counts(df: DataFrame, level: Column, key: Column, levels: tuple[str, ...]) -> DataFrame:
    """Distinct keys per level, levels without rows included with 0."""
    every = df.sparkSession.createDataFrame([(x,) for x in levels], "level string")
    found = df.where(key != "").groupBy(level.alias("level")).agg(F.count_distinct(key).alias("n"))
    return every.join(found, "level", "left").select("level", F.coalesce("n", F.lit(0)).alias("n"))


def histogram(df: DataFrame, keys: list[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def enough_per_level(counts: DataFrame, n: int) -> DataFrame:
    """One row: whether every level that has keys has n or more, so that reading listings may stop."""
    seen = counts.where("n > 0")
    return seen.agg(((F.count(F.lit(1)) > 0) & (F.coalesce(F.min("n"), F.lit(0)) >= n)).alias("stop"))


def templates(df: DataFrame, url: str, least: int, broad: bool = False) -> DataFrame:
    """(template, n) of path templates that `least` or more distinct paths share."""
    return (
        df.select(path_template(F.col(url), broad).alias("template"), path_of(F.col(url)).alias("path"))
        .where("template is not null")
        .groupBy("template")
        .agg(F.count_distinct("path").alias("n"))
        .where(F.col("n") >= least)
    )


def suggested_templates(df: DataFrame, url: str, least: int, top: int = 10) -> DataFrame:
    """The `top` templates by paths, with the share of all paths that each and all up to it cover."""
    from pyspark.sql import Window

    best = templates(df, url, least).orderBy(F.desc("n"), "template").limit(top)
    total = df.select(path_of(F.col(url)).alias("p")).agg(F.count_distinct("p").alias("total"))
    w = Window.orderBy(F.desc("n"), "template").rowsBetween(Window.unboundedPreceding, 0)
    return best.join(F.broadcast(total)).select(
        "template", "n", F.round(F.col("n") / F.col("total"), 4).alias("share"), F.round(F.sum("n").over(w) / F.col("total"), 4).alias("running_share")
    )


def selector_scores(links: DataFrame, classes: str, is_course: Column) -> DataFrame:
    """Per class of links: hits on course pages, coverage, purity and their product as score."""
    rows = links.select(is_course.cast("int").alias("hit"), F.explode(F.col(classes)).alias("selector"))
    total = links.agg(F.sum(is_course.cast("int")).alias("all_hits"))
    return (
        rows.groupBy("selector")
        .agg(F.sum("hit").alias("hits"), F.count(F.lit(1)).alias("links"))
        .join(F.broadcast(total))
        .select(
            "selector",
            "hits",
            (F.col("hits") / F.col("all_hits")).alias("coverage"),
            (F.col("hits") / F.col("links")).alias("purity"),
            (F.col("hits") / F.col("all_hits") * F.col("hits") / F.col("links")).alias("score"),
        )
    )


def exclusions(links: DataFrame, url: str, is_course: Column, least: int, top: int = 35) -> DataFrame:
    """Shallow paths (depth 1 or 2) that are linked often and are no course pages."""
    depth = F.size(F.filter(F.split(path_of(F.col(url)), "/"), lambda p: p != ""))
    return (
        links.where(~is_course & depth.between(1, 2))
        .groupBy(path_of(F.col(url)).alias("path"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
        .orderBy(F.desc("n"), "path")
        .limit(top)
    )
