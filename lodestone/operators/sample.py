"""Samples over study levels. The order within a level is the md5 of seed and URL, which every engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.levels import WORK_ORDER, rank
from lodestone.functions.urls import trimmed
from lodestone.operators.dedupe import first_per


def _shuffled(df: DataFrame, url: str, level: str, seed: int, levels: tuple[str, ...]) -> DataFrame:
    rows = df.where(F.col(level).isin(*levels) & (trimmed(F.col(url)) != ""))
    once = first_per(rows, [F.col(level), trimmed(F.col(url))], [F.col(url)])
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(url)))
    return once.withColumn("__r", F.row_number().over(Window.partitionBy(level).orderBy(order, F.col(url))))


def stratified(df: DataFrame, url: str, level: str, n: int = 10, seed: int = 0, levels: tuple[str, ...] = WORK_ORDER) -> DataFrame:
    """n URLs, each once, taken from the levels in turn. A URL of several levels counts for the one where it comes first."""
    place = rank(F.col(level), WORK_ORDER)
    rows = _shuffled(df, url, level, seed, levels).withColumn("__l", place)
    once = first_per(rows, [trimmed(F.col(url))], [F.col("__r"), F.col("__l")])
    turn = once.withColumn("__t", F.row_number().over(Window.partitionBy(level).orderBy("__r")))
    return turn.orderBy("__t", "__l").limit(n).drop("__r", "__l", "__t")


def per_level(df: DataFrame, url: str, level: str, n: int = 5, seed: int = 0, levels: tuple[str, ...] = WORK_ORDER) -> DataFrame:
    """Up to n URLs of each level."""
    return _shuffled(df, url, level, seed, levels).where(F.col("__r") <= n).drop("__r")


def of_levels(df: DataFrame, url: str, level: str, levels: list[str]) -> DataFrame:
    """Rows of the levels, each URL once, the level that comes first in the order of work winning."""
    rows = df.where(F.col(level).isin(*levels) & (trimmed(F.col(url)) != ""))
    return first_per(rows, [trimmed(F.col(url))], [rank(F.col(level), WORK_ORDER), F.col(url)])


def repeated_pages(df: DataFrame, key: Column, page: Column, content: Column) -> DataFrame:
    """Each page with how many pages in a row, it included, repeat the one before (0 where it differs)."""
    by = Window.partitionBy(key).orderBy(page)
    same = F.coalesce((content == F.lag(content).over(by)).cast("int"), F.lit(0))
    marked = df.withColumn("__s", same)
    island = F.sum(1 - F.col("__s")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("__i", island)
    streak = F.sum("__s").over(Window.partitionBy(key, F.col("__i")).orderBy(page).rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("streak", streak).drop("__s", "__i")
