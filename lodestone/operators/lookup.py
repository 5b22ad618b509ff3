"""Tiered and banded lookups and the dictionaries behind them.

Dictionaries are joined, not broadcast by hand: Spark broadcasts them while
they are under spark.sql.autoBroadcastJoinThreshold and shuffles them beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import lookup_keys, name_key
from lodestone.functions.urls import path_key


def last_per_key(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """One row a key: the last by `order`, as a dictionary that is written over would hold it."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("hit"))


def tiered(df: DataFrame, portal: DataFrame, url: str, name: str, order: str, values: list[str], scope: list[str] = ()) -> DataFrame:
    """`values` of the portal row of the same path and name, else of the same path, else of the same name.

    The first tier that hits gives the whole row; in each tier a later portal
    row replaces an earlier one of the same key.
    """
    base = portal.select(
        *scope, path_key(F.col(url)).alias("__u"), name_key(F.col(name)).alias("__c"), F.col(order).alias("__o"), *values
    )
    both = last_per_key(base.where("__u <> '' and __c <> ''"), [*scope, "__u", "__c"], "__o", values)
    by_url = last_per_key(base.where("__u <> ''"), [*scope, "__u"], "__o", values)
    by_name = last_per_key(base.where("__c <> ''"), [*scope, "__c"], "__o", values)
    rows = df.withColumns({"__u": path_key(F.col(url)), "__c": name_key(F.col(name))})
    rows = (
        rows.join(both.withColumnRenamed("hit", "__h1"), [*scope, "__u", "__c"], "left")
        .join(by_url.withColumnRenamed("hit", "__h2"), [*scope, "__u"], "left")
        .join(by_name.withColumnRenamed("hit", "__h3"), [*scope, "__c"], "left")
    )
    tier = F.when(F.col("__h1").isNotNull(), 1).when(F.col("__h2").isNotNull(), 2).when(F.col("__h3").isNotNull(), 3)
    return rows.withColumns({"portal": F.coalesce("__h1", "__h2", "__h3"), "tier": F.coalesce(tier, F.lit(0))}).drop(
        "__u", "__c", "__h1", "__h2", "__h3"
    )


def by_ordered_keys(df: DataFrame, dictionary: DataFrame, name: str, row: str, value: str) -> DataFrame:
    """The dictionary's value (columns key, value) of the first of a name's keys that it has, as column `value`."""
    keyed = df.select(F.col(row).alias("__r"), F.posexplode(lookup_keys(F.col(name))).alias("__p", "key"))
    hits = (
        keyed.join(dictionary.where("value <> ''"), "key")
        .groupBy("__r")
        .agg(F.min_by("value", "__p").alias(value))
    )
    return df.join(hits, df[row] == hits["__r"], "left").drop("__r")


def by_level_then_global(df: DataFrame, dictionary: DataFrame, name: str, level: str, row: str, value: str) -> DataFrame:
    """As by_ordered_keys with a dictionary (level, key, value), level null for all: the row's level, then all levels,
    then, where the row has none, any level."""
    keyed = df.select(
        F.col(row).alias("__r"), F.nullif(F.trim(F.col(level)), F.lit("")).alias("__l"), F.posexplode(lookup_keys(F.col(name))).alias("__p", "key")
    )
    tier = F.when(F.col("level") == F.col("__l"), 0).when(F.col("level").isNull(), 1).when(F.col("__l").isNull(), 2)
    hits = (
        keyed.join(dictionary.where("value <> ''"), "key")
        .withColumn("__t", tier)
        .where("__t is not null")
        .groupBy("__r")
        .agg(F.min_by("value", F.struct("__t", "__p", "level")).alias(value))
    )
    return df.join(hits, df[row] == hits["__r"], "left").drop("__r")


def unambiguous(df: DataFrame, name: str, value: str) -> DataFrame:
    """(key, value) of the lookup keys that have one value only."""
    return (
        df.where((F.trim(F.col(value)) != "") & (F.trim(F.col(name)) != ""))
        .select(F.explode(lookup_keys(F.col(name))).alias("key"), F.trim(F.col(value)).alias("value"))
        .groupBy("key")
        .agg(F.min("value").alias("value"), F.max("value").alias("__m"))
        .where("value = __m")
        .drop("__m")
    )


def unambiguous_levels(df: DataFrame, name: str, value: str, level: str) -> DataFrame:
    """(level, key, value) of keys with one value, per level and, with a null level, over all."""
    rows = df.where((F.trim(F.col(value)) != "") & (F.trim(F.col(name)) != "")).select(
        F.col(level).alias("level"), F.explode(lookup_keys(F.col(name))).alias("key"), F.trim(F.col(value)).alias("value")
    )
    return (
        rows.groupingSets([["level", "key"], ["key"]], "level", "key")
        .agg(F.min("value").alias("value"), F.max("value").alias("__m"))
        .where("value = __m")
        .drop("__m")
    )


def ambiguous_counts(df: DataFrame, name: str, value: str, level: str) -> DataFrame:
    """(level, ambiguous): how many lookup keys of each level have more than one value, levels without any included."""
    return (
        df.where((F.trim(F.col(value)) != "") & (F.trim(F.col(name)) != ""))
        .select(F.col(level).alias("level"), F.explode(lookup_keys(F.col(name))).alias("key"), F.trim(F.col(value)).alias("value"))
        .groupBy("level", "key")
        .agg((F.min("value") != F.max("value")).alias("__a"))
        .groupBy("level")
        .agg(F.count_if("__a").alias("ambiguous"))
    )


def band_of(df: DataFrame, bands: DataFrame, value: Column, out: str, row: str) -> DataFrame:
    """The banded value (columns threshold, points) of the largest threshold that is not above; 0 below all.

    The bands become one sorted array, which rides on each row: a lookup, not a
    join of every row with every band. Bands are a published scale of a few rows.
    """
    table = bands.agg(F.array_sort(F.collect_list(F.struct("threshold", "points"))).alias("__b"))
    hit = F.array_max(F.filter("__b", lambda b: b["threshold"] <= F.col("__v")))
    return (
        df.withColumn("__v", value)
        .join(F.broadcast(table))
        .withColumn(out, F.when(F.col("__v").isNull(), None).otherwise(F.coalesce(hit["points"], F.lit(0.0))))
        .drop("__v", "__b")
    )


def first_rule(df: DataFrame, rules: list[tuple[Column, object]], out: str, default=None) -> DataFrame:
    """The value of the first rule whose condition holds: ordered rules as one CASE."""
    put = F.lit(default)
    for condition, value in reversed(rules):
        put = F.when(condition, F.lit(value)).otherwise(put)
    return df.withColumn(out, put)


def keyword_matches(df: DataFrame, text: Column, keywords: list[tuple[str, str]], out: str) -> DataFrame:
    """All labels whose keyword a text contains, the longest keyword first, each once."""
    ordered = sorted(enumerate(keywords), key=lambda kv: (-len(kv[1][0]), kv[0]))
    hits = [F.when(F.contains(F.lower(text), F.lit(word.lower())), F.lit(label)) for _, (word, label) in ordered]
    return df.withColumn(out, F.array_distinct(F.array_compact(F.array(*hits))))


def best_score(df: DataFrame, text: Column, programmes: list[str], hints: dict[str, list[str]], out: str) -> DataFrame:
    """The programme of the best score, ties to the earlier: 10 for a hint, 2 for each shared word over three letters."""
    low = F.lower(text)
    scores = []
    for place, programme in enumerate(programmes):
        score = F.lit(0)
        for hint, words in hints.items():
            if hint in programme.lower():
                any_word = F.lit(False)
                for w in words:
                    any_word = any_word | F.contains(low, F.lit(w))
                score = score + F.when(any_word, 10).otherwise(0)
        for word in [w for w in "".join(c if c.isalnum() else " " for c in programme.lower()).split() if len(w) > 3]:
            score = score + F.when(F.contains(low, F.lit(word)), 2).otherwise(0)
        scores.append(F.struct(score.alias("score"), F.lit(-place).alias("place"), F.lit(programme).alias("programme")))
    best = F.array_max(F.array(*scores))
    return df.withColumns({out: best["programme"], f"{out}_score": best["score"]})


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those done."""
    return df.join(done.select(key), key, "left_anti")


def requested(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among those asked for."""
    return df.join(wanted.select(key), key, "left_semi")


def is_stale(expected: DataFrame, found: DataFrame) -> DataFrame:
    """One row: how many keys are missing, how many are left over, and whether the two sets differ."""
    more = expected.distinct().exceptAll(found.distinct()).agg(F.count(F.lit(1)).alias("missing"))
    less = found.distinct().exceptAll(expected.distinct()).agg(F.count(F.lit(1)).alias("extra"))
    return more.join(less).withColumn("stale", (F.col("missing") > 0) | (F.col("extra") > 0))
