"""Stored records mended from fresh ones, and stored tables laid out anew, both so that a repeated run changes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _blank(value: Column, kind: str) -> Column:
    if kind == "string":
        return F.coalesce(F.trim(value) == "", F.lit(True))
    if kind.startswith("array"):
        return F.coalesce(F.size(value) == 0, F.lit(True))
    return value.isNull()


def backfilled(stored: DataFrame, fresh: DataFrame, key: str, always: list[str] = (), if_given: list[str] = ()) -> DataFrame:
    """stored with fields of the fresh row of the same key, and what that changes.

    Fields of `always` become the fresh ones even where these are blank, those
    of `if_given` only where they are not (null, blank text, empty list).
    changed: the names of fields that are no longer what they were, nested ones
    compared whole and null-safe; empty for rows without a fresh one. fresh has
    one row a key.
    """
    kinds = dict(stored.dtypes)
    new = fresh.select(key, F.lit(True).alias("__has"), *(F.col(c).cast(stored.schema[c].dataType).alias(f"__{c}") for c in (*always, *if_given)))
    both = stored.join(new, key, "left")
    value = {c: F.when(F.col("__has"), F.col(f"__{c}")).otherwise(F.col(c)) for c in always}
    value |= {c: F.when(F.col("__has") & ~_blank(F.col(f"__{c}"), kinds[c]), F.col(f"__{c}")).otherwise(F.col(c)) for c in if_given}
    differs = [F.when(~F.col(c).eqNullSafe(v), F.lit(c)) for c, v in value.items()]
    return both.select(
        *(value.get(c, F.col(c)).alias(c) for c in stored.columns), F.array_compact(F.array(*differs)).alias("changed")
    )


def rewrite_changed(spark: SparkSession, path: str, rows: DataFrame, parts: list[str]) -> int:
    """Write the partitions of a Parquet table that hold a changed row of backfilled(), and no other; the number of changed rows.

    The new rows are first written beside the table, so that a run that stops
    leaves either the old partition or the whole new one, and the run after it
    does what is left.
    """
    changed = rows.where(F.size("changed") > 0)
    counted = changed.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))
    beside = f"{path.rstrip('/')}.new"
    touched = rows.join(counted.select(*parts), parts, "left_semi").drop("changed")
    n = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    if n:
        touched.write.mode("overwrite").parquet(beside)
        held = spark.read.schema(touched.schema).parquet(beside)
        held.repartition(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    return n


def relaid(rows: DataFrame, target: str, parts: list[str]) -> DataFrame:
    """Write rows to target in a folder for each value of `parts`, and hold the counts against what can then be read.

    Only the folders of these rows are replaced, each as a whole, so that a run
    after one that stopped, or on part of the rows, neither loses nor repeats
    any. Returns parts, before, after; raises where they differ. The rows must
    not be read from target itself.
    """
    spark = rows.sparkSession
    rows.repartition(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(target)
    text = lambda df: df.select(*(F.col(p).cast("string").alias(p) for p in parts))
    counts = lambda df, name: text(df).groupBy(*parts).agg(F.count(F.lit(1)).alias(name))
    before = counts(rows, "before").alias("b")
    after = counts(spark.read.parquet(target), "after").alias("a")
    same = [F.col(f"b.{p}").eqNullSafe(F.col(f"a.{p}")) for p in parts]
    on = same[0]
    for s in same[1:]:
        on = on & s
    held = before.join(after, on, "left").select(*(f"b.{p}" for p in parts), "before", F.coalesce("after", F.lit(0)).alias("after"))
    wrong = held.where("before <> after").limit(1).collect()
    if wrong:
        raise RuntimeError(f"rows differ after the move: {wrong[0].asDict()}")
    return held
