"""Exact dedup by skew-safe combining, with DataFrame functions only."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestone.llm.shared import ascii_lower, masked_salts, salt_masks, salt_of, set_aside, staged

ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """Add the scan position as a row number, the identity of a row within one job."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def held_rows(docs: DataFrame) -> DataFrame:
    """numbered(), written once: the numbers stay those of the same rows in later jobs, however these split their scans."""
    return staged(numbered(docs), "rows")


def identified(docs: DataFrame) -> DataFrame:
    """Add an identity that stays a row's however scans are split: its file and place there, or else its number in a written copy.

    Rows that were multiplied after the scan share a place. Places are counted
    first, without reading a text; where one repeats, the copy is written.
    """
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        placed = docs.withColumn(ROW, place)
    except AnalysisException:  # no scan of Parquet files
        return held_rows(docs)
    repeated = placed.groupBy(f"{ROW}.file", f"{ROW}.at").count().where("count > 1")
    return placed if repeated.isEmpty() else held_rows(docs)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One verdict per row of `docs`, which must carry `__row`, from numbered() or identified().

    Texts are equal when identical after lower-casing A-Z only; null counts as
    empty. Three combining stages, each grouped on the digest AND the whole
    text, so that no decision rests on a hash alone:

    1. local: the partial aggregate of a scan partition keeps one row a text;
    2. salted: the rows of a digest meet in up to 1,024 groups, by a hash of
       the row, so a text held by a third of all rows is spread over many tasks,
       also where these repeat one id or have none;
    3. global: the salt winners are combined.

    The winners, id and row, are written, so that they are chosen once even
    where rows tie, and go back to the rows by (digest, salt): a text of one
    copy has one such key, a hot one 1,024. Were two texts ever to share a
    digest and a salt, the job would stop with an error rather than merge them.

    Defined results: null and '' form one group; a null id loses to any other
    id; rows repeating both id and text are one document, of which one row is
    kept; texts are compared whole at any length; an empty table gives an empty
    table; other columns are ignored.
    """
    kind = docs.schema[ROW].dataType
    identity = [F.col(f"{ROW}.{f}") for f in kind.fieldNames()] if isinstance(kind, StructType) else [F.col(ROW)]
    names = [f"__at{k}" for k in range(len(identity))]

    def of_best(parts: list[Column], order: str) -> list[Column]:
        """The parts of the identity of the row with the largest order, of any one where all are null; the same row's in each."""
        return [F.coalesce(F.max_by(p, F.col(order)), F.first(p)).alias(n) for p, n in zip(parts, names, strict=True)]

    rows = docs.select(
        F.col(ROW),
        F.col(id_col).alias("doc_id"),
        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"),
    ).select(
        ROW,
        "doc_id",
        "norm",
        F.sha2("norm", 256).alias("text_sha256"),
        salt_of(ROW).alias("salt"),
    )
    salted = rows.groupBy("text_sha256", "salt", "norm").agg(
        F.max("doc_id").alias("best"), F.count(F.lit(1)).alias("n"), *of_best(identity, "doc_id")
    )
    whole = salted.groupBy("text_sha256", "norm").agg(
        F.max("best").alias("keep_id"),
        F.sum("n").alias("group_size"),
        *of_best([F.col(n) for n in names], "best"),
        *salt_masks(),
    )
    winners = staged(whole.drop("norm"), "winners")
    verdicts = (
        winners.select("text_sha256", "keep_id", "group_size", *names, masked_salts().alias("salt"))
        .groupBy("text_sha256", "salt")
        .agg(*(F.max(c).alias(c) for c in ("keep_id", "group_size", *names)), F.count(F.lit(1)).alias("texts"))
        .withColumn(
            "group_size",
            F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
                F.raise_error(F.lit("two different texts share a SHA-256 digest")).cast("long")
            ),
        )
    )
    same = F.lit(True)
    for part, name in zip(identity, names, strict=True):
        same = same & (part == F.col(name))
    return (
        rows.drop("norm")
        .join(verdicts, ["text_sha256", "salt"])
        .select(ROW, "doc_id", "keep_id", "group_size", same.alias("kept"), "text_sha256")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of equal texts the largest id.

    Defined results are those of exact_groups(); a column of docs named like the row's identity is kept.
    """
    rows, own = set_aside(docs, ROW)
    rows = identified(rows)
    new = {old: renamed for renamed, old in own.items()}
    stay = exact_groups(rows, new.get(id_col, id_col), new.get(text_col, text_col)).where("kept").select(ROW)
    return rows.join(stay, ROW, "left_semi").drop(ROW).withColumnsRenamed(own).select(*docs.columns)
