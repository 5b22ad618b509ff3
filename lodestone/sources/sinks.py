"""Writers. All go through Spark's writers to any store; none gathers rows on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.levels import LEVELS
from lodestone.operators.export import cell


def csv(df: DataFrame, path: str, quote_all: bool = False, sep: str = ",", mode: str = "overwrite", bom: bool = False) -> None:
    """A CSV with a header; nested columns as JSON text, nulls as ''. With `bom` each file starts with the byte-order mark.

    With minimal quotes the mark is the first sign of the header's first name. A
    quoted header cannot hold it, so there each file's text is put together: the
    mark and the header stand before the first row of each partition.
    """
    flat = df.select(*(cell(F.col(f"`{c}`"), kind).alias(c) for c, kind in df.dtypes))
    if bom and quote_all:
        quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        line = F.concat_ws(sep, *(quoted(F.col(f"`{c}`")) for c in flat.columns))
        head = "\ufeff" + sep.join('"' + c.replace('"', '""') + '"' for c in flat.columns)
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # the row's place in its partition
        rows = flat.select(F.when(first, F.concat(F.lit(head + "\n"), line)).otherwise(line).alias("value"))
        if flat.isEmpty():
            rows = df.sparkSession.createDataFrame([(head,)], "value string").coalesce(1)
        rows.write.mode(mode).text(path)
        return
    if bom:
        flat = flat.toDF("\ufeff" + flat.columns[0], *flat.columns[1:])
    (
        flat.write.mode(mode)
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("sep", sep)
        .csv(path)
    )


def level_files(df: DataFrame, folder: str, level: str = "study_level") -> None:
    """One folder `level_file=<level>_course_urls.csv` a level, by one write; one of only a header for a level without rows.

    Rows of other levels are left out. The rows are read once and nothing is cached.
    """
    known = df.where(F.col(level).isin(*LEVELS))
    flat = known.select(*(cell(F.col(f"`{c}`"), kind).alias(c) for c, kind in df.dtypes))
    rows = flat.withColumn("level_file", F.concat(F.col(level), F.lit("_course_urls.csv")))
    quoted = {"header": True, "quoteAll": True, "escape": '"', "emptyValue": ""}
    rows.write.mode("overwrite").partitionBy("level_file").options(**quoted).csv(folder)
    head = flat.limit(0).coalesce(1)
    for name in LEVELS:  # a folder with rows is left as it is
        head.write.mode("ignore").options(**quoted).csv(f"{folder}/level_file={name}_course_urls.csv")


def level_file(folder: str, level: str) -> str:
    """Where level_files() puts a level."""
    return f"{folder}/level_file={level}_course_urls.csv"


def appended(stream: DataFrame, path: str, checkpoint: str, columns: list[str], sep: str = "\t"):
    """Append a stream's rows to a file of text parted by tabs: byte-order mark, `sep=`, the header once, then each batch.

    The batch id is the guard: a batch that runs again replaces its own part,
    so that no row is appended twice. The parts' names are in order, so that
    they make the whole file when put together; separated() reads them. Values
    are quoted where they must be, nested ones are JSON, nulls ''.
    """

    def quoted(c: str, kind: str):
        value = cell(F.col(f"`{c}`"), kind)
        return F.when(value.rlike(f'["\r\n{sep}]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number == 0:
            head = spark.createDataFrame([(f"\ufeffsep={sep}\n{sep.join(columns)}",)], "value string")
            head.coalesce(1).write.mode("overwrite").text(f"{path}/0-head")
        kinds = dict(batch.dtypes)
        lines = batch.select(F.concat_ws(sep, *(quoted(c, kinds[c]) for c in columns)).alias("value"))
        lines.write.mode("overwrite").text(f"{path}/1-batch-{number:012d}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def separated(spark, path: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """Rows of appended(), all columns as text, without the lines before the first row."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.read.option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", True).option("emptyValue", "").option("nullValue", "\u0000")
    found = rows.schema(schema).csv(f"{path}/1-batch-*")
    return found.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns))


def partitioned(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite") -> None:
    """Parquet in a folder a key: what replaces a tree of small files."""
    df.repartition(*keys).write.mode(mode).partitionBy(*keys).parquet(path)


def split_by(df: DataFrame, wanted: DataFrame, key: str, path: str) -> DataFrame:
    """Rows of the wanted keys as CSV in a folder a key; returns the wanted keys that have no rows."""
    rows = df.join(wanted.select(key), key, "left_semi")
    flat = rows.select(*(cell(F.col(f"`{c}`"), kind).alias(c) for c, kind in rows.dtypes))
    flat.write.mode("overwrite").option("header", True).partitionBy(key).csv(path)
    return wanted.select(key).join(df.select(key), key, "left_anti")


def append_text(df: DataFrame, path: str, sep: str = "\t") -> None:
    csv(df, path, sep=sep, mode="append")


def report(df: DataFrame, path: str, force: bool = False) -> None:
    """A text column as lines; an existing report is replaced only with force."""
    df.write.mode("overwrite" if force else "errorifexists").text(path)


def audit(df: DataFrame, path: str) -> None:
    """Artefacts (key, stage, kind, payload) appended to a table a stage."""
    df.select("key", "stage", "kind", "payload").write.mode("append").partitionBy("stage").parquet(path)


def document(meta: list[str], body: str = "body"):
    """A markdown document with a header of the columns of `meta`."""
    head = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in meta]
    return F.concat_ws("\n", F.lit("---"), *head, F.lit("---"), F.lit(""), F.col(body))
