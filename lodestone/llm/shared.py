"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where none is set and the master is local."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        made = context._jsc.sc().getCheckpointDir()
        if made.isEmpty():
            if not context.master.split("[")[0] == "local":
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="lodestone-"))
            made = context._jsc.sc().getCheckpointDir()
        folder = made.get()
    return folder


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again; options are the writer's.

    This cuts the lineage: a lost executor costs a re-read of shared files, not
    a re-run of what came before, and a table used twice is computed once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Jobs that run meanwhile send Arrow batches of about so many bytes, or of one longer row; a limit that is set stays.

    By default a batch has up to 64 MB, which the JVM holds outside the heap, in
    buffers that double as they grow, once for each running task.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.unset(key)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure-ASCII values take the JVM's fast path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body refers to it."""
    return F.transform(F.array(value), body)[0]


#: A hot key is spread over SALT_SIDE * SALT_SIDE salts.
SALT_SIDE = 32


def salt_of(by: str) -> Column:
    """The salt of a row, by a hash of one of its columns."""
    return F.pmod(F.xxhash64(by), F.lit(SALT_SIDE * SALT_SIDE)).cast("int")


def salt_masks() -> list[Column]:
    """Two aggregates that say which salts the rows of a key have: bits of the salts' two digits."""
    return [
        F.expr(f"bit_or(shiftleft(1L, salt div {SALT_SIDE}))").alias("mask_hi"),
        F.expr(f"bit_or(shiftleft(1L, salt % {SALT_SIDE}))").alias("mask_lo"),
    ]


def masked_salts() -> Column:
    """One row for each salt that mask_hi and mask_lo allow: one for a key of one row, all for a hot key."""
    digits = lambda mask: f"filter(sequence(0, {SALT_SIDE - 1}), i -> (shiftright({mask}, i) & 1L) = 1L)"
    return F.explode(
        F.expr(f"flatten(transform({digits('mask_hi')}, h -> transform({digits('mask_lo')}, l -> h * {SALT_SIDE} + l)))")
    )


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with its own columns of these names renamed, and the renaming to undo."""
    taken = {c.lower() for c in docs.columns}
    renamed = {}
    for column in docs.columns:
        if column.lower() in {n.lower() for n in names}:
            new = column
            while new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            renamed[new] = column
            docs = docs.withColumnRenamed(column, new)
    return docs, renamed


def doc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n: the fold that says which rows are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def vocabulary_path(name: str) -> str:
    """An absolute path as it is; else the place of a public vocabulary file of that name on this machine."""
    if name.startswith("/"):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text (null: empty), whatever else docs holds."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
