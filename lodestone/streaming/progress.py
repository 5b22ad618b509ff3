"""Progress tables, the listing state machine and event-time windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STOP_AFTER = 2  # empty or repeated pages in a row


def latest_status(events: DataFrame, key: str, order: str, status: str = "status") -> DataFrame:
    """The last status of each key: what a progress file of completed and failed keys holds."""
    return events.groupBy(key).agg(F.max_by(F.col(status), F.col(order)).alias(status))


def pending(items: DataFrame, events: DataFrame, key: str, order: str, retry_failed: bool = True) -> DataFrame:
    """Items not completed; with retry_failed those that failed come again."""
    done = latest_status(events, key, order).where(F.col("status").isin("completed", *([] if retry_failed else ["failed"])))
    return items.join(done.select(key), key, "left_anti")


def attempted(items: DataFrame, work: Callable[[pd.Series], pd.Series], column: str, out: str) -> DataFrame:
    """Each row with the result of `work` on a column, or null and the error's text: one bad row fails no job."""
    schema = f"{', '.join(f'`{c}` {t}' for c, t in items.dtypes)}, {out} string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results, errors = [], []
            for value in batch[column]:
                try:
                    results.append(work(value))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  the work is the caller's
                    results.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield batch.assign(**{out: results, "error": errors})

    return items.mapInPandas(run, schema)


def in_batches(items: DataFrame, ask: Callable[[list[str]], dict[str, str]], name: str, allowed: list[str], size: int = 20) -> DataFrame:
    """(name, value, error) that a provider picks from a closed list, asked for `size` names at a time; an answer off the
    list gives no row, a batch that fails one row a name with the error and no value."""
    legal = {a.lower(): a for a in allowed}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = batch[name].tolist()
            for k in range(0, len(names), size):
                try:
                    got = ask(names[k : k + size])
                except Exception as failed:  # noqa: BLE001  the provider is the caller's
                    rows = [(n, None, f"{type(failed).__name__}: {failed}") for n in names[k : k + size]]
                else:
                    rows = [(n, legal[str(v).lower()], None) for n, v in got.items() if n in names and str(v).lower() in legal]
                yield pd.DataFrame(rows, columns=[name, "value", "error"], dtype=object)

    return items.select(name).distinct().mapInPandas(run, f"`{name}` string, value string, error string")


def listing_batch(pages: DataFrame, key: str, page: str, urls: str) -> DataFrame:
    """The pages of each listing that would be read: up to where STOP_AFTER in a row bring no new URLs, the last included.

    Batch form of listing_stream: a page's URLs are its array column `urls`.
    """
    by = Window.partitionBy(key).orderBy(page)
    content = F.array_join(F.array_sort(F.array_distinct(urls)), "\n")
    idle = F.when((content == "") | (content == F.lag(content).over(by)), 1).otherwise(0)
    rows = pages.withColumn("idle", F.coalesce(idle, F.lit(0)))
    island = F.sum(1 - F.col("idle")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__i", island)
    streak = F.sum("idle").over(Window.partitionBy(key, "__i").orderBy(page).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("streak", streak.cast("long"))
    over = F.coalesce(F.max((F.col("streak") >= STOP_AFTER).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("__o", over).where("`__o` = 0").drop("__i", "__o")


def listing_stream(pages: DataFrame, key: str, page: str, urls: str) -> DataFrame:
    """The same on a stream, keyed by listing: state is the last page's URLs, the streak and whether the listing is over."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, streak, over = state.get if state.exists else ("\x00", 0, False)
        rows = []
        for row in pd.concat(list(batches)).sort_values(page).itertuples(index=False):
            if over:
                break
            found = "\n".join(sorted(set(getattr(row, urls))))
            streak = streak + 1 if found in ("", last) else 0
            last, over = found, streak >= STOP_AFTER
            rows.append((k[0], getattr(row, page), streak, over))
        state.update((last, streak, over))
        yield pd.DataFrame(rows, columns=[key, page, "streak", "over"])

    kinds = dict(pages.dtypes)
    return pages.groupBy(key).applyInPandasWithState(
        step,
        outputStructType=f"`{key}` {kinds[key]}, `{page}` {kinds[page]}, streak long, over boolean",
        stateStructType="last string, streak long, over boolean",
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )


def upserted(stream: DataFrame, path: str, checkpoint: str, key: str, order: str):
    """Write a stream so that a key's last row wins and a batch run again changes nothing: one folder a batch, read by
    latest_of."""

    def put(batch: DataFrame, number: int) -> None:
        last = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), F.col(order)).alias("r")).select("r.*")
        last.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def latest_of(spark, path: str, key: str, order: str) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct("batch", order)).alias("r")).select("r.*").drop("batch")


def rewritten_keys(progress: DataFrame, levels: DataFrame, slug: str) -> DataFrame:
    """Progress keys that are bare slugs as level::slug, where the slug's level is known."""
    return progress.join(levels, slug, "left").withColumn("key", F.coalesce(F.concat_ws("::", "level", slug), F.col(slug))).drop("level")


def phase_status(counts: DataFrame, key: str) -> DataFrame:
    """done, partial, in_progress or not_started from numbers of expected, done and begun artefacts; missing without any expectation."""
    status = (
        F.when(F.coalesce(F.col("expected"), F.lit(0)) == 0, "missing")
        .when(F.col("done") >= F.col("expected"), "done")
        .when(F.col("done") > 0, "partial")
        .when(F.col("begun") > 0, "in_progress")
        .otherwise("not_started")
    )
    return counts.select(key, status.alias("status"))


#: Phases and what shows how far they are: pattern of the artefacts that are wanted, of those that are there, of what a begun phase leaves.
PHASES = (
    ("download", "", r"/clean/courses/.*\.md$", r"/course_pages/[^/]+\.html$"),
    ("extract", r"/clean/courses/.*\.md$", r"/extracted/.*/output\.json$", r"/extracted/extraction_progress\.json$"),
    ("normalize", r"/extracted/.*/output\.json$", r"/extracted/.*/normalized\.json$", ""),
)


def artefacts(spark, folder: str) -> DataFrame:
    """path, length and time of every file below a folder, from the file system's listing (Spark's lists no empty ones); no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("time"))


def artefact_states(files: DataFrame, expected: DataFrame | None = None, phases=PHASES, root: str = r"/([^/]+)/output/") -> DataFrame:
    """university, phase, expected, done, begun, latest (time) and status of each phase, from its files.

    The university is the folder that `root` finds. A phase without a pattern
    of wanted files takes their number from expected (university, phase, n).
    Empty files do not count as done. Statuses are those of phase_status().
    """
    uni = F.regexp_extract("path", root, 1)
    full = F.col("length") > 0
    count = lambda pattern, test: F.count_if(F.col("path").rlike(pattern) & test) if pattern else F.lit(0).cast("long")
    sums = []
    for name, wanted, done, begun in phases:
        latest = F.max(F.when(F.col("path").rlike(done), F.col("time")))
        sums.append(
            F.struct(
                F.lit(name).alias("phase"),
                count(wanted, full).alias("wanted"),
                count(done, full).alias("done"),
                (count(begun, F.lit(True)) + count(done, ~full)).alias("begun"),
                latest.alias("latest"),
            )
        )
    per = files.withColumn("university", uni).where("university <> ''").groupBy("university").agg(F.array(*sums).alias("p"))
    rows = per.select("university", F.explode("p").alias("p")).select("university", "p.*")
    if expected is not None:
        keys = ["university", "phase"]
        rows = rows.join(expected.select(*keys, F.col("n").alias("told")), keys, "full")
    else:
        rows = rows.withColumn("told", F.lit(None).cast("long"))
    zero = F.lit(0).cast("long")
    counts = rows.select(
        F.struct("university", "phase").alias("key"),
        F.coalesce(F.col("told").cast("long"), "wanted", zero).alias("expected"),
        F.coalesce("done", zero).alias("done"),
        F.coalesce("begun", zero).alias("begun"),
        "latest",
    )
    status = phase_status(counts, "key")
    return counts.join(status, "key").select("key.university", "key.phase", "expected", "done", "begun", "latest", "status")


def windowed_counts(events: DataFrame, time: str, kind: str, length: str, late: str) -> DataFrame:
    """Counts per tumbling window of event time; rows later than `late` are dropped."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, length).alias("w"), F.col(kind))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), kind, "n")
    )


def sessions(events: DataFrame, time: str, key: str, gap: str) -> DataFrame:
    """Sessions of a key: events with less than `gap` between them."""
    return (
        events.groupBy(F.session_window(time, gap).alias("w"), F.col(key))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
    )
