"""Secret scans by corpus-wide ownership frequency, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.exact_dedup import ROW, held_rows
from lodestone.llm.shared import let, masked_salts, salt_masks, salt_of, set_aside, staged

#: kind, pattern (group 1: the value), least length, of the value for `assign` and `prefixed` and of the match for the others.
KINDS = (
    (
        "assign",
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
    ),
    ("access", r"(AKIA[A-Z0-9]+)", 16),
    ("hex", r"([0-9a-f]+)", 32),
    ("prefixed", r"((?:gh[opsu]_|glpat-|xox[abprs]-|sk_live_|sk-|npm_)[A-Za-z0-9_-]{16,})", 16),
)
BASE = 3
LIVE = "live"
_BLOCK = 256


def _running_ends(lengths: Column) -> Column:
    """Running sums of an array of longs, in blocks, so that long arrays stay near-linear."""
    zero = F.lit(0).cast("long")
    add = lambda a, x: a + x
    count = F.ceil(F.size(lengths) / _BLOCK).cast("int")
    sums = F.transform(
        F.sequence(F.lit(0), count - 1), lambda b: F.aggregate(F.slice(lengths, b * _BLOCK + 1, _BLOCK), zero, add)
    )
    return let(
        let(
            sums,
            lambda s: F.transform(
                F.sequence(F.lit(0), count - 1),
                lambda b: F.aggregate(F.slice(s, F.lit(1), b), zero, add),
            ),
        ),
        lambda before: F.transform(
            F.sequence(F.lit(0), F.size(lengths) - 1),
            lambda i: F.get(before, (i / _BLOCK).cast("int"))
            + F.aggregate(F.slice(lengths, (i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK + 1), zero, add),
        ),
    )


def spans_of(text: Column, number: int) -> Column:
    """Array of (kind number, start, end, value) of one kind, code points, end exclusive.

    The pieces between the matches and the matches themselves give the place
    of each match as a running sum of lengths.
    """
    _, pattern, least = KINDS[number]
    whole = number not in (0, 3)
    kind = "array<struct<kind:int,start:bigint,end:bigint,value:string>>"
    if whole:  # a failing run holds no passing one, so short runs need no place
        pattern = pattern.replace("+)", f"{{{least - 4 * (number == 1)},}})")

    def placed(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        lengths = F.zip_with(gaps, matches, lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        ends = let(lengths, _running_ends)
        rows = F.zip_with(
            matches,
            ends,
            lambda m, end: F.struct(
                F.lit(number).alias("kind"),
                (end - F.length(m)).alias("start"),
                end.alias("end"),
                (m if whole else F.regexp_extract(m, pattern, 1)).alias("value"),
            ),
        )
        return F.filter(rows, lambda r: F.length(r["value"]) >= least).cast(kind)

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.when(F.size(m) == 0, F.array().cast(kind)).otherwise(placed(m)),
    )


def live_looking(value: Column) -> Column:
    """Letters and digits mixed, and no run that placeholders have (example, xxxx, changeme, 1234)."""
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & ~value.rlike(r"(?i)example|changeme|placeholder|your|dummy|xxxx|0000|12345")
        & (F.size(F.array_distinct(F.split(value, ""))) >= 6)
    )


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str) -> DataFrame:
    """One row per row of docs: its spans of every kind, its repository and that one's owner."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    repo = F.coalesce(F.col(repo_col).cast("string"), F.lit("")) if repo_col in docs.columns else F.lit("")
    return docs.select(
        ROW,
        F.col(id_col).alias("doc_id"),
        repo.alias("repo"),
        F.regexp_extract(repo, "^[^/]*", 0).alias("owner"),
        F.concat(*(spans_of(text, k) for k in range(len(KINDS)))).alias("spans"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """Owners and repositories of each value's hash, one row for each salt that its rows have.

    Three narrowing aggregates, each combined before its shuffle: a value that
    a third of all rows hold arrives as one row a task.
    """
    masks = [F.bit_or("mask_hi").alias("mask_hi"), F.bit_or("mask_lo").alias("mask_lo")]
    per_repo = found.groupBy("hash", "owner", "repo").agg(*salt_masks())
    per_owner = per_repo.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), *masks)
    return (
        per_owner.groupBy("hash")
        .agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"), *masks)
        .select("hash", "repos", "owners", masked_salts().alias("salt"))
    )


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "source",
    copied_owners: int = 3,
    copied_repos: int = 10,
) -> DataFrame:
    """Per row of `docs` (with `__row`): its spans and which values are owner-specific.

    Candidates of every kind are hashed and counted over the whole corpus by
    distinct repository (`repo_col`) and owner (the part before the first '/').
    A value that `copied_owners` or more owners hold is a widely copied example
    (`copied`) if it does not look live, or stands in `copied_repos` or more
    repositories; one that looks live and is not copied is `live`. Both flags
    join the spans by (hash, salt), so that a hot value is spread over tasks.

    Defined results: null text has no spans; a missing or null repository is
    ''; texts are scanned whole at any length; spans that start together come in
    the order of kinds; rows repeating an id are scanned each by itself; an
    empty table gives an empty table; other columns are ignored.
    """
    base = staged(candidates(docs, id_col, text_col, repo_col), "secrets")
    found = base.select(ROW, "repo", "owner", F.explode("spans").alias("s")).select(
        ROW,
        "repo",
        "owner",
        "s.kind",
        "s.start",
        "s.end",
        F.length("s.value").alias("size"),
        F.sha2("s.value", 256).alias("hash"),
        live_looking(F.col("s.value")).alias("lively"),
        salt_of(ROW).alias("salt"),
    )
    copied = (F.col("owners") >= copied_owners) & (~F.col("lively") | (F.col("repos") >= copied_repos))
    judged = found.join(ownership(found), ["hash", "salt"]).select(
        ROW,
        F.struct(
            F.col("start"),
            F.col("kind"),
            F.col("end"),
            F.col("size"),
            copied.alias("copied"),
            (F.col("lively") & ~copied).alias("live"),
        ).alias("span"),
    )
    per_row = judged.groupBy(ROW).agg(F.sort_array(F.collect_list("span")).alias("judged"))
    kept = base.select(ROW, "doc_id").join(per_row, ROW, "left")
    empty = F.array().cast(per_row.schema["judged"].dataType)
    return kept.select(ROW, "doc_id", F.coalesce("judged", empty).alias("judged"))


def span_report(spans: DataFrame) -> DataFrame:
    """doc_id, counts, digest of the base spans and the text of all spans."""
    names = F.array(*(F.lit(k) for k, _, _ in KINDS))
    line = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    base = F.array_join(F.transform(F.filter("judged", lambda s: s["kind"] < BASE), line), ",")
    count = lambda test: F.size(F.filter("judged", test)).cast("long")
    order = "struct<start:bigint,kind:int,text:string>"
    own = F.transform("judged", lambda s: F.struct(s["start"], s["kind"], line(s)).cast(order))
    live = F.transform(
        F.filter("judged", lambda s: s["live"]),
        lambda s: F.struct(
            s["end"] - s["size"],
            F.lit(len(KINDS)),
            F.concat_ws(":", F.lit(LIVE), (s["end"] - s["size"]).cast("string"), s["end"].cast("string")),
        ).cast(order),
    )
    return spans.select(
        "doc_id",
        count(lambda s: s["kind"] == 0).alias("n_assign"),
        count(lambda s: s["kind"] == 1).alias("n_access"),
        count(lambda s: s["kind"] == 2).alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"),
        F.array_join(
            F.transform(F.array_sort(F.array_distinct(F.concat(own, live))), lambda s: s["text"]), ","
        ).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: s["copied"]).alias("n_copied"),
    )


def merged_cuts(spans: DataFrame) -> DataFrame:
    """ROW and __cuts: the places of values that are not copied, spans that overlap or touch joined, in order."""
    cut = spans.select(ROW, F.explode("judged").alias("s")).where("not s.copied")
    cut = cut.select(ROW, (F.col("s.end") - F.col("s.size")).alias("start"), F.col("s.end").alias("end"))
    in_row = Window.partitionBy(ROW).orderBy("start", "end")
    before = F.max("end").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    apart = cut.withColumn("apart", F.coalesce((before < F.col("start")).cast("int"), F.lit(1)))
    return (
        apart.withColumn("part", F.sum("apart").over(in_row.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(ROW, "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(ROW)
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    )


def kept_parts(text: Column, cuts: Column) -> Column:
    """The parts of text before, between and after the ordered cuts (start, end): one more than there are cuts.

    The text comes in blocks, so that a part is found without counting signs
    from the text's start, and the work stays in proportion to the text.
    """
    size = 4096
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))

    def part(b: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / size).cast("int"), F.floor((end - 1) / size).cast("int")
        at = (start - first * size + 1).cast("int")
        within = F.substring(F.get(b, first), at, (end - start).cast("int"))
        over = F.concat(
            F.substring(F.get(b, first), at, F.lit(size)),
            F.array_join(F.slice(b, first + 2, last - first - 1), ""),
            F.substring(F.get(b, last), F.lit(1), (end - last * size).cast("int")),
        )
        return F.when(end <= start, F.lit("")).when(first == last, within).otherwise(over)

    zero = F.lit(0).cast("long")
    return let(
        blocks,
        lambda b: F.concat(
            F.transform(cuts, lambda s, i: part(b, F.when(i == 0, zero).otherwise(F.get(cuts, i - 1)["end"]), s["start"])),
            F.array(part(b, F.get(cuts, F.size(cuts) - 1)["end"], F.length(text).cast("long"))),
        ),
    )


def masked(text: Column, cuts: Column, mask: str) -> Column:
    """text with each of the ordered cuts (start, end) replaced by mask."""
    return F.array_join(kept_parts(text, cuts), mask)


def redacted(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", repo_col: str = "source", **options) -> DataFrame:
    """`docs` with the value of every span masked, but for widely copied examples. n_chars follows.

    Rows without such values are as they were; a column of docs named like one
    that is used on the way is kept. Other defined results are secret_spans()'s.
    """
    rows, own = set_aside(docs, ROW, "__cuts")
    new = {old: renamed for renamed, old in own.items()}
    rows = held_rows(rows)
    options["id_col"] = new.get(options.get("id_col", "doc_id"), options.get("id_col", "doc_id"))
    text_col = new.get(text_col, text_col)
    cuts = merged_cuts(secret_spans(rows, text_col=text_col, repo_col=new.get(repo_col, repo_col), **options))
    text = F.col(text_col)
    out = rows.join(cuts, ROW, "left").withColumn(
        text_col, F.when(F.col("__cuts").isNotNull(), masked(text, F.col("__cuts"), mask)).otherwise(text)
    )
    if "n_chars" in docs.columns:
        size = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars",
            F.when(F.col("__cuts").isNotNull(), F.length(text_col).cast(size)).otherwise(F.col("n_chars")),
        )
    return out.drop(ROW, "__cuts").withColumnsRenamed(own).select(*docs.columns)
