"""Personal data by patterns, and terms that reveal it by corpus co-occurrence, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.exact_dedup import ROW, held_rows
from lodestone.llm.secret_scan import _running_ends, kept_parts
from lodestone.llm.shared import ascii_lower, let, masked_salts, salt_masks, salt_of, set_aside, staged

#: kind and pattern. A match that the contract's plain pattern would find at the same place, without its backtracking:
#: runs are taken whole, and none starts inside a run that has failed.
KINDS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?[0-9]){11,}+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
GENERAL, REMOVED = "general", "remove"
#: A term: a run of letters, A-Z lower-cased.
TERM = r"\p{L}{4,}"
#: Code points before and after an entity whose terms stand with it.
WINDOW = 64
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _valid(kind: int, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if KINDS[kind][0] == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if KINDS[kind][0] == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if KINDS[kind][0] == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _entity(kind: int, match: Column) -> Column:
    """What names the protected entity: the digits, or the address in lower case."""
    name = KINDS[kind][0]
    plain = ascii_lower(match) if name == "email" else match if name == "ip" else F.regexp_replace(match, "[^0-9]", "")
    return F.xxhash64(F.lit(kind), plain)


def spans_of(text: Column, kind: int, window: int) -> Column:
    """Array of (kind number, start, end, entity, text before, text after, whether each is cut off), code points, end exclusive.

    The text before and after reaches to the neighbouring match of the kind at most.
    """
    pattern = KINDS[kind][1]
    shape = (
        "array<struct<kind:int,start:bigint,end:bigint,entity:bigint,before:string,after:string,cut_before:boolean,cut_after:boolean>>"
    )

    def placed(matches: Column) -> Column:
        def spans(gaps: Column) -> Column:
            lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: (F.length(g) + F.length(m)).cast("long"))
            around = F.transform(
                gaps,
                lambda g: F.struct(
                    F.length(g).alias("size"),
                    F.right(g, F.lit(window)).alias("last"),
                    F.left(g, F.lit(window)).alias("first"),
                ),
            )
            return let(
                lengths,
                lambda n: let(
                    around,
                    lambda w: F.zip_with(
                        F.zip_with(matches, _running_ends(n), lambda m, end: F.struct(m.alias("m"), end.alias("end"))),
                        F.sequence(F.lit(0), F.size(matches) - 1),
                        lambda s, i: F.struct(
                            F.lit(kind).alias("kind"),
                            (s["end"] - F.length(s["m"])).alias("start"),
                            s["end"].alias("end"),
                            _entity(kind, s["m"]).alias("entity"),
                            F.get(w, i)["last"].alias("before"),
                            F.get(w, i + 1)["first"].alias("after"),
                            (F.get(w, i)["size"] > window).alias("cut_before"),
                            (F.get(w, i + 1)["size"] > window).alias("cut_after"),
                            _valid(kind, s["m"]).alias("valid"),
                        ),
                    ),
                ),
            )

        found = F.filter(let(F.split(text, pattern, -1), spans), lambda s: s["valid"])
        return F.transform(
            found, lambda s: F.struct(*(s[c].alias(c) for c in ("kind", "start", "end", "entity", "before", "after", "cut_before", "cut_after")))
        ).cast(shape)

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.when(F.size(m) == 0, F.array().cast(shape)).otherwise(placed(m)),
    )


def _terms(window: Column, at: Column, cut_first: Column, cut_last: Column) -> Column:
    """Array of (term, start, end) of a stretch of text that begins at `at`; terms cut off at its ends are left out."""
    shape = "array<struct<term:bigint,start:bigint,end:bigint>>"

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(window, TERM, -1), F.lit(1), F.size(found))
        lengths = F.zip_with(gaps, found, lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        rows = F.zip_with(
            found,
            let(lengths, _running_ends),
            lambda m, end: F.struct(
                F.xxhash64(ascii_lower(m)).alias("term"), (at + end - F.length(m)).alias("start"), (at + end).alias("end")
            ),
        )
        inner = lambda t: (~cut_first | (t["start"] > at)) & (~cut_last | (t["end"] < at + F.length(window)))
        return F.filter(rows, inner).cast(shape)

    return let(
        F.regexp_extract_all(window, F.lit(TERM), F.lit(0)),
        lambda m: F.when(F.size(m) == 0, F.array().cast(shape)).otherwise(placed(m)),
    )


def _beside(rows: DataFrame, table: DataFrame, key: str, by: str) -> DataFrame:
    """rows with table's columns of the same key, a row of table spread over the salts that the key's rows have."""
    salted = rows.withColumn("salt", salt_of(by))
    wanted = salted.groupBy(key).agg(*salt_masks())
    spread = table.join(wanted, key).withColumn("salt", masked_salts()).drop("mask_hi", "mask_lo")
    return salted.join(spread, [key, "salt"]).drop("salt")


def disclosures(found: DataFrame, texts: DataFrame, least: int, general: float, removed: float) -> DataFrame:
    """entity, term and level (GENERAL or REMOVED) of terms that reveal an entity, a row for each salt that their places have.

    found: row, entity, term, context and salt of each term that stands with
    an entity; texts: every row's whole text. With N rows, of which n_c hold
    the entity, n_t the term and n_ct the term beside the entity, the entity's
    information is IC = log2(N / n_c) and the term tells
    PMI = log2(N n_ct / (n_c n_t)) of it, the share PMI / IC.
    """
    rows = texts.count()
    once = found.groupBy("entity", "term", ROW).agg(F.min("context").alias("context"), *salt_masks())
    masks = [F.bit_or("mask_hi").alias("mask_hi"), F.bit_or("mask_lo").alias("mask_lo")]
    per_context = once.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n_ct"), *masks)
    pairs = staged(
        per_context.groupBy("entity", "term")
        .agg(F.sum("n_ct").alias("n_ct"), F.count(F.lit(1)).alias("contexts"), *masks)
        .where(F.col("contexts") >= least),
        "pairs",
    )
    n_c = found.groupBy("entity", ROW).agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    said = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda m: F.xxhash64(ascii_lower(m))))
    n_t = texts.select(F.explode(said).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    named = pairs.withColumnsRenamed({"mask_hi": "hi", "mask_lo": "lo"})
    judged = _beside(_beside(named, n_c, "entity", "term"), n_t, "term", "entity")
    share = 1 - F.log2(F.col("n_t") / F.col("n_ct")) / F.log2(F.lit(rows) / F.col("n_c"))
    return (
        judged.where(F.col("n_c") < rows)
        .select("entity", "term", share.alias("share"), F.col("hi").alias("mask_hi"), F.col("lo").alias("mask_lo"))
        .where(F.col("share") >= general)
        .select("entity", "term", F.when(F.col("share") >= removed, REMOVED).otherwise(GENERAL).alias("level"), masked_salts().alias("salt"))
    )


def private_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    least_contexts: int = 2,
    general: float = 0.75,
    removed: float = 0.9,
) -> DataFrame:
    """Per row of `docs` (with `__row`): doc_id, its base spans and the spans of terms that reveal what they protect.

    Base spans come from the patterns of KINDS. Each is a protected entity (the
    address, or the digits). A term within `window` code points of an entity
    reveals it to the share of the entity's information content that their
    pointwise mutual information over the whole corpus makes up, counted in
    rows; from `general` on its places beside the entity are to be generalised,
    from `removed` on removed. It takes at least `least_contexts` different
    surroundings, so that copies of one text are no evidence. Places join their
    verdict by (entity, term, salt), so that an entity of a third of all rows is
    spread over tasks.

    Defined results: null text has no spans; texts are scanned whole at any
    length; spans that start together come in the order of kinds; terms inside
    a base span have none of their own; a term beside two entities takes the
    stronger verdict; repeated rows are scanned and counted each; an empty table
    gives an empty table; other columns are ignored.
    """
    texts = docs.select(ROW, F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spans = F.concat(*(spans_of(F.col("text"), k, window) for k in range(len(KINDS))))
    base = staged(texts.select(ROW, "doc_id", spans.alias("spans")), "private")
    each = base.select(ROW, F.explode("spans").alias("s"))
    near = F.concat(
        _terms(F.col("s.before"), F.col("s.start") - F.length("s.before"), F.col("s.cut_before"), F.lit(False)),
        _terms(F.col("s.after"), F.col("s.end"), F.lit(False), F.col("s.cut_after")),
    )
    found = staged(
        each.select(ROW, F.col("s.entity").alias("entity"), F.xxhash64("s.before", "s.after").alias("context"), F.explode(near).alias("t")).select(
            ROW, "entity", "context", "t.term", "t.start", "t.end", salt_of(ROW).alias("salt")
        ),
        "terms",
    )
    verdicts = disclosures(found, texts, least_contexts, general, removed)
    told = found.join(verdicts, ["entity", "term", "salt"]).select(ROW, F.struct("start", "end", "level").alias("t"))
    told = told.groupBy(ROW).agg(F.collect_set("t").alias("told"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,level:string>>")
    kept = base.join(told, ROW, "left").select(
        ROW,
        "doc_id",
        F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["end"]))).alias("base"),
        F.coalesce("told", none).alias("told"),
    )
    free = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"]))
    strongest = lambda t: (t["level"] == REMOVED) | ~F.array_contains("told", F.struct(t["start"], t["end"], F.lit(REMOVED).alias("level")))
    return kept.select(ROW, "doc_id", "base", F.array_sort(F.filter("told", lambda t: free(t) & strongest(t))).alias("told"))


def span_report(spans: DataFrame) -> DataFrame:
    """doc_id, counts, digest of the base spans, the text of all spans, and how many are to be generalised and removed."""
    names = F.array(*(F.lit(k) for k, _ in KINDS), F.lit(GENERAL), F.lit(REMOVED))
    line = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    told = lambda level: F.size(F.filter("told", lambda t: t["level"] == level)).cast("long")
    number = lambda t: F.when(t["level"] == GENERAL, len(KINDS)).otherwise(len(KINDS) + 1)
    more = F.transform("told", lambda t: F.struct(t["start"], number(t).alias("kind"), t["end"]).cast("struct<start:bigint,kind:int,end:bigint>"))
    return spans.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, (name, _) in enumerate(KINDS)),
        F.sha2(F.array_join(F.transform("base", line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(F.array_sort(F.concat("base", more)), line), ",").alias("spans"),
        told(GENERAL).alias("n_general"),
        told(REMOVED).alias("n_removed"),
    )


def sanitised(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """`docs` with personal data replaced by its kind ([EMAIL]), revealing terms generalised to [TERM] or removed. n_chars follows.

    Spans that overlap are one, named by the first. Rows without spans are as
    they were; a column of docs named like one that is used on the way is kept.
    Other defined results are private_spans()'s.
    """
    rows, own = set_aside(docs, ROW, "__cuts")
    new = {old: renamed for renamed, old in own.items()}
    rows, text_col, id_col = held_rows(rows), new.get(text_col, text_col), new.get(id_col, id_col)
    spans = private_spans(rows, id_col, text_col, **options)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k, _ in KINDS))
    masks = F.concat(
        F.transform("base", lambda s: F.struct(s["start"], s["end"], F.get(names, s["kind"]).alias("mask"))),
        F.transform("told", lambda t: F.struct(t["start"], t["end"], F.when(t["level"] == GENERAL, "[TERM]").otherwise("").alias("mask"))),
    )
    cut = spans.select(ROW, F.explode(masks).alias("s")).select(ROW, "s.start", "s.end", "s.mask")
    in_row = Window.partitionBy(ROW).orderBy("start", "end", "mask")
    before = F.max("end").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    apart = cut.withColumn("apart", F.coalesce((before <= F.col("start")).cast("int"), F.lit(1)))
    cuts = (
        apart.withColumn("part", F.sum("apart").over(in_row.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(ROW, "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.struct("start", "end", "mask"))["mask"].alias("mask"))
        .groupBy(ROW)
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "mask"))).alias("__cuts"))
    )
    text, at = F.col(text_col), F.col("__cuts")
    parts = let(
        kept_parts(text, at),
        lambda p: F.concat(
            F.array_join(F.zip_with(F.slice(p, F.lit(1), F.size(at)), at, lambda kept, s: F.concat(kept, s["mask"])), ""), F.get(p, F.size(at))
        ),
    )
    out = rows.join(cuts, ROW, "left").withColumn(text_col, F.when(at.isNotNull(), parts).otherwise(text))
    if "n_chars" in docs.columns:
        size = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(at.isNotNull(), F.length(text_col).cast(size)).otherwise(F.col("n_chars")))
    return out.drop(ROW, "__cuts").withColumnsRenamed(own).select(*docs.columns)
