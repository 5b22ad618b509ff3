"""Recurring clean-up of course pages: lines and blocks filtered by what stands before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.markdown import lines_of


def numbered_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row a line: key, ix, line. The headings in force are in columns h1 to h4."""
    rows = df.select(key, F.posexplode(lines_of(F.col(text))).alias("ix", "line"))
    before = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.length(F.regexp_extract("line", r"^(#{1,6})\s+\S", 1))
    name = F.trim(F.regexp_extract("line", r"^#{1,6}\s+(.*)$", 1))
    for n in range(1, 5):
        mark = F.when(depth == n, F.struct(F.col("ix").alias("at"), name.alias("name")))
        above = F.when((depth > 0) & (depth < n), F.col("ix"))
        last = F.last(mark, ignorenulls=True).over(before)
        cut = F.coalesce(F.max(above).over(before), F.lit(-1))
        rows = rows.withColumn(f"h{n}", F.when(last["at"] > cut, last["name"]))
    return rows.withColumn("depth", depth)


def rejoined(lines: DataFrame, key: str, text: str) -> DataFrame:
    """The lines of each key in order, as one text again."""
    return lines.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", "line"))), lambda r: r["line"]), "\n").alias(text)
    )


def without_repeated_titles(lines: DataFrame, key: str) -> DataFrame:
    """Level-1 headings that repeat the title in force go."""
    before = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, -1)
    title = F.when(F.col("depth") == 1, F.lower(F.trim(F.regexp_extract("line", r"^#\s+(.*)$", 1))))
    marked = lines.withColumn("__l", F.last(title, ignorenulls=True).over(before))
    return marked.where(~F.coalesce((F.col("depth") == 1) & (title == F.col("__l")), F.lit(False))).drop("__l")


def without_empty_headings(lines: DataFrame, key: str) -> DataFrame:
    """Level-2 headings with nothing but blank lines up to the next heading of that level or above go, with those lines."""
    w = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    block = F.sum(((F.col("depth") > 0) & (F.col("depth") <= 2)).cast("int")).over(w)
    marked = lines.withColumn("__b", block)
    own = Window.partitionBy(key, "__b")
    body = F.max(((F.trim("line") != "") & ~F.col("depth").between(1, 2)).cast("int")).over(own)
    second = F.max((F.col("depth") == 2).cast("int")).over(own)
    return marked.withColumns({"__t": body, "__2": second}).where("not (`__2` = 1 and `__t` = 0)").drop("__b", "__t", "__2")


def only_blocks(lines: DataFrame, within: str, headings: list[str]) -> DataFrame:
    """Inside the level-2 section `within` only the level-3 and level-4 blocks named stay."""
    names = [h.lower() for h in headings]
    inside = F.lower(F.coalesce("h2", F.lit(""))) == within.lower()
    named = F.lower(F.coalesce("h3", F.lit(""))).isin(*names) | F.lower(F.coalesce("h4", F.lit(""))).isin(*names)
    return lines.where(~inside | named | ((F.col("depth") == 2) & inside))


def latest_year_block(lines: DataFrame, key: str, year: str = r"\b(20\d{2})[/-]\d{2}\b") -> DataFrame:
    """Of blocks that start with an academic year only the first of the latest year stays; lines before any stay."""
    w = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("depth") > 0, F.nullif(F.regexp_extract("line", year, 1), F.lit("")).cast("int"))
    marked = lines.withColumn("__y", F.last(own, ignorenulls=True).over(w)).withColumn("__s", F.last(F.when(own.isNotNull(), F.col("ix")), ignorenulls=True).over(w))
    all_ = Window.partitionBy(key)
    top = F.max("__y").over(all_)
    marked = marked.withColumn("__m", top)
    first = F.min(F.when(F.col("__y") == F.col("__m"), F.col("__s"))).over(all_)
    return marked.withColumn("__f", first).where("`__y` is null or `__s` = `__f`").drop("__y", "__s", "__m", "__f")


def latest_year_in_place(lines: DataFrame, key: str, heading: str, ends: str = r"^###\s") -> DataFrame:
    """Of blocks whose heading matches (group 1: the year) those of the latest year stay; lines outside of blocks stay where they are.

    A block ends at the next such heading or at a line that matches `ends`. A
    text with one block or none is as it was.
    """
    w = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    year = F.nullif(F.regexp_extract(F.trim("line"), heading, 1), F.lit("")).cast("int")
    mark = F.when(year.isNotNull(), year).when(F.col("line").rlike(ends), F.lit(0))  # 0: outside of any block
    marked = lines.withColumn("__y", F.nullif(F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit(0)), F.lit(0)))
    return marked.withColumn("__m", F.max("__y").over(Window.partitionBy(key))).where("`__y` is null or `__y` = `__m`").drop("__y", "__m")


def route_blocks(text: Column, heading: str, routes: list[tuple[str, str]], default: str) -> Column:
    """Map of a page's entry routes: the key of each route heading to its block, the heading included.

    heading: pattern of a route's heading (group 1: its label); routes: (key,
    pattern of the label), the first that fits; a heading without a label is
    `default`. A block ends at the next heading of level 2. Of two blocks with
    one key the last counts.
    """
    lines = lines_of(text)
    label = lambda x: F.lower(F.trim(F.regexp_extract(x, heading, 1)))
    key = lambda x: F.coalesce(*(F.when(label(x).rlike(p), k) for k, p in routes), F.when(label(x) == "", default), F.lit(routes[-1][0]))
    kind = "struct<key:string,lines:array<string>>"
    start = F.struct(F.lit("").alias("at"), F.array().cast(f"array<{kind}>").alias("done"), F.array().cast("array<string>").alias("open"))

    def close(s: Column) -> Column:
        block = F.struct(s["at"].alias("key"), s["open"].alias("lines")).cast(kind)
        return F.when(s["at"] != "", F.concat(s["done"], F.array(block))).otherwise(s["done"])

    def step(s: Column, x: Column) -> Column:
        begins, ends = x.rlike(heading), F.startswith(x, F.lit("## "))
        fresh = F.struct(key(x).alias("at"), close(s).alias("done"), F.array(x).alias("open"))
        over = F.struct(F.lit("").alias("at"), close(s).alias("done"), F.array().cast("array<string>").alias("open"))
        more = F.struct(s["at"], s["done"], F.when(s["at"] != "", F.concat(s["open"], F.array(x))).otherwise(s["open"]).alias("open"))
        return F.when(begins, fresh).when(ends, over).otherwise(more)

    blocks = F.aggregate(lines, start, step, close)
    keys = F.array_distinct(F.transform(blocks, lambda b: b["key"]))
    last = lambda k: F.element_at(F.filter(blocks, lambda b: b["key"] == k), -1)["lines"]
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.trim(F.array_join(last(k), "\n")).alias("value"))))


def picked_route(routes: Column, level: Column, fallback: Column, legacy: Column) -> Column:
    """The block of a level; for other levels that of the fallback key, else the first; the legacy section where a page has no routes."""
    named = level.isin("foundation", "undergraduate")
    first = F.get(F.map_values(routes), 0)
    other = F.coalesce(F.try_element_at(routes, fallback), first, F.lit(""))
    return F.when(F.size(routes) == 0, F.coalesce(legacy, F.lit(""))).when(named, F.coalesce(F.try_element_at(routes, level), F.lit(""))).otherwise(other)


def until_marker(lines: DataFrame, key: str, off: str, on: str) -> DataFrame:
    """Lines from one that matches `off` until one that matches `on` go."""
    w = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("line").rlike(on), F.lit(1)).when(F.col("line").rlike(off), F.lit(0))
    return lines.withColumn("__k", F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit(1))).where("`__k` = 1").drop("__k")


def carried_rows(lines: DataFrame, key: str, header: str, drop: str) -> DataFrame:
    """Table rows whose category, carried from the last row that matches `header`, does not match `drop`."""
    w = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    own = F.nullif(F.regexp_extract("line", header, 0), F.lit(""))
    return (
        lines.withColumn("category", F.last(own, ignorenulls=True).over(w))
        .where(F.coalesce(~F.col("category").rlike(drop), F.lit(True)))
    )


def first_per_year(lines: DataFrame, key: str, year: str = r"\b(20\d{2})\b", amount: str = r"£([\d,]+)") -> DataFrame:
    """(key, year, amount): the first amount of each year that rows carry from the last line naming one."""
    w = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    named = F.nullif(F.regexp_extract("line", year, 1), F.lit(""))
    rows = lines.select(
        key, "ix", F.last(named, ignorenulls=True).over(w).alias("year"), F.nullif(F.regexp_extract("line", amount, 1), F.lit("")).alias("amount")
    ).where("year is not null and amount is not null")
    return rows.groupBy(key, "year").agg(F.min_by("amount", "ix").alias("amount"))


def label_values(text: Column) -> Column:
    """Map of `**Label:** value` and `- Label: value` lines; a later one wins."""
    p = r"(?m)^\s*(?:-\s*)?\**([A-Za-z][A-Za-z /]{1,40}):\**\s*([^\n]+)$"
    pairs = F.zip_with(
        F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(1)), F.lower),
        F.regexp_extract_all(text, F.lit(p), F.lit(2)),
        lambda k, v: F.struct(F.trim(k).alias("key"), F.trim(v).alias("value")),
    )
    keys = F.array_distinct(F.transform(pairs, lambda s: s["key"]))
    return F.map_from_entries(
        F.transform(
            keys,
            lambda k: F.struct(k.alias("key"), F.element_at(F.filter(pairs, lambda s: s["key"] == k), -1)["value"].alias("value")),
        )
    )


def first_label(labels: Column, *names: str) -> Column:
    return F.coalesce(*(F.nullif(labels[n.lower()], F.lit("")) for n in names), F.lit(""))


def ielts_line(text: Column) -> Column:
    """Any IELTS sentence in one wording; other text as it is."""
    p = r"(?is)IELTS[^0-9]*(\d(?:\.\d)?)[^0-9]+(\d(?:\.\d)?)"
    overall, least = F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2)
    put = F.concat(F.lit("IELTS "), overall, F.lit(" overall with no individual band below "), least)
    return F.when(overall != "", put).otherwise(text)


def without_tail(text: Column, marker: str) -> Column:
    return F.trim(F.regexp_replace(text, rf"(?s)\n[^\n]*{marker}.*$", ""))


def title_to(text: Column, heading: str) -> Column:
    """Everything between the title line and the first matching heading goes."""
    return F.regexp_replace(text, rf"(?is)\A(#\s[^\n]*\n).*?(?=^##\s+{heading})".replace("(?is)", "(?ism)"), "$1\n")


def pick_variant(df: DataFrame, key: str, wishes: list[list[Column]], order: list[Column]) -> DataFrame:
    """Of the variants of each key the one that meets the first list of wishes any meets, then by `order`."""
    tier = F.lit(len(wishes))
    for k, tests in reversed(list(enumerate(wishes))):
        met = F.lit(True)
        for t in tests:
            met = met & t
        tier = F.when(met, k).otherwise(tier)
    w = Window.partitionBy(key).orderBy(tier, *order)
    return df.withColumn("__n", F.row_number().over(w)).where("`__n` = 1").drop("__n")


def variant_rows(df: DataFrame, modes: str, starts: str) -> DataFrame:
    """One row a mode of study and start date of a page; pages without either keep a row with nulls."""
    return df.withColumn("mode", F.explode_outer(modes)).withColumn("start", F.explode_outer(starts))


def level_rows(df: DataFrame, level: str, is_foundation: Column) -> DataFrame:
    """An undergraduate page that also offers a foundation year becomes two rows."""
    both = F.when((F.col(level) == "undergraduate") & is_foundation, F.array(F.lit("undergraduate"), F.lit("foundation"))).otherwise(
        F.array(F.col(level))
    )
    return df.withColumn(level, F.explode(both))
