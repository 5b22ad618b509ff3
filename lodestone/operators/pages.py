"""What course pages say, read from their element trees: links with their surroundings, sections, modes of study, programmes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import html as html_
from lodestone.functions import text
from lodestone.functions import tree as tree_

#: Parts of class names of list items and of menus, and what they weigh. Fixed values.
LIST_HINTS = ("result", "course", "programme", "program", "listing", "card", "teaser", "views-row", "a-z", "catalogue", "catalog", "item")
MENU_HINTS = ("menu", "nav", "footer", "header", "breadcrumb", "social", "cookie")
#: Parts of class names that a chosen selector should have. Fixed values.
ROW_HINTS = ("item", "row", "card", "result", "course", "teaser")


def links(pages: DataFrame, key: str, html: str, base: str, most: int = 8, longest: int = 120) -> DataFrame:
    """One row for each different address on a page's own domain, as its first anchor has it.

    Columns: key, url (without query and fragment, no slash at its end), path,
    text (its first `longest` signs) and classes (of the `most` elements around
    the anchor, from the nearest outwards, as selectors).

    Defined results: anchors without an address, to a place on the page or to a
    script are left out; a page without links has no rows; a null page or
    address has none.
    """
    t = F.col("__tree")
    anchors = F.transform(
        tree_.select(t, "a[href]"),
        lambda e: F.struct(
            e["no"].alias("no"),
            F.trim(F.element_at(e["attrs"], "href")).alias("href"),
            F.left(tree_.text_of(t, e), F.lit(longest)).alias("text"),
            F.flatten(F.transform(tree_.ancestors(t, e, most), lambda a: F.filter(a["classes"], lambda c: F.length(c) < 80))).alias("classes"),
        ),
    )
    rows = pages.select(F.col(key).alias("key"), F.col(base).alias("base"), tree_.tree(F.col(html)).alias("__tree"))
    rows = rows.select("key", "base", F.explode(anchors).alias("a")).select("key", "base", "a.*")
    rows = rows.where("href <> '' and href not like '#%' and lower(href) not like 'javascript:%'")
    host = lambda url: F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1))
    rows = rows.withColumn("to", html_.absolute(F.col("href"), F.col("base"))).where((host(F.col("to")) == host(F.col("base"))) & (host(F.col("to")) != ""))
    path = F.regexp_extract("to", r"^[^/?#]*//[^/?#]*([^?#]*)", 1)
    path = F.when(F.rtrim(path, F.lit("/")) == "", "/").otherwise(F.rtrim(path, F.lit("/")))
    url = F.concat(F.regexp_extract("to", r"^([^/?#]*//[^/?#]*)", 1), path)
    one = rows.select("key", "no", url.alias("url"), path.alias("path"), "text", F.transform("classes", lambda c: F.concat(F.lit("."), c)).alias("classes"))
    first = one.groupBy("key", "url").agg(F.min_by(F.struct("path", "text", "classes"), "no").alias("x"))
    return first.select("key", "url", "x.path", "x.text", "x.classes")


def selector_quality(selector: Column) -> Column:
    """1, and 2 more for the name of a list's item, 3 less for that of a menu, ½ less for a script's hook."""
    lower = F.lower(selector)
    has = lambda hints: text_any(lower, hints)
    hook = F.contains(lower, F.lit("js-")) & ~has(("result", "course"))
    return 1.0 + F.when(has(LIST_HINTS), 2.0).otherwise(0.0) - F.when(has(MENU_HINTS), 3.0).otherwise(0.0) - F.when(hook, 0.5).otherwise(0.0)


def text_any(value: Column, parts: tuple[str, ...]) -> Column:
    return value.rlike("|".join(p.replace("-", r"\-") for p in parts))


def link_selectors(found: DataFrame, is_course: Column, least: int) -> DataFrame:
    """Score of each selector around the links of a page to its courses, and which one to choose.

    found: rows of links(). Columns: key, selector, hits, others (its links that
    are no courses), coverage (hits / the page's course links), purity (hits /
    its links), score = hits * quality + 20 coverage + 30 purity, place (by
    score, then name, downwards) and chosen: of the first 15 the first that
    names a row and holds half of the course links, else the first. Selectors
    with fewer than max(2, least / 2) hits, and pages with so few, have no rows.
    """
    bound = max(2, least // 2)
    marked = found.withColumn("hit", F.coalesce(is_course, F.lit(False)).cast("int"))
    total = marked.groupBy("key").agg(F.sum("hit").alias("total")).where(F.col("total") >= bound)
    each = marked.select("key", "hit", F.explode("classes").alias("selector"), F.monotonically_increasing_id().alias("link"))
    once = each.groupBy("key", "selector", "link").agg(F.max("hit").alias("hit"), F.count(F.lit(1)).alias("times"))
    sums = once.groupBy("key", "selector").agg(
        F.sum(F.col("hit") * F.col("times")).alias("hits"), F.sum(1 - F.col("hit")).alias("others")
    )
    hits, others = F.col("hits"), F.col("others")
    scored = (
        sums.where(hits >= bound)
        .join(total, "key")
        .withColumn("coverage", hits / F.col("total"))
        .withColumn("purity", hits / F.greatest(hits + others, F.lit(1)))
        .withColumn("score", hits * selector_quality(F.col("selector")) + F.col("coverage") * 20 + F.col("purity") * 30)
    )
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.desc("selector"))
    placed = scored.withColumn("place", F.row_number().over(order))
    fits = (F.col("place") <= 15) & text_any(F.lower("selector"), ROW_HINTS) & (hits >= F.greatest(F.lit(2), F.floor(F.col("total") * 0.5)))
    best = F.coalesce(F.min(F.when(fits, F.col("place"))).over(Window.partitionBy("key")), F.lit(1))
    return placed.withColumn("chosen", F.col("place") == best).select(
        "key", "selector", "hits", "others", "coverage", "purity", "score", "place", "chosen"
    )


#: Where pages name the kind of a course. Configuration; these are the defaults.
KIND_SELECTORS = (".field--name-field-course-type .field--item", "[class*='course-type'] .field--item")
#: Labels that stand before a mode of study.
MODE_LABELS = ("mode", "mode of study", "study", "study mode")


@dataclass
class Study:
    """Columns of what a page says about how a course is studied."""

    kind: Column
    options: Column
    modes: Column


def study_of(tree: Column, kinds: tuple[str, ...] = KIND_SELECTORS, root: str = "#key-course-details", labels: tuple[str, ...] = MODE_LABELS) -> Study:
    """The course's kind (first selector with a text), the line after `Study options` (inside root, else on the page), and
    every value of the labels, from terms, tables and pairs of elements, repeated ones once."""
    kind = F.nullif(tree_.text_of(tree, tree_.first(tree, list(kinds), least=1)), F.lit(""))
    whole = F.transform(F.filter(tree["nodes"], lambda e: e["text"].isNotNull()), lambda e: e["text"])
    said = F.coalesce(tree_.lines(tree, F.get(tree_.select(tree, root), 0)), whole)
    place = lambda lines: F.array_position(F.transform(lines, lambda x: F.lower(x)), "study options")
    options = tree_.bind(said, lambda x: tree_.bind(place(x), lambda at: F.when(at > 0, F.get(x, at.cast("int")))))
    modes = F.filter(tree_.labelled(tree), lambda p: F.lower(F.rtrim(F.trim(p["label"]), F.lit(":"))).isin(*labels))
    return Study(kind, options, F.array_distinct(F.transform(modes, lambda p: p["value"])))


def excluded(study: Study, url: Column, kinds: list[str], urls: list[str]) -> Column:
    """Whether a page is to be left out: by its address, its kind, or as one that is studied part-time only.

    A pattern is exact, `p*`, `*s` or `*c*`. Part-time pages go only if a
    pattern of kinds fits `part-time`; then by their options, or where there
    are modes and each is part-time only.
    """
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    any_of = lambda value, patterns: F.greatest(F.lit(False), F.lit(False), *(F.coalesce(text.wildcard(value, p), F.lit(False)) for p in patterns))
    part_time = any_of(F.lit("part-time"), kinds)
    only = (F.size(study.modes) > 0) & F.forall(study.modes, text.part_time_only)
    return (
        any_of(path, urls)
        | any_of(F.coalesce(study.kind, F.lit("")), kinds) & study.kind.isNotNull()
        | part_time & (text.part_time_only(study.options) | F.coalesce(only, F.lit(False)))
    )


@dataclass(frozen=True)
class Layout:
    """Where a kind of page keeps its sections. Selectors are tried in order; '' means that pages have none.

    blocks: (heading, selectors) of each block; `least` signs make one.
    accordion, its title and body; tabs, the container of tab panels; panel;
    options: a list of terms inside a panel that is all that counts there;
    dropped: what is cut out of every text.
    """

    blocks: tuple[tuple[str, tuple[str, ...]], ...]
    titles: tuple[str, ...] = ("h1",)
    accordion: str = ""
    accordion_title: str = "button, h2, h3, h4"
    accordion_body: str = ""
    tabs: str = ""
    panel: str = "[role=tabpanel]"
    options: str = ""
    dropped: str = "script, style"
    least: int = 20
    levels: dict = field(default_factory=lambda: {"accordion": 3, "tab": 4})


def _panel_title(tree: Column, panel: Column) -> Column:
    """Text of the tab that a panel names, else of the control that names the panel, else of the heading right before it."""
    own = tree_.by_id(tree, F.try_element_at(panel["attrs"], F.lit("aria-labelledby")))
    controls = F.filter(
        tree["nodes"],
        lambda e: (F.try_element_at(e["attrs"], F.lit("aria-controls")) == panel["id"])
        | (F.try_element_at(e["attrs"], F.lit("href")) == F.concat(F.lit("#"), panel["id"])),
    )
    heading = tree_.bind(tree_.node(tree, panel["prior"]), lambda e: F.when(e["tag"].rlike("^h[1-6]$"), tree_.text_of(tree, e)))
    texts = (tree_.text_of(tree, own), tree_.text_of(tree, F.get(controls, 0)), heading)
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in texts), F.lit(""))


def sections(pages: DataFrame, key: str, html: str, layout: Layout) -> DataFrame:
    """Sections of each page's blocks, one row each, in the order of the page, what stands around them last.

    Columns: key, block (number), heading, place, kind (accordion, tab, rest),
    title, body (markdown). A tab finds its title by the page's index of ids.
    Tabs inside an accordion follow its row, whose body is what they leave.

    Defined results: a block that no selector finds with `least` signs has no
    rows, nor has a section without a body; panels inside a panel belong to its
    body; a null page has none.
    """
    t, page = F.col("__tree"), F.col("__html")
    empty = F.slice(t["nodes"], F.lit(1), F.lit(0))
    among = lambda selector, root: tree_.select(t, selector, root) if selector else empty
    bind = tree_.bind

    def row(at: Column, kind: str, title: Column, source: Column, said: Column | None = None) -> Column:
        return F.struct(
            at.alias("place"),
            F.lit(kind).alias("kind"),
            title.alias("title"),
            source.alias("source"),
            (F.lit(None).cast("string") if said is None else said).alias("said"),
        )

    def terms(listed: Column) -> Column:
        lines = F.transform(tree_.labelled(t, listed), lambda p: F.concat(F.lit("- **"), p["label"], F.lit(":** "), p["value"]))
        return F.nullif(F.array_join(lines, "\n"), F.lit(""))

    def tab(panel: Column) -> Column:
        said = bind(tree_.first(t, layout.options, panel), terms) if layout.options else None
        return row(panel["no"], "tab", _panel_title(t, panel), tree_.without(page, panel, among(layout.dropped, panel)), said)

    def item(e: Column) -> Column:
        def of(title: Column, body: Column) -> Column:
            own = F.filter(among(layout.accordion_title, body), lambda x: x["no"] == title["no"])
            cut = F.concat(among(layout.tabs, body), among(layout.dropped, body), own)
            return row(e["no"], "accordion", tree_.text_of(t, title), tree_.without(page, body, F.array_sort(cut, _by_no)))

        body = tree_.first(t, layout.accordion_body, e) if layout.accordion_body else e
        return bind(tree_.first(t, layout.accordion_title, e), lambda title: bind(body, lambda b: of(title, b)))

    def parts(e: Column) -> Column:
        items = bind(among(layout.accordion, e), tree_.outermost)
        panels = bind(among(layout.panel, e), tree_.outermost) if layout.tabs else empty
        cut = F.concat(among(layout.accordion, e), among(layout.tabs, e), among(layout.dropped, e))
        rest = row(e["last"] + 1, "rest", F.lit(""), tree_.without(page, e, F.array_sort(cut, _by_no)))
        return F.when(e.isNotNull(), F.concat(F.transform(items, item), F.transform(panels, tab), F.array(rest)))

    def block(number: int, heading: str, selectors: tuple[str, ...]) -> Column:
        found = bind(tree_.first(t, list(selectors), least=layout.least), parts)
        return F.transform(found, lambda p: F.struct(F.lit(number).alias("block"), F.lit(heading).alias("heading"), p.alias("part")))

    blocks = [block(n, heading, selectors) for n, (heading, selectors) in enumerate(layout.blocks)]
    shape = "array<struct<block:int,heading:string,part:struct<place:int,kind:string,title:string,source:string,said:string>>>"
    rows = pages.select(F.col(key).alias("key"), F.col(html).alias("__html"), tree_.tree(F.col(html)).alias("__tree"))
    each = rows.select("key", F.explode(F.flatten(F.array(*(F.coalesce(b.cast(shape), F.array().cast(shape)) for b in blocks)))).alias("x"))
    flat = each.select("key", "x.block", "x.heading", "x.part.*")
    body = F.trim(F.coalesce("said", html_.to_markdown(F.when(F.col("said").isNull(), F.col("source")))))
    read = flat.select("key", "block", "heading", "place", "kind", "title", body.alias("body"))
    # a row for each body that is not blank: a plain filter would be pushed below, and every body read twice
    return read.select("key", "block", "heading", "place", "kind", "title", F.explode(F.filter(F.array("body"), lambda b: b != "")).alias("body"))


def _by_no(a: Column, b: Column) -> Column:
    return F.when(a["no"] < b["no"], -1).when(a["no"] > b["no"], 1).otherwise(0)


def sections_markdown(found: DataFrame, layout: Layout) -> DataFrame:
    """key and markdown: the rows of sections() put together, a heading for each block, accordion and tab."""
    level = F.create_map(*(F.lit(x) for pair in layout.levels.items() for x in pair))
    mark = F.concat(F.repeat(F.lit("#"), F.coalesce(F.try_element_at(level, F.col("kind")), F.lit(0))), F.lit(" "))
    said = F.when((F.col("kind") == "rest") | (F.col("title") == ""), F.col("body")).otherwise(F.concat(mark, "title", F.lit("\n\n"), "body"))
    parts = found.groupBy("key", "block", "heading").agg(F.array_sort(F.collect_list(F.struct("place", said.alias("said")))).alias("parts"))
    whole = F.concat(F.lit("## "), "heading", F.lit("\n\n"), F.array_join(F.transform("parts", lambda p: p["said"]), "\n\n"))
    blocks = parts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", whole.alias("said")))).alias("blocks"))
    return blocks.select("key", F.array_join(F.transform("blocks", lambda b: b["said"]), "\n\n").alias("markdown"))


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Rows of every table: key, table (number on the page), row and values by column, of cells spread over all that they span.

    Columns: key, table, row, header (all its cells are th), values. A page
    without tables has no rows; places that no cell covers are ''.
    """
    t = F.col("__tree")
    rows = pages.select(F.col(key).alias("key"), tree_.tree(F.col(html)).alias("__tree"))
    cells = rows.select(
        "key",
        F.explode(F.transform(t["cells"], lambda c: F.struct(c["table"], c["row"], c["col"], c["header"], tree_.text_of(t, tree_.node(t, c["no"])).alias("text")))).alias("c"),
    ).select("key", "c.*")
    each = cells.groupBy("key", "table", "row").agg(
        F.every("header").alias("header"), F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("by"), F.max("col").alias("width")
    )
    values = F.transform(F.sequence(F.lit(0), F.col("width")), lambda c: F.coalesce(F.try_element_at("by", c), F.lit("")))
    numbered = F.dense_rank().over(Window.partitionBy("key").orderBy("table")) - 1
    return each.select("key", numbered.alias("table"), "row", "header", values.alias("values"))


@dataclass(frozen=True)
class ProgrammeLayout:
    """Where a country's entry page keeps its programmes; labels: starts of the strong words before a text, in lower case."""

    section: str = "h2"
    subject: str = "h3"
    item: str = ".accordion__item"
    header: str = ".accordion__header"
    title: str = "h4"
    duration: str = "span"
    body: str = ".accordion__body"
    labels: tuple[tuple[str, str], ...] = (("english", "english language"), ("entry", "entry requirements"))


#: Sections of a country's page and the level of their programmes; others do not count. Fixed values.
SECTION_LEVELS = (("undergraduate entry requirements", "Undergraduate"), ("postgraduate entry requirements", "Postgraduate"))


def programmes(pages: DataFrame, key: str, html: str, layout: ProgrammeLayout = ProgrammeLayout()) -> DataFrame:  # noqa: B008
    """Programmes of country pages, one row each: key, place, studyLevel, subjectArea, program, duration and a text for each label.

    A programme belongs to the section and subject whose headings come last
    before it. Foundation is the level of an international foundation
    programme. Without a duration a title with a foundation year means 4 years.
    A labelled text is that of its paragraph behind the label; of several
    paragraphs with one label the last counts.

    Defined results: items without a header, title or body, and those outside
    the sections known, have no row; a missing text is ''.
    """
    t = F.col("__tree")
    words = lambda e: tree_.text_of(t, e)
    bind = tree_.bind

    def last(pool: Column, e: Column) -> Column:
        return F.try_element_at(F.filter(pool, lambda h: h["no"] < e["no"]), F.lit(-1))

    def labelled(paragraphs: Column, start: str) -> Column:
        mine = F.filter(paragraphs, lambda p: F.lower(p["strong"]).startswith(start))
        return F.coalesce(F.trim(F.regexp_replace(F.try_element_at(mine, F.lit(-1))["rest"], r"^\s*:\s*", "")), F.lit(""))

    def paragraph(p: Column) -> Column:
        behind = lambda strong: F.array_join(
            F.transform(F.filter(tree_.within(t, p), lambda x: (x["no"] > strong["last"]) & x["text"].isNotNull()), lambda x: x["text"]), " "
        )
        return bind(
            F.get(tree_.select(t, "strong", p), 0), lambda strong: F.struct(words(strong).alias("strong"), behind(strong).alias("rest"))
        )

    def level_of(section: Column) -> Column:
        return bind(section, lambda s: F.coalesce(*(F.when(F.contains(s, F.lit(name)), level) for name, level in SECTION_LEVELS)))

    def told(e: Column, header: Column, paragraphs: Column, title: Column, said: Column, level: Column, subject: Column) -> Column:
        return F.struct(
            e["no"].alias("place"),
            F.when(F.lower(title).contains("international foundation programme"), "Foundation").otherwise(level).alias("studyLevel"),
            (level.isNotNull() & (title != "") & paragraphs.isNotNull()).alias("known"),
            subject.alias("subjectArea"),
            F.when((subject != "") & (title != ""), F.concat(subject, F.lit(": "), title)).otherwise(F.concat(subject, title)).alias("program"),
            F.when((said == "") & F.lower(title).contains("foundation year"), "4 years with foundation year").otherwise(said).alias("duration"),
            *(labelled(paragraphs, start).alias(name) for name, start in layout.labels),
        )

    def row(e: Column) -> Column:
        paragraphs = bind(tree_.first(t, layout.body, e), lambda b: F.when(b.isNotNull(), F.transform(tree_.select(t, "p", b), paragraph)))
        texts = lambda header: F.struct(
            words(tree_.first(t, layout.title, header)).alias("title"),
            words(tree_.first(t, layout.duration, header)).alias("said"),
            level_of(last(F.col("__sections"), e)["text"]).alias("level"),
            F.coalesce(last(F.col("__subjects"), e)["text"], F.lit("")).alias("subject"),
        )
        return bind(
            tree_.first(t, layout.header, e),
            lambda header: bind(
                paragraphs, lambda ps: bind(texts(header), lambda x: told(e, header, ps, x["title"], x["said"], x["level"], x["subject"]))
            ),
        )

    # texts of headings come before the programmes, so that each is read once
    heading = lambda e: F.struct(e["no"].alias("no"), F.lower(words(e)).alias("text"))
    plain = lambda e: F.struct(e["no"].alias("no"), words(e).alias("text"))
    known = F.filter(F.transform(tree_.select(t, layout.section), heading), lambda h: level_of(h["text"]).isNotNull())
    rows = pages.select(F.col(key).alias("key"), tree_.tree(F.col(html)).alias("__tree"))
    rows = rows.select("*", known.alias("__sections"), F.transform(tree_.select(t, layout.subject), plain).alias("__subjects"))
    each = rows.select("key", F.explode(F.transform(tree_.select(t, layout.item), row)).alias("x")).select("key", "x.*")
    return each.where("known").select(
        "key", "place", "studyLevel", "subjectArea", "program", "duration", *(name for name, _ in layout.labels)
    )


def required(entry: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Array of (degree, grade) of an entry text: of each rule (pattern, degree, grade) that fits, in order, each pair once.

    A grade may be a group of the pattern (`$1`) and, parted by `|`, what stands for it where that is empty.
    A text that asks to contact somebody has none.
    """
    found = []
    for pattern, degree, grade in rules:
        own, _, other = grade.partition("|")
        value = F.trim(F.regexp_extract(entry, pattern, int(own[1:]))) if own.startswith("$") else F.lit(own)
        value = F.when(value == "", other).otherwise(value)
        found.append(F.when(entry.rlike(pattern), F.struct(F.lit(degree).alias("degree"), value.alias("grade"))))
    none = F.array().cast("array<struct<degree:string,grade:string>>")
    rows = F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull()))
    return F.when(entry.rlike("(?i)contact our") | entry.isNull(), none).otherwise(rows)
