"""HTML to markdown and anchors: the one layer that built-in expressions cannot parse, as Arrow-batched UDFs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lodestone.functions.markup import Markup

#: Elements whose content is dropped. Fixed values.
DROPPED = frozenset(
    "script style noscript svg iframe nav header footer form button select textarea head".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that a head can hold; any other ends it. Fixed values.
_IN_HEAD = frozenset("head title meta link style script base noscript template".split())
_BLOCK = frozenset("p div section article main ul ol li table blockquote dl dt dd h1 h2 h3 h4 h5 h6 tr".split())


class _Reader(Markup):
    """One pass over a page that keeps a stack of open elements and writes markdown as they close."""

    def __init__(self):
        super().__init__()
        self.out: list[list[str]] = [[]]
        self.open: list[tuple[str, dict, bool]] = []  # tag, attributes, whether its content is dropped
        self.skip = 0
        self.rows: list[list[list[str]]] = []  # of each table that is open
        self.label = ""

    def handle_starttag(self, tag, attrs):
        if tag not in _IN_HEAD and any(t == "head" for t, *_ in self.open):
            self.handle_endtag("head")  # its end tag may be left out
        own = tag == "header" and any(t in ("article", "main") for t, *_ in self.open)
        dropped = tag in DROPPED and not own
        if tag in _VOID:
            if tag == "br" and not self.skip:
                self.out[-1].append("\n")
            return
        ends = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
        while self.open and self.open[-1][0] in ends.get(tag, (tag,) if tag in ("p", "li") else ()):
            self.handle_endtag(self.open[-1][0])  # an unclosed one ends where its like begins
        if tag in _BLOCK and self.open and self.open[-1][0] in ("p", "b", "strong", "em", "i"):
            while self.open and self.open[-1][0] in ("p", "b", "strong", "em", "i"):
                self.handle_endtag(self.open[-1][0])
        self.skip += dropped
        if tag == "table":
            self.rows.append([])
        self.open.append((tag, dict(attrs), dropped))
        self.out.append([])

    def handle_endtag(self, tag):
        if not any(t == tag for t, *_ in self.open):
            return
        while self.open:
            name, attrs, dropped = self.open.pop()
            text = "".join(self.out.pop())
            if dropped:
                self.skip -= 1
            else:
                self.out[-1].append(self.written(name, attrs, text))
            if name == tag:
                return

    def handle_data(self, data):
        if not self.skip:
            self.out[-1].append(re.sub(r"\s+", " ", data))

    def written(self, name: str, attrs: dict, text: str) -> str:
        flat = " ".join(text.split())
        if re.fullmatch("h[1-6]", name):
            return f"\n\n{'#' * int(name[1])} {flat}\n\n" if flat else ""
        if name == "a":
            href = (attrs.get("href") or "").strip()
            return f"[{flat}]({href})" if flat and href and not href.startswith(("#", "javascript:")) else text
        if name in ("strong", "b"):
            return f"**{flat}**" if flat else ""
        if name in ("em", "i"):
            return f"*{flat}*" if flat else ""
        if name == "p":
            return f"\n\n{text.strip()}\n\n" if text.strip() else ""
        if name == "li":
            return f"- {re.sub(chr(10) + '+', chr(10) + '  ', text.strip())}\n" if flat else ""
        if name in ("ul", "ol"):
            return f"\n{text}" if flat else ""
        if name in ("td", "th"):
            return flat.replace("|", "\\|") + "\x1f"
        if name == "tr":
            cells = text.split("\x1f")[:-1]
            if self.rows and any(c.strip() for c in cells):
                self.rows[-1].append([c.strip() for c in cells])
            return ""
        if name == "table":
            rows = self.rows.pop()
            if not rows:
                return ""
            width = max(map(len, rows))
            full = [r + [""] * (width - len(r)) for r in rows]
            lines = [full[0], ["---"] * width, *full[1:]]
            return "\n\n" + "\n".join("| " + " | ".join(r) + " |" for r in lines) + "\n\n"
        if name == "blockquote":
            return "\n\n" + "\n".join(f"> {x.strip()}" for x in text.strip().splitlines() if x.strip()) + "\n\n" if flat else ""
        if name == "dt":
            held, self.label = self.label, flat
            return f"- **{held}**\n" if held else ""
        if name == "dd":
            held, self.label = self.label, ""
            return (f"- **{held}:** {flat}\n" if held else f"- {flat}\n") if flat else ""
        if name == "dl":
            held, self.label = self.label, ""
            return "\n\n" + text + (f"- **{held}**\n" if held else "") + "\n"
        return text

    def result(self) -> str:
        while self.open:
            self.handle_endtag(self.open[-1][0])
        text = "".join(self.out[0]).replace(" ", " ")
        text = re.sub(r"[ \t]*\n[ \t]*(?=\n)|[ \t]+\n", "\n", text)
        return re.sub(r"\n{3,}", "\n\n", text).strip()


def page_markdown(html: str | None) -> str:
    reader = _Reader()
    reader.read(html or "")
    return reader.result()


#: Where main content stands, in order of preference: tag, or attribute and value. Fixed values.
MAIN = (
    ("tag", "main"),
    ("tag", "article"),
    ("role", "main"),
    ("id", "content"),
    ("id", "main-content"),
    ("class", "main-content"),
    ("class", "whole-content"),
    ("class", "page-content"),
    ("class", "field-body"),
)


def _opening(kind: str, name: str) -> re.Pattern:
    """The opening tag that a place of MAIN names; a class may stand among others."""
    if kind == "tag":
        return re.compile(rf"<({name})\b[^>]*>", re.I)
    value = rf"(?:[^\"']*\s)?{name}(?:\s[^\"']*)?" if kind == "class" else name
    return re.compile(rf"""<(\w+)\b[^>]*?\b{kind}\s*=\s*["']{value}["'][^>]*>""", re.I)


_PLACES = [_opening(*place) for place in MAIN]
_BLOCKS = re.compile(r"<(main|article|section|div)\b[^>]*>", re.I)


def _element(html: str, opening: re.Match) -> str:
    """An element from its opening tag to the end tag that matches, or to the end."""
    depth = 0
    for t in re.compile(rf"<(/?){opening[1]}\b[^>]*>", re.I).finditer(html, opening.start()):
        depth += -1 if t[1] else 1
        if depth == 0:
            return html[opening.start() : t.end()]
    return html[opening.start() :]


def _text_length(html: str) -> int:
    return len("".join(re.sub("<[^>]*>", "", html).split()))


def main_part(html: str | None, least: int = 200) -> str:
    """The first place of MAIN whose text is longer than `least`, else the block with the longest text, else the body."""
    html = html or ""
    for place in _PLACES:
        if (m := place.search(html)) and _text_length(part := _element(html, m)) > least:
            return part
    body = re.search(r"(?is)<body\b[^>]*>(.*)(?:</body>|$)", html)
    inner = body[1] if body else html
    first = _BLOCKS.search(inner)  # of nested blocks the outermost has the longest text
    blocks = []
    while first:
        blocks.append(_element(inner, first))
        first = _BLOCKS.search(inner, first.start() + len(blocks[-1]))
    return max(blocks, key=_text_length, default=inner)


def _mapped(read) -> Callable[[Column], Column]:
    def run(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield batch.map(read)

    return pandas_udf(run, StringType())


def to_markdown(html: Column, read: Callable[[str | None], str] = page_markdown) -> Column:
    """Markdown of a whole page; `read` may be another reader of one page (a site's own hook)."""
    return _mapped(read)(html)


def main_markdown(html: Column) -> Column:
    """Markdown of a page's main content."""
    return _mapped(lambda h: page_markdown(main_part(h)))(html)


_SELECTOR = re.compile(r"""^([a-z][a-z0-9]*)?(?:\#([\w-]+)|\.([\w-]+)|\[([\w-]+)(\*?=)["']?([^"'\]]+)["']?\])?$""", re.I)


def _selected(html: str, selector: str) -> str | None:
    """The first element that a selector names: tag, #id, .class, [attr="v"], [attr*="v"], each with a tag before it or
    not, descendants parted by spaces, alternatives by commas."""
    for choice in selector.split(","):
        part: str | None = html
        for step in choice.split():
            m = _SELECTOR.match(step)
            if not m:
                raise ValueError(f"no such selector: {step}")
            tag = m[1] or r"\w+"
            if m[2] or m[3] or m[4]:
                key = "id" if m[2] else "class" if m[3] else m[4]
                value = re.escape(m[2] or m[3] or m[6])
                if m[3] or m[5] == "*=":
                    edge = r"(?:[^\"']*\s)?{}(?:\s[^\"']*)?" if m[3] else r"[^\"']*{}[^\"']*"
                    value = edge.format(value)
                opening = re.compile(rf"""<({tag})\b[^>]*?\b{key}\s*=\s*["']{value}["'][^>]*>""", re.I)
            else:
                opening = re.compile(rf"<({tag})\b[^>]*>", re.I)
            inner = part if part is html else part[part.index(">") + 1 :]
            found = opening.search(inner)
            part = _element(inner, found) if found else None
            if part is None:
                break
        if part is not None and part is not html:
            return part
    return None


def page_blocks(html: str | None, blocks: list[tuple[str, str]], least: int = 20) -> tuple[str, list[str]]:
    """A page's title and the named blocks, each (heading, selector), as markdown, and what is missing or short."""
    html = html or ""
    title = re.search(r"(?is)<h1\b[^>]*>(.*?)</h1>", html)
    out = [f"# {' '.join(re.sub('<[^>]*>', ' ', title[1]).split())}"] if title else []
    warnings = [] if title else ["no title"]
    for heading, selector in blocks:
        part = _selected(html, selector)
        text = page_markdown(part) if part else ""
        if len(text) < least:
            warnings.append(f"{heading}: {'too short' if part else 'not found'}")
            continue
        first = text.split("\n", 1)[0].lstrip("# ").strip()
        if first.lower() == heading.lower():  # the block brings its own heading
            text = text.split("\n", 1)[1].strip() if "\n" in text else ""
        out.append(f"## {heading}\n\n{text}")
    return "\n\n".join(out), warnings


def blocks_markdown(html: Column, blocks: list[tuple[str, str]], least: int = 20) -> Column:
    """Struct (markdown, warnings) of page_blocks, in Arrow batches."""

    def run(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in pages:
            yield pd.DataFrame([page_blocks(h, blocks, least) for h in batch], columns=["markdown", "warnings"])

    kind = StructType([StructField("markdown", StringType()), StructField("warnings", ArrayType(StringType()))])
    return pandas_udf(run, kind)(html)


def page_title(html: Column) -> Column:
    """Text of the first h1, else of the title, without markup."""
    one = lambda tag: F.nullif(
        F.trim(
            F.regexp_replace(
                F.regexp_replace(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1), "<[^>]*>", " "), r"\s+", " "
            )
        ),
        F.lit(""),
    )
    return F.coalesce(one("h1"), one("title"), F.lit(""))


def anchors(html: Column) -> Column:
    """The href of every anchor, in page order."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))


def absolute(href: Column, base: Column) -> Column:
    """A link resolved against the page's address: absolute, scheme-relative, root-relative and plain relative ones."""
    site = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(://[^/]*/(?:.*/)?)[^/]*$", "$1")
    folder = F.when(folder.rlike("://[^/]*$"), F.concat(folder, F.lit("/"))).otherwise(folder)
    h = F.trim(href)
    return (
        F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(site, h))
        .when(h.startswith("#") | (h == ""), F.concat(F.regexp_replace(base, "#.*$", ""), h))
        .otherwise(F.concat(folder, h))
    )


def result_count(html: Column) -> Column:
    """Struct (first, last, total) of a banner like 'Showing 1 - 10 of 95 results'; nulls where there is none."""
    p = r"(?i)(\d+)\s*(?:-|–|to)\s*(\d+)\s+of\s+([\d,]+)"
    part = lambda g: F.replace(F.regexp_extract(html, p, g), F.lit(","), F.lit("")).try_cast("int")
    return F.struct(part(1).alias("first"), part(2).alias("last"), part(3).alias("total"))
