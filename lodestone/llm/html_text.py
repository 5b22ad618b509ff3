"""HTML extraction by line-block distribution."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that begin and end a line. Fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody"
    " td tfoot th thead tr ul".split()
)
#: Elements whose whole content goes, to the end of the page where the end tag is missing: no tag in them counts. Fixed values.
RAW = "script|style|textarea"
#: Elements whose whole content goes where they are closed. Fixed values.
HELD = "title|noscript|template|svg|math|iframe|object|select|button|canvas|audio|video"
#: Of these, the ones that hold a label: not closed, they end at the next block. Fixed values.
LABELS = frozenset("title select button".split())
#: Elements whose lines have no text for the distribution. Fixed values.
FRAME = frozenset("nav aside footer form menu dialog fieldset search".split())
#: Elements that can hold others and are tracked as open. Fixed values.
HOLDERS = frozenset(
    "article aside body center details dialog div dl fieldset figure footer form header main menu nav ol search section"
    " table ul".split()
)
#: Holders whose lines count as lines of what stands around them. Fixed values.
INNER = frozenset("ul ol dl table figure details center section".split())
#: Elements that end where another of the group begins. Fixed values.
SIBLINGS = {tag: group.split() for group in ("p", "li", "dt dd", "td th", "tr", "tbody thead tfoot") for tag in group.split()}
#: Words of class, id, role and label that name boilerplate. Fixed values.
NAMED = re.compile(
    r"ads?|adsbygoogle|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|"
    r"newsletter|subscribe|signup|login|search|nav\w*|menu|breadcrumbs?|topbar|masthead|sidebar|aside|footer|"
    r"header|comments?|commentlist|disqus|replies|respond|related|recommend\w*|share|sharing|social|widget|toolbar|"
    r"pagination|pager|copyright|legal|contentinfo|complementary|navigation",
    re.I,
)
#: Words that may stand beside them in a name without giving it another sense: related-posts, but not related-work. Fixed values.
GENERIC = re.compile(
    r"\d*|area|articles?|bar|blocks?|body|bottom|box|buttons?|column|container|content|fixed|form|global|google|group|holder|"
    r"icons?|id|inner|items?|js|left|lists?|links?|main|media|mobile|outer|page|panel|policy|posts?|primary|right|row|rows|"
    r"secondary|section|side|site|slot|small|sticky|stories|text|thread|top|unit|widgets?|wrap|wrapper|zone",
    re.I,
)
#: Texts of headings that open the readers' comments, to the end of the element that the heading stands in. Fixed values.
COMMENTS = re.compile(
    r"(?:\d+\s+)?(?:(?:reader|user|visitor)s?['’]?s?\s+)?(?:comments?|replies|responses)(?:\s*\(\d+\))?:?"
    r"|leave\s+a\s+(?:comment|reply)|join\s+the\s+(?:conversation|discussion)",
    re.I,
)
#: A name like has-sidebar says what an element has around it, not what it is.
_AROUND = re.compile(r"(?:has|with|no|is|without|show|hide)[_-]", re.I)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][a-z0-9:-]*)(?P<attrs2>[^>]*+)>|<[!?][^>]*+>",
    re.I | re.S,
)
_PAIRED = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    rf"|<(?P<end>/?)(?P<tag>{HELD})(?![a-z0-9:-])(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    rf"|<(?P<end2>/?)(?P<tag2>{HELD})(?![a-z0-9:-])(?P<attrs2>[^>]*+)>",
    re.I | re.S,
)
_IS_HELD = re.compile(HELD, re.I)
_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})(?![a-z0-9:-])", re.I)
_NAMES = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

#: Lines of a window of the distribution, and what stands between lines that no window may join.
WINDOW = 3
_GAP = ("", 0, False, 0)
#: Weights of a letter: in an article or main, on a page without any, and outside of those that a page has. Fixed values.
MARKED, PLAIN, UNMARKED = 2.0, 1.0, 0.25


def names_of(attrs: str) -> list[str]:
    """The names that class, id and role give an element; a label is one name."""
    names = []
    for key, *values in _NAMES.findall(attrs):
        words = "".join(values).split()
        names += ["-".join(words)] if key.lower() == "aria-label" else words
    return names


def is_frame(names: list[str], inside: bool) -> bool:
    """Whether class, id or role names say boilerplate. A header inside an article is the article's own."""
    for name in names:
        parts = re.split(r"[-_]", name)
        said = [part for part in parts if NAMED.fullmatch(part)]
        if said and not _AROUND.match(name) and all(NAMED.fullmatch(part) or GENERIC.fullmatch(part) for part in parts):
            if not (inside and {part.lower() for part in said} == {"header"}):
                return True
    return False


def closed_elements(page: str) -> dict[int, int]:
    """Where each closed element of HELD begins and ends; an end tag closes the latest of its kind that is open."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in _PAIRED.finditer(page):
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if not (m["end"] or m["end2"]):
            if not (m["attrs"] or m["attrs2"] or "").endswith("/"):
                opened.setdefault(tag, []).append(m.start())
        elif opened.get(tag):
            ends[opened[tag].pop()] = m.end()
    return ends


class Holders:
    """The elements that hold lines, numbered from 1 as they open, 0 for the page: what each stands in and the last one inside it."""

    def __init__(self):
        self.above, self.last = [0], [0]

    def add(self, above: int) -> int:
        self.above.append(above)
        self.last.append(0)
        return len(self.above) - 1

    def shut(self, number: int) -> None:
        self.last[number] = len(self.above) - 1

    def holds(self, outer: int, number: int) -> bool:
        return outer == number or outer == 0 or outer <= number <= (self.last[outer] or len(self.above))

    def common(self, numbers: Iterable[int]) -> int:
        """The innermost element that holds all of them."""
        home = None
        for number in numbers:
            home = number if home is None else home
            while not self.holds(home, number):
                home = self.above[home]
        return home or 0


def lines_of(page: str) -> list[tuple[str, int, bool, int]]:
    """The lines of read_lines()."""
    return read_lines(page)[0]


def read_lines(page: str, named_inside: bool = True) -> tuple[list[tuple[str, int, bool, int]], Holders]:
    """Lines of a page without its markup: text, length for the distribution, inside article or main, number of the
    element around it (0 right in the page's body); and these elements.

    A block is a line. Lines in frame elements, or in elements whose class, id
    or role names boilerplate (inside of an article only if named_inside), are
    empty ones, and so are those from a heading of comments on. Outside of an
    article a line of links that has little else counts as length 0. Where a
    frame begins or ends stands an empty line; where an article does, as many
    as a window has.
    """
    lines: list[tuple[str, int, bool, int]] = []
    holders = Holders()
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool, int]] = []  # tag, boilerplate, article, number
    counts: dict[str, int] = {}  # of the open elements, by tag
    articles = 0  # of the open elements those inside an article
    in_link = heading = over = False

    def names_frame(attrs: str, inside: bool) -> bool:
        return (named_inside or not inside) and is_frame(names_of(attrs), inside)

    def push(tag: str, off: bool, inside: bool, around: int) -> None:
        nonlocal articles
        articles += inside
        stack.append((tag, off, inside, around))

    def pop() -> bool:
        nonlocal articles
        _, off, inside, around = stack.pop()
        articles -= inside
        if around and not (stack and stack[-1][3] == around):
            holders.shut(around)
        return off

    def close() -> None:
        nonlocal linked, heading, over
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text and heading and COMMENTS.fullmatch(text):
            if stack and stack[-1][0] not in ("body", "html"):
                tag, _, inside, around = stack[-1]
                stack[-1] = (tag, True, inside, around)
            else:
                over = True
        heading = False
        if text:
            _, off, inside, around = stack[-1] if stack else ("", False, False, 0)
            off = off or over
            plain = len(text) - min(linked, len(text))
            lines.append(_GAP if off else (text, 0 if plain * 3 < len(text) and not inside else len(text), inside, around))
        linked = 0

    at = 0
    closed, block = None, -1
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            text = page[at : m.start()]
            parts.append(text)
            if in_link:
                linked += len(text.strip())
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        ends = bool(m["end"] or m["end2"])
        if _IS_HELD.fullmatch(tag):
            if not ends and not (m["attrs"] or m["attrs2"] or "").endswith("/"):
                if closed is None:
                    closed = closed_elements(page)
                if m.start() in closed:
                    at = closed[m.start()]
                elif tag in LABELS:
                    if block < at:
                        found = _BLOCK.search(page, at)
                        block = found.start() if found else len(page)
                    at = block if block < len(page) else max(at, page.find("<", at))
        elif tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not ends
        elif tag in BLOCKS:
            close()
            in_link = False
            heading = not ends and len(tag) == 2 and tag[0] == "h" and tag != "hr"
            if stack and stack[-1][0] not in HOLDERS and (not ends and (stack[-1][0] in SIBLINGS.get(tag, ()) or stack[-1][0] == "p")):
                counts[stack[-1][0]] -= 1
                pop()  # its end tag may be left out
                if not (stack and stack[-1][1]):
                    lines.append(_GAP)
            if tag not in HOLDERS and not ends:
                # of the elements that hold a line or two, only those that are boilerplate are tracked
                _, off, inside, around = stack[-1] if stack else ("", False, False, 0)
                if not off and names_frame(m["attrs"] or m["attrs2"] or "", inside):
                    lines.append(_GAP)
                    push(tag, True, False, around)
                    counts[tag] = counts.get(tag, 0) + 1
                continue
            if ends:
                if counts.get(tag):
                    held = articles
                    while True:
                        name = stack[-1][0]
                        was = pop()
                        counts[name] -= 1
                        if name == tag:
                            break
                    if was and not (stack and stack[-1][1]):
                        lines.append(_GAP)
                    if held and not articles:
                        lines.extend([_GAP] * WINDOW)
            else:
                _, off, inside, around = stack[-1] if stack else ("", False, False, 0)
                held = articles
                attrs = m["attrs"] or m["attrs2"] or ""
                named = names_frame(attrs, inside)
                mine = tag in FRAME or tag == "header" and not inside or named
                if tag in ("main", "article", "body") and not off:
                    mine = inside and named
                inside = (inside or tag in ("article", "main") or "main" in names_of(attrs)) and not (off or mine)
                if mine and not off:
                    lines.append(_GAP)
                if inside and not held:
                    lines.extend([_GAP] * WINDOW)
                if tag not in INNER and tag != "body":
                    around = holders.add(around)
                push(tag, off or mine, inside, around)
                counts[tag] = counts.get(tag, 0) + 1
    if at < len(page):
        parts.append(page[at:])
    close()
    return lines, holders


def main_text(page: str | None, window: int = WINDOW, least: float = 80, rise: float = 0.15) -> str:
    """Text between the surge and dive points of a page's line-block distribution.

    The lengths of `window` lines from each line on are summed; tags and names
    only weigh the lengths. A surge is where a sum rises to `least` letters (on
    pages whose highest sum is small, to `rise` of that), its stretch goes from
    where the sums leave 0 to the dive, where they are 0 again. Stretches
    without a surge are main text only under the element that holds those with
    one; text right in the body holds only what stands right there too. Where
    names leave nothing of an article, they do not count inside it.
    """
    lines, holders = read_lines(page or "")
    sizes = np.array([x[1] for x in lines], dtype=float)
    if not sizes.sum():
        lines, holders = read_lines(page or "", named_inside=False)
        sizes = np.array([x[1] for x in lines], dtype=float)
        if not sizes.sum():
            return ""
    inside = np.array([x[2] for x in lines], dtype=bool)
    sizes *= np.where(inside, MARKED, UNMARKED) if (sizes * inside).any() else PLAIN
    sums = np.convolve(sizes, np.ones(window))[window - 1 :]
    padded = np.concatenate([[0], (sums > 0).astype(np.int8), [0]])
    starts, dives = np.flatnonzero(np.diff(padded) == 1), np.flatnonzero(np.diff(padded) == -1)
    stretches = [[k for k in range(a, b) if sizes[k]] for a, b in zip(starts, dives, strict=True)]
    # what stands between the first and the last line with a length belongs to a stretch, lines of links too
    stretches = [[k for k in range(s[0], s[-1] + 1) if lines[k][0] and inside[k] == inside[s[0]] or sizes[k]] for s in stretches]
    highest = [sums[a:b].max() for a, b in zip(starts, dives, strict=True)]
    bound = min(least, rise * max(highest))
    peak = stretches[int(np.argmax(highest))]
    marked = inside[max(peak, key=lambda k: sizes[k])]
    surged = [s for s, h in zip(stretches, highest, strict=True) if h >= bound and inside[s[0]] == marked]
    home = holders.common(lines[k][3] for s in surged for k in s) or holders.common(lines[k][3] for k in peak)

    def at_home(k: int) -> bool:
        return inside[k] == marked and (holders.holds(home, lines[k][3]) if home else not lines[k][3])

    kept = [
        k for s, h in zip(stretches, highest, strict=True) if h >= bound or any(map(at_home, s)) for k in s
    ]
    return "\n\n".join(lines[k][0] for k in kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page, in Arrow batches, without a shuffle.

    Defined results: null, empty and text-free pages give ''; unclosed and
    stray tags are tolerated; pages are read whole at any length and depth, in
    time in proportion to them; of equal peaks
    the first decides; each row is read by itself, so repeated rows and null
    keys pass through; an empty table gives an empty table; other columns are
    ignored.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
