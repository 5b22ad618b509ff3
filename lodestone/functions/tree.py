"""A page as a tree of elements in one column; what is read from it are array expressions inside the page's row.

Python only tells the elements apart. A node's number is its place in the
array, a subtree is the slice from a node to its `last`, so that descendants,
siblings, ancestors and ids are found by place, without a join.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lodestone.functions.markup import Markup

#: Elements without an end tag. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose text is none of the page's. Fixed values.
UNREAD = frozenset("script style template".split())
#: What an element ends that is still open right before it. Fixed values.
ENDS = {
    **dict.fromkeys("td th".split(), frozenset("td th".split())),
    "tr": frozenset("td th tr".split()),
    **dict.fromkeys("tbody thead tfoot".split(), frozenset("td th tr tbody thead tfoot".split())),
    **dict.fromkeys("dt dd".split(), frozenset("dt dd".split())),
    "li": frozenset(["li"]),
    "option": frozenset(["option"]),
    **dict.fromkeys("p div ul ol dl table section article h1 h2 h3 h4 h5 h6".split(), frozenset(["p"])),
}
_NAMES = ("parent", "last", "next", "prior", "begin", "end")
NODE = (
    "struct<no:int,parent:int,last:int,next:int,prior:int,begin:int,end:int,tag:string,id:string,"
    "classes:array<string>,attrs:map<string,string>,text:string>"
)
CELL = "struct<table:int,row:int,col:int,no:int,label:int,header:boolean>"
TREE = f"struct<nodes:array<{NODE}>,named:map<string,int>,cells:array<{CELL}>>"


class _Builder(Markup):
    """Numbers of parent, last descendant, next and prior sibling element, and the place in the source, of every node."""

    def __init__(self, page: str):
        super().__init__()
        self.tags: list[str | None] = []
        self.attrs: list[dict[str, str]] = []
        self.texts: list[str | None] = []
        self.numbers: dict[str, list[int]] = {name: [] for name in _NAMES}
        self.open: list[int] = []
        self.counts: dict[str, int] = {}
        self.latest: dict[int, int] = {}  # of an open element the last element inside
        self.size = len(page)
        self.read(page)
        self._shut(0, self.size)

    def _add(self, tag: str | None, attrs: dict[str, str], text: str | None, begin: int, end: int) -> int:
        no, parent = len(self.tags), self.open[-1] if self.open else -1
        prior = -1
        if tag is not None:
            prior = self.latest.get(parent, -1)
            if prior >= 0:
                self.numbers["next"][prior] = no
            self.latest[parent] = no
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.texts.append(text)
        numbers = self.numbers
        numbers["parent"].append(parent)
        numbers["last"].append(no)
        numbers["next"].append(-1)
        numbers["prior"].append(prior)
        numbers["begin"].append(begin)
        numbers["end"].append(end)
        return no

    def _shut(self, depth: int, at: int) -> None:
        """Close all open elements beyond this depth."""
        while len(self.open) > depth:
            no = self.open.pop()
            self.counts[self.tags[no]] -= 1
            self.latest.pop(no, None)
            self.numbers["last"][no] = len(self.tags) - 1
            self.numbers["end"][no] = at

    def handle_starttag(self, tag, attrs):
        at = self.place()
        while self.open and self.tags[self.open[-1]] in ENDS.get(tag, ()):
            self._shut(len(self.open) - 1, at)
        known = {k: v or "" for k, v in reversed(attrs)}  # of a repeated attribute the first counts
        no = self._add(tag, known, None, at, self.tag_end())
        if tag not in VOID:
            self.open.append(no)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if not self.counts.get(tag):
            return
        at = self.place()
        depth = len(self.open) - 1
        while self.tags[self.open[depth]] != tag:
            depth -= 1
        self._shut(depth, min(self.size, at + len(tag) + 3))

    def handle_data(self, data):
        if data.strip() and not (self.open and self.tags[self.open[-1]] in UNREAD):
            at = self.place()
            self._add(None, {}, " ".join(data.split()), at, at)

    def cells(self) -> list[tuple[int, int, int, int, int, bool]]:
        """Table, row, column and number of every cell, the number of the one that labels it, or -1, and whether it is a header.

        A cell that spans rows or columns stands in each of its places. What
        labels it is the header over it in the first row, where all cells of
        that row are headers, in other tables the first cell of its own row.
        """
        rows: dict[int, list[int]] = {}
        inside: dict[int, list[int]] = {}
        table: dict[int, int] = {}
        for no, tag in enumerate(self.tags):
            parent = self.numbers["parent"][no]
            table[no] = no if tag == "table" else table.get(parent, -1)
            if tag == "tr" and table[no] >= 0:
                rows.setdefault(table[no], []).append(no)
                inside[no] = []
            elif tag in ("td", "th") and parent in inside:
                inside[parent].append(no)
        out = []
        for t, lines in rows.items():
            taken: dict[tuple[int, int], int] = {}
            for r, line in enumerate(lines):
                c = 0
                for cell in inside[line]:
                    while (r, c) in taken:
                        c += 1
                    down, over = (self._span(cell, name) for name in ("rowspan", "colspan"))
                    for i in range(r, min(len(lines), r + down) if down else len(lines)):
                        for j in range(c, c + max(over, 1)):
                            taken.setdefault((i, j), cell)
                    c += max(over, 1)
            headed = all(self.tags[no] == "th" for (r, _), no in taken.items() if r == 0)
            for (r, c), no in sorted(taken.items()):
                label = taken.get((0, c) if headed else (r, 0), -1)
                out.append((t, r, c, no, -1 if label == no else label, self.tags[no] == "th"))
        return out

    def _span(self, cell: int, name: str) -> int:
        said = self.attrs[cell].get(name, "1").strip()
        return min(int(said), 1000) if said.isdecimal() else 1


def _lists(sizes: list[int], values: pa.Array) -> pa.Array:
    offsets = [0]
    for n in sizes:
        offsets.append(offsets[-1] + n)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _structs(**columns: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def _trees(pages: pa.Array) -> pa.Array:
    built = [_Builder(p.as_py() or "") for p in pages]
    text = lambda values: pa.array(values, pa.string())
    attrs = [a for b in built for a in b.attrs]
    nodes = _structs(
        no=pa.array([k for b in built for k in range(len(b.tags))], pa.int32()),
        **{name: pa.array([x for b in built for x in b.numbers[name]], pa.int32()) for name in _NAMES},
        tag=text([t for b in built for t in b.tags]),
        id=text([a.get("id") for a in attrs]),
        classes=pa.array([a.get("class", "").split() for a in attrs], pa.list_(pa.string())),
        attrs=pa.array([list(a.items()) for a in attrs], pa.map_(pa.string(), pa.string())),
        text=text([t for b in built for t in b.texts]),
    )
    named = []
    for b in built:
        first: dict[str, int] = {}
        for no, a in enumerate(b.attrs):
            if a.get("id"):
                first.setdefault(a["id"], no)
        named.append(list(first.items()))
    grids = [b.cells() for b in built]
    column = lambda k, kind: pa.array([c[k] for g in grids for c in g], kind)
    cells = _structs(**{n: column(k, pa.int32()) for k, n in enumerate(("table", "row", "col", "no", "label"))}, header=column(5, pa.bool_()))
    return _structs(
        nodes=_lists([len(b.tags) for b in built], nodes),
        named=pa.array(named, pa.map_(pa.string(), pa.int32())),
        cells=_lists([len(g) for g in grids], cells),
    )


def tree(html: Column) -> Column:
    """Struct of a page's nodes, its first element of each id, and the cells of its tables by row and column.

    Defined results: a null or empty page has no nodes; missing end tags are
    put where the next element requires them, stray ones are left out; a node
    without a tag is a text, its white space one space; pages of any depth take
    time in proportion to their length.
    """
    return arrow_udf(_trees, TREE)(html)


def bind(value: Column, body) -> Column:
    """body(value), with value planned and evaluated once however often body refers to it."""
    return F.get(F.transform(F.array(value), body), 0)


def node(tree: Column, no: Column) -> Column:
    """The node of that number, null where there is none."""
    return F.when(no >= 0, F.get(tree["nodes"], no))


def by_id(tree: Column, name: Column) -> Column:
    """The first element of that id, found by the page's index."""
    return node(tree, F.coalesce(F.try_element_at(tree["named"], name), F.lit(-1)))


def within(tree: Column, e: Column) -> Column:
    """All nodes inside an element, in page order."""
    return bind(e, lambda e: F.slice(tree["nodes"], e["no"] + 2, e["last"] - e["no"]))


def lines(tree: Column, e: Column) -> Column:
    """The texts inside an element (or of a text node itself), one a node."""
    all_ = bind(e, lambda e: F.slice(tree["nodes"], e["no"] + 1, e["last"] - e["no"] + 1))
    return F.transform(F.filter(all_, lambda x: x["text"].isNotNull()), lambda x: x["text"])


def text_of(tree: Column, e: Column) -> Column:
    """The text inside an element."""
    return F.coalesce(F.array_join(lines(tree, e), " "), F.lit(""))


def source_of(html: Column, e: Column) -> Column:
    """An element as it stands in the page."""
    return F.substring(html, e["begin"] + 1, e["end"] - e["begin"])


def ancestors(tree: Column, e: Column, most: int = 8) -> Column:
    """The elements around one, from its parent outwards, at most so many."""
    start = F.struct(e["parent"].alias("at"), F.slice(tree["nodes"], F.lit(1), F.lit(0)).alias("seen"))

    def step(state: Column, _: Column) -> Column:
        on = state["at"] >= 0
        here = F.get(tree["nodes"], state["at"])
        return F.struct(
            F.when(on, here["parent"]).otherwise(-1).alias("at"),
            F.when(on, F.concat(state["seen"], F.array(here))).otherwise(state["seen"]).alias("seen"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step, lambda s: s["seen"])


_STEP = re.compile(r"""(?P<tag>[a-z][a-z0-9]*|\*)?(?P<rest>(?:[#.][\w-]+|\[[\w-]+(?:[*^$~]?=["']?[^"'\]]*["']?)?\])*)""", re.I)
_PART = re.compile(r"""[#.][\w-]+|\[[\w-]+(?:[*^$~]?=["']?[^"'\]]*["']?)?\]""")


def _fits(e: Column, step: str) -> Column:
    """Whether a node fits one step of a selector: tag, #id, .class, [attr], [attr=v] and with *=, ^=, $=, ~=."""
    m = _STEP.fullmatch(step)
    if not m or not step:
        raise ValueError(f"no such selector: {step}")
    tests = [e["tag"] == m["tag"].lower() if m["tag"] and m["tag"] != "*" else e["tag"].isNotNull()]
    for part in _PART.findall(m["rest"]):
        if part[0] == "#":
            tests.append(e["id"] == part[1:])
        elif part[0] == ".":
            tests.append(F.array_contains(e["classes"], part[1:]))
        else:
            name, sign, value = re.fullmatch(r"""\[([\w-]+)(?:([*^$~]?=)["']?([^"'\]]*)["']?)?\]""", part).groups()
            has = F.try_element_at(e["attrs"], F.lit(name.lower()))
            tests.append(
                {
                    None: has.isNotNull(),
                    "=": has == value,
                    "*=": F.contains(has, F.lit(value)) & F.lit(value != ""),
                    "^=": F.startswith(has, F.lit(value)) & F.lit(value != ""),
                    "$=": F.endswith(has, F.lit(value)) & F.lit(value != ""),
                    "~=": F.array_contains(F.split(has, r"\s+"), value),
                }[sign]
            )
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return F.coalesce(out, F.lit(False))


def select(tree: Column, selector: str, root: Column | None = None) -> Column:
    """The elements that a selector names, in page order; root: only those inside that element.

    Steps parted by spaces are descendants, alternatives are parted by commas.
    """
    pool = tree["nodes"] if root is None else within(tree, root)

    def chosen(choice: str) -> Column:
        around = None
        for step in choice.split():
            around = F.filter(pool, _inside(step, around))
        return around

    choices = [chosen(c) for c in selector.split(",")]
    return choices[0] if len(choices) == 1 else _merged(choices)


def _inside(step: str, around: Column | None):
    """Whether a node fits a step and lies inside one of the elements that the steps before named."""
    if around is None:
        return lambda e: _fits(e, step)
    return lambda e: _fits(e, step) & F.exists(around, lambda a: (a["no"] < e["no"]) & (a["last"] >= e["no"]))


def _merged(choices: list[Column]) -> Column:
    """Nodes of several lists, each once, in page order."""
    numbers = lambda every: F.array_sort(F.array_distinct(F.transform(every, lambda e: e["no"])))
    return bind(F.concat(*choices), lambda every: F.transform(numbers(every), lambda k: F.get(F.filter(every, lambda e: e["no"] == k), 0)))


def first(tree: Column, selectors: str | list[str], root: Column | None = None, least: int = 0) -> Column:
    """The first element of the first selector that has one whose text has `least` signs; null where none has."""
    each = [selectors] if isinstance(selectors, str) else selectors
    found = [F.get(select(tree, s, root), 0) for s in each]
    if least:
        found = [bind(x, lambda e: F.when(F.length(text_of(tree, e)) >= least, e)) for x in found]
    return F.coalesce(*found)


def without(html: Column, e: Column, inner: Column) -> Column:
    """An element as it stands in the page, without the given elements inside it (in page order; those inside another one of them do not count)."""

    def cut(e: Column, outer: Column) -> Column:
        ends = F.concat(F.array(e["begin"]), F.transform(outer, lambda x: x["end"]))
        begins = F.concat(F.transform(outer, lambda x: x["begin"]), F.array(e["end"]))
        return F.array_join(F.zip_with(ends, begins, lambda a, b: F.substring(html, a + 1, b - a)), "")

    return bind(e, lambda e: bind(bind(inner, outermost), lambda outer: cut(e, outer)))


def inside(x: Column, outer: Column) -> Column:
    """Whether a node lies inside one of these elements."""
    return F.exists(outer, lambda a: (a["no"] < x["no"]) & (a["last"] >= x["no"]))


def outermost(found: Column) -> Column:
    """The elements that lie inside none of the others."""
    return F.filter(found, lambda x: ~inside(x, found))


def labelled(tree: Column, root: Column | None = None) -> Column:
    """Array of (label, value, no) in page order: terms and their descriptions, cells under (or beside) their headers, and
    elements of two children without a text of their own; root: only those inside that element.

    A description may be several dd. What labels a cell is said by the tree.
    """
    nodes, cells = tree["nodes"], tree["cells"]
    pool = nodes
    if root is not None:
        pool, cells = within(tree, root), F.filter(cells, lambda c: (c["no"] > root["no"]) & (c["no"] <= root["last"]))
    row = lambda label, value, no: F.struct(label.alias("label"), value.alias("value"), no.alias("no"))
    terms = F.transform(
        F.filter(pool, lambda e: e["tag"] == "dt"),
        lambda e: row(text_of(tree, e), F.array_join(F.transform(F.filter(following(tree, e, "dd"), lambda x: x["no"] > 0), lambda x: text_of(tree, x)), " "), e["no"]),
    )
    boxed = F.transform(
        F.filter(cells, lambda c: ~c["header"] & (c["label"] >= 0)),
        lambda c: row(text_of(tree, node(tree, c["label"])), text_of(tree, node(tree, c["no"])), c["no"]),
    )
    children = lambda e: F.filter(F.slice(nodes, e["no"] + 2, e["last"] - e["no"]), lambda x: x["parent"] == e["no"])
    boxes = F.filter(pool, lambda e: e["tag"].isin("td", "li", "div", "p", "section") & (e["last"] - e["no"]).between(2, 64))
    pairs = F.transform(boxes, lambda e: F.struct(e["no"].alias("no"), children(e).alias("of")))
    two = F.filter(
        pairs,
        lambda p: (F.size(p["of"]) == 2)
        & F.forall(p["of"], lambda x: F.coalesce(x["tag"].isin("span", "div", "strong", "b", "p", "h2", "h3", "h4", "h5", "h6", "label"), F.lit(False))),
    )
    twins = F.transform(two, lambda p: row(text_of(tree, F.get(p["of"], 0)), text_of(tree, F.get(p["of"], 1)), p["no"]))
    said = F.filter(F.concat(terms, boxed, twins), lambda p: (F.coalesce(p["label"], F.lit("")) != "") & (F.coalesce(p["value"], F.lit("")) != ""))
    return F.array_sort(said, lambda a, b: F.when(a["no"] < b["no"], -1).when(a["no"] > b["no"], 1).otherwise(0))


def following(tree: Column, e: Column, tag: str, most: int = 16) -> Column:
    """The sibling elements right after one, as long as they have that tag, at most so many."""
    start = F.struct(e["next"].alias("at"), F.slice(tree["nodes"], F.lit(1), F.lit(0)).alias("seen"))

    def step(state: Column, _: Column) -> Column:
        here = F.get(tree["nodes"], state["at"])
        on = (state["at"] >= 0) & F.coalesce(here["tag"] == tag, F.lit(False))
        return F.struct(
            F.when(on, here["next"]).otherwise(-1).alias("at"),
            F.when(on, F.concat(state["seen"], F.array(here))).otherwise(state["seen"]).alias("seen"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step, lambda s: s["seen"])
