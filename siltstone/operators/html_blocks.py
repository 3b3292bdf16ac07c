"""Blocks and tables of HTML pages, with a small tree built on html.parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from siltstone.session import spread

FINE = {"p", "li", "h1", "h2", "h3", "h4"}
BLOCKS = [*sorted(FINE), "div", "section", "td", "th"]
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
SKIP = {"script", "style", "noscript"}
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}, **{h: {"p"} for h in ("h1", "h2", "h3", "h4", "div", "section", "table", "ul", "ol")}}
BARRIER = {"table": {"tr", "td", "th", "p"}, "ul": {"li", "p"}, "ol": {"li", "p"}}


class Node:
    """An element. Pages nest as deep as they like, so nothing here recurses."""

    __slots__ = ("tag", "attrs", "parent", "children", "index", "counts", "table", "row", "has")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.counts: dict[str, int] = {}
        self.index = 1
        #: the table and row that an element is in
        self.table = self.row = None
        #: the tags below
        self.has: set[str] = set()
        if parent:
            self.index = parent.counts[tag] = parent.counts.get(tag, 0) + 1
            self.table = parent if parent.tag == "table" else parent.table
            self.row = parent if parent.tag == "tr" else None if parent.tag == "table" else parent.row

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                stack += reversed(x.children)
        return " ".join(out)

    def walk(self) -> Iterator[Node]:
        """All elements below, in order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            x = stack.pop()
            yield x
            stack += [c for c in reversed(x.children) if isinstance(c, Node)]

    def lineage(self) -> list[Node]:
        """From the outermost element to this one."""
        out, x = [], self
        while x and x.parent:
            out.append(x)
            x = x.parent
        return out[::-1]

    def path(self) -> str:
        return "".join(f"/{x.tag}[{x.index}]" for x in self.lineage())

    def css(self) -> str:
        return " > ".join(x.tag + (f"#{x.attrs['id']}" if x.attrs.get("id") else f":nth-of-type({x.index})") for x in self.lineage())


TOLD = {"b", "strong", "div", "section", *FINE}  # tags that elements know to be below them


class Tree(HTMLParser):
    """Closes what HTML leaves open: paragraphs, list items, rows, cells."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.hidden = 0
        self.open: dict[str, int] = {}
        self.feed(page)
        self.close()

    def up_to(self, node: Node) -> None:
        """Close all open elements below node, and tell it and those above what they held."""
        while self.at is not node:
            self.open[self.at.tag] -= 1
            self.at.parent.has |= self.at.has
            self.at = self.at.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SKIP:
            self.hidden += 1
            return
        for open_tag in CLOSES.get(tag, ()):
            up = self.at if self.open.get(open_tag) else self.root
            while up.parent and not (up.tag in BARRIER and open_tag in BARRIER[up.tag]):
                if up.tag == open_tag:
                    self.up_to(up.parent)
                    break
                up = up.parent
        new = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(new)
        if tag in TOLD:
            self.at.has.add(tag)
        if tag not in VOID:
            self.open[tag] = self.open.get(tag, 0) + 1
            self.at = new

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIP:
            self.hidden = max(0, self.hidden - 1)
            return
        if not self.open.get(tag):
            return
        up = self.at
        while up.tag != tag:
            up = up.parent
        self.up_to(up.parent)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.at.children.append(data)

    def close(self) -> None:
        super().close()
        self.up_to(self.root)


def clean(s: str) -> str:
    return re.sub(r"\s+", " ", s.replace("\xa0", " ")).strip()


#: Page numbers in attributes, and lines that are one.
PAGE_ATTRIBUTE = r"\b(?:p(?:age)?[-_]?)(\d{1,4})\b"
PAGE_LINE = r"(?i)^\s*page\s+(\d{1,4})\b"
LOOK_BACK = 8


def page_number(node: Node) -> int | None:
    """by an attribute of the element or one around it, else by a line "Page N" among the eight siblings before."""
    for n in reversed(node.lineage()):
        for name in ("id", "name", "data-page", "aria-label", "class"):
            m = re.search(PAGE_ATTRIBUTE, n.attrs.get(name, ""), re.I)
            if m:
                return int(m[1])
    around = node.parent.children if node.parent else []
    at = next((i for i, c in enumerate(around) if c is node), 0)
    for before in reversed(around[max(0, at - LOOK_BACK) : at]):
        m = re.match(PAGE_LINE, clean(before.text())) if isinstance(before, Node) else None
        if m:
            return int(m[1])
    return None


def anchor(node: Node | None) -> str | None:
    while node:
        if node.attrs.get("id") or node.attrs.get("name"):
            return node.attrs.get("id") or node.attrs.get("name")
        node = node.parent
    return None


def blocks(page: str) -> list[dict]:
    """Text blocks in order, each text once; containers only where nothing finer is inside."""
    out, seen = [], set()
    part = item = heading = None
    for n in Tree(page or "").root.walk():
        if n.tag not in BLOCKS or (n.tag in {"div", "section", "td", "th"} and n.has & {"div", "section", *FINE}):
            continue
        t = clean(n.text())
        if len(t) < 3 or t in seen:
            continue
        seen.add(t)
        bold = n.tag in {"div", "p"} and 5 <= len(t) <= 180 and bool(n.has & {"b", "strong"})
        p, i = re.match(r"(?i)^\s*part\s+([ivx]+)\b", t), re.match(r"(?i)^\s*item\s+(\d+(?:\.\d+)*[a-z]?)\b", t)
        if p:
            part, item = p[1].upper(), None
        if i:
            item = i[1].upper()
        if n.tag in {"h1", "h2", "h3", "h4"} or bold or p or i:
            heading = t
        section = " / ".join(dict.fromkeys(x for x in (f"Part {part}" if part else None, f"Item {item}" if item else None, heading) if x))
        out.append({"ord": len(out), "tag": n.tag, "text": t, "heading": heading, "part": part, "item": item, "section": section or None, "xpath": n.path(), "css_path": n.css(), "page_anchor": anchor(n), "page_no": page_number(n)})
    return out


def tables(page: str) -> list[list[list[str]]]:
    """Rows of cells of every table; cells of inner tables stay with the inner one."""
    found: dict[int, dict[int, list[str]]] = {}
    for n in Tree(page or "").root.walk():
        if n.tag == "table":
            found[id(n)] = {}
        elif n.tag == "tr" and n.table:
            found[id(n.table)][id(n)] = []
        elif n.tag in {"td", "th"} and n.row:
            found[id(n.table)].setdefault(id(n.row), []).append(clean(n.text()))
    return [[r for r in rows.values() if r] for rows in found.values()]


BLOCK_TYPE = "array<struct<ord:int,tag:string,text:string,heading:string,part:string,item:string,section:string,xpath:string,css_path:string,page_anchor:string,page_no:int>>"


def page_blocks(c: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda h: blocks(h or "")), BLOCK_TYPE)(c)


def page_tables(c: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda h: tables(h or "")), "array<array<array<string>>>")(c)


def html_blocks(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """A row a block with its place, heading, part and item."""
    own = spread(pages.select(F.col(page_id).alias("doc"), F.col(html).alias("_html")))
    return own.select("doc", F.explode(page_blocks(F.col("_html"))).alias("b")).select("doc", "b.*")


def table_cells(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """Doc, table, row, col, text."""
    own = spread(pages.select(F.col(page_id).alias("doc"), F.col(html).alias("_html")))
    t = own.select("doc", F.posexplode(page_tables(F.col("_html"))).alias("table", "rows"))
    r = t.select("doc", "table", F.posexplode("rows").alias("row", "cells"))
    return r.select("doc", "table", "row", F.posexplode("cells").alias("col", "text"))


def compact_columns(cells: DataFrame) -> DataFrame:
    """Of each table the column with most words (account) and the two latest period columns (period).

    The first row with text is the header. A period column has numbers in over half of the
    first 50 rows below, or a period as header; a table without any takes its last two
    columns, the account as well. Empty rows and columns do not count.
    """
    from siltstone.functions.numeric import is_numeric_like
    from siltstone.operators.windows import period_weight, top_k

    keys = ["doc", "table"]
    at = W.Window.partitionBy(*keys)
    filled = cells.where(F.trim("text") != "").withColumn("n", F.dense_rank().over(at.orderBy("row")) - 1)
    words = F.col("text").rlike("[A-Za-z]") & ~is_numeric_like("text")
    rows = filled.groupBy(*keys).agg(F.least(F.max("n"), F.lit(50)).alias("rows"))
    by_col = filled.groupBy(*keys, "col").agg(F.count_if((F.col("n") <= 50) & words).alias("words"), F.count_if(F.col("n").between(1, 50) & is_numeric_like("text")).alias("numeric"), F.min_by("text", "row").alias("header"))
    account = by_col.groupBy(*keys).agg(F.min_by("col", F.struct((-F.col("words")).alias("n"), "col")).alias("account"))
    every = by_col.join(account, keys).join(rows, keys).withColumn("weight", period_weight("header"))
    dated = (F.col("col") != F.col("account")) & ((F.col("numeric") / F.greatest("rows", F.lit(1)) > 0.5) | (F.col("weight") > 0))
    marked = every.withColumns({"dated": dated, "any": F.max(dated).over(at), "back": F.row_number().over(at.orderBy(F.desc("col")))})
    candidates = marked.where(F.col("dated") | (~F.col("any") & (F.col("back") <= 2)))
    period = top_k(candidates, keys, [F.desc("weight"), F.desc("col")], 2).select(*keys, "col", F.lit("period").alias("kind"))
    return account.select(*keys, F.col("account").alias("col"), F.lit("account").alias("kind")).unionByName(period)


def markdown_table(cells: DataFrame, max_rows: int = 120, max_cols: int = 6) -> DataFrame:
    """Doc, table and markdown of its first rows and columns."""
    some = cells.where((F.col("row") < max_rows) & (F.col("col") < max_cols))
    row = some.groupBy("doc", "table", "row").agg(F.concat(F.lit("| "), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda x: x["text"]), " | "), F.lit(" |")).alias("line"))
    return row.groupBy("doc", "table").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda x: x["line"]), "\n").alias("markdown"))
