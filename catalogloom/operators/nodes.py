"""Node tables: a page becomes rows (EXT1), and rows answer selector questions.

A page is one input row, so everything windowed by ``page_id`` is bounded by the
size of one document. Node tables are hash-partitioned by ``page_id`` once; the
windows and aggregates below reuse that exchange.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate, compress, repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scale import ordered_text
from ..functions.text import squeeze
from ..functions.urls import absolute
from ..session import durable

NODE_SCHEMA = ("page_id bigint, seq int, end_seq int, depth int, parent_seq int, tag string, "
               "attrs map<string,string>, text string")
TEXT, RAW = "#text", "#raw"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track"}
#: Nodes that a task holds before it passes them on, and pages whose texts it unpacks at once.
_FLUSH_ROWS, _PAGES = 8_192, 64
_ARROW = pa.schema([
    ("page_id", pa.int64()), ("seq", pa.int32()), ("end_seq", pa.int32()), ("depth", pa.int32()),
    ("parent_seq", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string())])


@dataclass(frozen=True)
class Scope:
    """Elements that own what is inside them, told by tag, class or attribute.

    Only the outermost such element counts: inside another scope if ``inside``
    names one, and only as a child of that scope's element if ``child_of`` does.
    ``value`` is a part of the attribute's value, ``prefix`` its start, ``child`` the element's place
    among the elements of its parent (in a column ``child`` of nodes that are
    ``numbered``), ``any_of`` alternatives of which an element passes one.
    The tokenizer knows the open scopes at each node, so a node carries its
    owner (``seq`` of that element, null without one) in a column of this name.
    """

    name: str
    tags: tuple[str, ...] = ()
    cls: str = ""
    attr: str = ""
    inside: str = ""
    child_of: str = ""
    value: str = ""
    prefix: str = ""
    child: int = 0
    any_of: tuple[Scope, ...] = ()

    def may(self, tag: str) -> bool:
        return (not self.tags or tag in self.tags) and (not self.any_of or any(s.may(tag) for s in self.any_of))

    def fits(self, tag: str, attrs: dict[str, str], child: int) -> bool:
        """The tests of the element alone; its tag may be any of another alternative."""
        return ((not self.tags or tag in self.tags) and (not self.cls or self.cls in attrs.get("class", "").split())
                and (not self.attr or self.attr in attrs) and (not self.value or self.value in attrs.get(self.attr, ""))
                and attrs.get(self.attr, "").startswith(self.prefix)
                and (not self.child or child == self.child)
                and (not self.any_of or any(s.fits(tag, attrs, child) for s in self.any_of)))

    def column(self) -> Column:
        """The same test on a node table."""
        test = F.col("tag").isin(*self.tags) if self.tags else ~F.col("tag").startswith("#")
        if self.any_of:
            test = test & reduce(lambda one, two: one | two, [s.column() for s in self.any_of])
        test = test & F.coalesce(F.contains(attr(self.attr), F.lit(self.value)), F.lit(False)) if self.value else test
        test = test & F.coalesce(F.startswith(attr(self.attr), F.lit(self.prefix)), F.lit(False)) if self.prefix else test
        test = test & (F.col("child") == self.child) if self.child else test
        test = test & has_class(self.cls) if self.cls else test
        test = test & attr(self.attr).isNotNull() if self.attr else test
        test = test & F.col(self.inside).isNotNull() if self.inside else test
        return test & (F.col("parent_seq") == F.col(self.child_of)) if self.child_of else test


#: Links, as listing pages are read by them.
LINK = Scope("_link", ("a",), attr="href")


class _Flattener(HTMLParser):
    """Pre-order numbering of one page; an end tag closes to its nearest opener."""

    def __init__(self, scopes: Sequence[Scope] = ()):
        super().__init__(convert_charrefs=True)
        self.tags, self.attrs, self.texts = [], [], []
        self.ends, self.depths, self.parents, self.open, self.owners = [], [], [], [], []
        self.scopes, self.place = scopes, {s.name: i for i, s in enumerate(scopes)}
        self.by_tag: dict[str, list[tuple[int, Scope]]] = {}
        self.now: tuple[int | None, ...] = (None,) * len(scopes)
        self.children: list[int] = []
        self.counts: dict[int, int] = {}

    def _owned(self, tag: str, attrs: dict[str, str], seq: int, parent: int, child: int) -> tuple[int | None, ...]:
        """The owners of a new element."""
        able = self.by_tag.get(tag)
        if able is None:
            able = self.by_tag[tag] = [(i, s) for i, s in enumerate(self.scopes) if s.may(tag)]
        if not able:
            return self.now
        now = list(self.now)
        for i, s in able:
            if (now[i] is None and s.fits(tag, attrs, child) and (not s.inside or now[self.place[s.inside]] is not None)
                    and (not s.child_of or now[self.place[s.child_of]] == parent)):
                now[i] = seq
        return tuple(now)

    def _add(self, tag, attrs, text):
        parent = self.open[-1][1] if self.open else 0
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.texts.append(text)
        self.ends.append(len(self.tags))
        self.depths.append(len(self.open))
        self.parents.append(parent)
        child = self.counts.get(parent, 0) + (attrs is not None)
        self.counts[parent] = child
        self.children.append(child)
        self.owners.append(self._owned(tag, dict(attrs), len(self.tags), parent, child) if self.scopes and attrs is not None else self.now)

    def handle_starttag(self, tag, attrs):
        if tag == "wbr":
            return
        self._add(tag, list({k: v or "" for k, v in attrs}.items()), None)
        if tag not in _VOID:
            self.open.append((tag, len(self.tags), self.now))
            self.now = self.owners[-1]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return

    def handle_data(self, data):
        kind = RAW if self.open and self.open[-1][0] in ("script", "style") else TEXT
        parent = self.open[-1][1] if self.open else 0
        if self.tags and self.tags[-1] == kind and self.parents[-1] == parent:
            self.texts[-1] += data
        else:
            self._add(kind, None, data)

    def _close(self, at: int):
        for _, seq, _ in self.open[at:]:
            self.ends[seq - 1] = len(self.tags)
        if at < len(self.open):
            self.now = self.open[at][2]
        del self.open[at:]

    def finish(self):
        self.close()
        self._close(0)
        return self


# Plain markup, in which any parser sees the same tokens: text, end tags, scripts and styles, start tags with
# quoted attributes, titles, a document type, short comments. The last group is whatever else there is.
_REFERENCE = r"&(?:amp|lt|gt|quot|nbsp|copy|middot|#39);"
_PLAIN = re.compile(
    rf"([^<&]+(?:{_REFERENCE}[^<&]*)*|(?:{_REFERENCE}[^<&]*)+)"
    r"|</([a-zA-Z][a-zA-Z0-9]*)>"
    r"|<(script|style)>([^<]*(?:<(?!!--|/[ \t\n\r\f]*(?i:script|style))[^<]*)*)</\3>"
    r"|<(?!(?i:script|style|title|textarea|iframe|noembed|noframes|noscript|xmp|plaintext)\b)([a-zA-Z][a-zA-Z0-9]*)"
    rf"""((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9_-]*=(?:"[^"<>&]*(?:{_REFERENCE}[^"<>&]*)*"|'[^'<>&]*(?:{_REFERENCE}[^'<>&]*)*'))*)[ \t\n\r\f]*>"""
    rf"|<(title)>([^<&]*(?:{_REFERENCE}[^<&]*)*)</title>"
    r"|<!(?:doctype|DOCTYPE) [a-zA-Z]+>|<!--[^<>-]+-->"
    r"|([\s\S])")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9_-]*)=(?:"([^"]*)"|'([^']*)')""")


def _read_plain(page: _Flattener, html: str) -> bool:
    """Fill ``page`` from plain markup, several times faster than the parser; false, with nothing done, if there is any other."""
    found = _PLAIN.findall(html)
    if any(token[8] for token in found):
        return False
    tags, attributes, texts, ends = page.tags, page.attrs, page.texts, page.ends
    depths, parents, owners, opened, children, counts = page.depths, page.parents, page.owners, page.open, page.children, page.counts
    scoped, now, seq, parent = bool(page.scopes), page.now, 0, 0
    for text, closed, raw, inner, tag, listed, title, shown, _ in found:
        if text:
            if "&" in text:
                text = unescape(text)
            if seq and tags[-1] == TEXT and parents[-1] == parent:
                texts[-1] += text
                continue
            new, pairs, own, child = TEXT, None, now, counts.get(parent, 0)
        elif tag or raw or title:
            new, text, pairs = (tag or raw or title).lower(), None, []
            if new == "wbr":
                continue
            if listed:
                pairs = list({k.lower(): one or two for k, one, two in _ATTRIBUTE.findall(listed)}.items())
                if "&" in listed:
                    pairs = [(k, unescape(v)) for k, v in pairs]
            child = counts[parent] = counts.get(parent, 0) + 1
            own = page._owned(new, dict(pairs), seq + 1, parent, child) if scoped else now
        elif closed:
            closed = closed.lower()
            for at in range(len(opened) - 1, -1, -1):
                if opened[at][0] == closed:
                    for _, start, _ in opened[at:]:
                        ends[start - 1] = seq
                    page.now = now = opened[at][2]
                    del opened[at:]
                    parent = opened[-1][1] if opened else 0
                    break
            continue
        else:
            continue
        seq += 1
        tags.append(new)
        attributes.append(pairs)
        texts.append(text)
        ends.append(seq)
        depths.append(len(opened))
        parents.append(parent)
        children.append(child)
        owners.append(own)
        if raw or title:
            data = inner if raw else unescape(shown)
            if data:
                seq += 1
                tags.append(RAW if raw else TEXT)
                attributes.append(None)
                texts.append(data)
                ends.append(seq)
                ends[-2] = seq
                depths.append(len(opened) + 1)
                parents.append(seq - 1)
                children.append(0)
                owners.append(own)
        elif tag and new not in _VOID:
            opened.append((new, seq, now))
            page.now = now = own
            parent = seq
    page._close(0)
    return True


def _map_array(values: list) -> pa.Array:
    """Lists of pairs, or nulls, as maps."""
    ends = [0, *accumulate(len(pairs) if pairs else 0 for pairs in values)]
    flat = [pair for pairs in values if pairs for pair in pairs]
    starts = [end if pairs is not None else None for pairs, end in zip(values, ends)]
    return pa.MapArray.from_arrays(pa.array([*starts, ends[-1]], pa.int32()), pa.array([k for k, _ in flat], pa.string()),
                                   pa.array([v for _, v in flat], pa.string()))


def _flatten(batches: Iterator[pa.RecordBatch], scopes: Sequence[Scope], within: str,
             wanted: frozenset[str] | None, numbered: bool = False) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*_ARROW, *[(s.name, pa.int32()) for s in scopes], *([("child", pa.int32())] if numbered else [])])
    by_tag: dict[str, list[tuple[int, Scope]]] = {}
    columns: list[list] = [[] for _ in schema]
    inside = next((i for i, s in enumerate(scopes) if s.name == within), None)

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [_map_array(values) if pa.types.is_map(field.type) else pa.array(values, type=field.type)
             for values, field in zip(columns, schema)], schema=schema)
        for values in columns:
            values.clear()
        return out

    for batch in (batch.slice(low, _PAGES) for batch in batches for low in range(0, batch.num_rows, _PAGES)):
        for page_id, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = _Flattener(scopes)
            page.by_tag = by_tag if len(by_tag) < _FLUSH_ROWS else {}
            if not _read_plain(page, html or ""):
                page.feed(html or "")
                page.finish()
            size = len(page.tags)
            if wanted is not None:
                page.attrs = [x and [p for p in x if p[0] in wanted] for x in page.attrs]
            made = [repeat(page_id, size), range(1, size + 1), page.ends, page.depths, page.parents, page.tags, page.attrs, page.texts]
            made += zip(*page.owners) if size else []
            if numbered and size:
                made.append(page.children)
            if inside is not None:
                keep = [owners[inside] is not None for owners in page.owners]
                made = [list(compress(values, keep)) for values in made]
            for values, more in zip(columns, made):
                values.extend(more)
            if len(columns[0]) >= _FLUSH_ROWS:
                yield flush()
    if columns[0]:
        yield flush()


def page_nodes(pages: DataFrame, keep: bool = False, scopes: Sequence[Scope] = (), within: str = "",
               attrs: Sequence[str] | None = None, numbered: bool = False) -> DataFrame:
    """``(page_id, html)`` to the node table, hash-partitioned by page.

    ``scopes`` adds a column of owners for each, ``numbered`` the place
    ``child`` of an element among its parent's (:func:`listing.child_index`). ``within`` keeps only the nodes
    inside the scope of that name, and ``attrs`` only the attributes so named,
    so that what nobody reads is not shuffled. ``keep`` writes the table to
    reliable checkpoint storage: set it when several operators read the same
    nodes, so that pages are tokenized once.
    """
    schema = NODE_SCHEMA + "".join(f", {s.name} int" for s in scopes)
    schema += ", child int" if numbered else ""
    work = partial(_flatten, scopes=tuple(scopes), within=within, wanted=None if attrs is None else frozenset(attrs), numbered=numbered)
    found = pages.select("page_id", "html").mapInArrow(work, schema).repartition("page_id")
    return durable(found) if keep else found


def with_scopes(nodes: DataFrame, scopes: Sequence[Scope]) -> DataFrame:
    """Nodes with the owner columns of all scopes; those that the tokenizer did not give are found by windows."""
    for s in scopes:
        if s.name not in nodes.columns:
            nodes = mark_owner(nodes, s.column(), s.name)
    return nodes


def in_page_order() -> Window:
    return (Window.partitionBy("page_id").orderBy("seq")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def has_class(name: str) -> Column:
    return F.coalesce(F.array_contains(F.split(F.col("attrs")["class"], r"\s+"), name), F.lit(False))


def attr(name: str) -> Column:
    return F.col("attrs")[name]


def mark_owner(nodes: DataFrame, scope: Column, name: str) -> DataFrame:
    """Column ``name``: seq of the outermost ``scope`` element around each node.

    Element intervals nest, so among the scopes opened so far the one with the
    largest end (earliest first) either still covers the node or nothing does:
    one running maximum instead of an interval join.
    """
    best = F.max(F.when(scope, F.struct("end_seq", (-F.col("seq")).alias("neg")))).over(in_page_order())
    return nodes.withColumn(name, F.when(best["end_seq"] >= F.col("seq"), -best["neg"]))


def inside(nodes: DataFrame, scope: Column) -> DataFrame:
    """Semi-join on node intervals: nodes of (and including) the scope elements."""
    return mark_owner(nodes, scope, "_owner").where(F.col("_owner").isNotNull()).drop("_owner")


def outside(nodes: DataFrame, scope: Column) -> DataFrame:
    return mark_owner(nodes, scope, "_owner").where(F.col("_owner").isNull()).drop("_owner")


def element_texts(nodes: DataFrame, scope: Column | Scope, keep_raw: bool = False) -> DataFrame:
    """One row per scope element: its attributes and its text in document order.

    A :class:`Scope` that the tokenizer knew needs no window.
    """
    if isinstance(scope, Scope):
        owned = with_scopes(nodes, [scope]).where(F.col(scope.name).isNotNull()).withColumn("element", F.col(scope.name))
    else:
        owned = mark_owner(nodes, scope, "element").where(F.col("element").isNotNull())
    kinds = [TEXT, RAW] if keep_raw else [TEXT]
    piece = F.when(F.col("tag").isin(kinds), F.nullif(squeeze(F.col("text")), F.lit("")))
    grouped = owned.withColumn("_piece", piece).groupBy("page_id", "element").agg(
        ordered_text("_piece", "seq").alias("text"),
        F.min_by("attrs", "seq").alias("attrs"), F.min_by("tag", "seq").alias("tag"),
        F.max("end_seq").alias("end_seq"))
    return grouped.withColumn("text", squeeze(F.col("text")))


def page_text(nodes: DataFrame) -> DataFrame:
    """Whole visible text of each page."""
    pieces = nodes.where(F.col("tag") == TEXT).withColumn("_piece", squeeze(F.col("text")))
    return pieces.groupBy("page_id").agg(
        ordered_text("_piece", "seq").alias("text")).withColumn("text", squeeze(F.col("text")))


def extract_links(nodes: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """All ``a[href]`` in document order with cleaned text (EXT2).

    With ``pages`` the address is resolved against the page's own.
    """
    links = element_texts(nodes, LINK).select(
        "page_id", F.col("element").alias("seq"), "end_seq", F.col("attrs")["href"].alias("href"), "text")
    if pages is None:
        return links
    return links.join(pages.select("page_id", F.col("url").alias("_base")), "page_id").withColumn(
        "url", absolute(F.col("_base"), F.col("href"))).drop("_base")


def extract_links_from_text(pages: DataFrame) -> DataFrame:
    """The same links straight from page text, for pages with flat anchors.

    No Python and no node table: the cheap path when only links are wanted.
    """
    # Fixed value: a flat anchor.
    anchor = r"<a\s[^>]*?href=\"([^\"]*)\"[^>]*>([^<]*)</a>"
    href = F.regexp_extract_all("html", F.lit(anchor), 1)
    text = F.regexp_extract_all("html", F.lit(anchor), 2)
    pairs = pages.select("page_id", F.col("url").alias("_base"),
                         F.posexplode(F.arrays_zip(href.alias("href"), text.alias("text"))).alias("ord", "l"))
    return pairs.select(
        "page_id", (F.col("ord") + 1).alias("pos"), F.col("l.href").alias("href"),
        squeeze(F.col("l.text")).alias("text"), absolute(F.col("_base"), F.col("l.href")).alias("url"))
