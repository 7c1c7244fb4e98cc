"""Listing pages to rows: cards by document order (EXT5) and tables (EXT6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed
from ..functions.measures import clock_duration
from ..functions.scale import first_by, ordered_text
from ..functions.text import squeeze
from ..functions.urls import absolute, path
from ..session import durable
from .links import classify_links, derive_keys, is_good_label
from .nodes import LINK, TEXT, Scope, attr, has_class, in_page_order, mark_owner, page_nodes, with_scopes


def listing_segments(nodes: DataFrame, pages: DataFrame, allowed_hosts: Sequence[str] = ()) -> DataFrame:
    """Links and texts of listing pages with the title anchor that owns them.

    Each title anchor owns what follows it up to the next title anchor; a
    repeated anchor ends a segment without starting a card. One pass over the
    nodes: a link with its texts is one row, every other text is a row.
    """
    is_link = (F.col("tag") == "a") & attr("href").isNotNull()
    linked = with_scopes(nodes, [LINK]).where(is_link | (F.col("tag") == TEXT))
    piece = F.when(F.col("tag") == TEXT, F.nullif(squeeze("text"), F.lit("")))
    units = linked.withColumn("_piece", piece).groupBy(
        "page_id", F.coalesce("_link", "seq").alias("seq")).agg(
        F.max(attr("href")).alias("href"), squeeze(ordered_text("_piece", "seq")).alias("text"))
    based = units.join(pages.select("page_id", F.col("url").alias("_base")), "page_id")
    keyed = derive_keys(based.withColumn("url", F.when(F.col("href").isNotNull(), absolute(F.col("_base"), F.col("href")))))
    item_path = F.coalesce(path(F.col("url")).rlike(r"^/\d+/?$"), F.lit(False))
    if allowed_hosts:
        ok = F.lit(False)
        for name in allowed_hosts:
            ok = ok | F.coalesce(F.col("host").endswith(name), F.lit(False))
        item_path = item_path & ok
    texted = F.coalesce((F.col("text") != "") & ~F.col("text").rlike(r"^\d+$"), F.lit(False))
    is_title = (F.col("_break") & (F.length("text") <= fixed.TITLE_LINK_MAX_LENGTH)
                & ~F.lower("text").isin(fixed.GENERIC_TITLE_LINKS))
    first_of_id = F.min(F.when(F.col("_title"), F.col("seq"))).over(Window.partitionBy("page_id", "external_id"))
    starts = keyed.withColumn("_break", item_path & texted).withColumn("_title", is_title).withColumn(
        "_start", F.col("_title") & (F.col("seq") == first_of_id))
    opener = F.last(F.when(F.col("_break"), F.struct("seq", F.col("_start").alias("real"))), ignorenulls=True)
    owned = starts.withColumn("_open", opener.over(in_page_order())).where(F.col("_open.real"))
    return owned.select("page_id", F.col("_open.seq").alias("card"), "seq", "href", "text", "url", "external_id", "series_id")


def listing_cards(segments: DataFrame) -> DataFrame:
    """One row per card with at least one signal: author, narrator, genre or duration."""
    kind = F.coalesce(*[F.when(F.contains("href", F.lit(p)), F.lit(k)) for k, p, _ in fixed.CARD_LINK_RULES])
    inside = (F.col("seq") > F.col("card")) & F.col("href").isNotNull() & is_good_label(F.col("text"), squeezed=True)
    tagged = segments.withColumn("_kind", F.when(inside, kind))
    named = F.when(F.col("_kind") == "series", F.col("seq"))
    cards = tagged.groupBy("page_id", "card").agg(
        F.min_by("external_id", "seq").alias("external_id"), F.min_by("url", "seq").alias("external_url"),
        F.min_by("text", "seq").alias("title"),
        ordered_text("text", "seq").alias("_text"), F.count_if(F.col("_kind") != "series").alias("_signals"),
        F.min_by("text", named).alias("series_name"),
        F.min_by("series_id", F.when(F.col("series_id").isNotNull(), named)).alias("series_id"))
    timed = cards.where(is_good_label(F.col("title"), squeezed=True)).withColumn("duration_seconds", clock_duration(F.col("_text")))
    return timed.where((F.col("_signals") > 0) | (F.col("duration_seconds") > 0)).drop("_signals", "_text")


def listing_labels(segments: DataFrame) -> DataFrame:
    """``(page_id, card, kind, rank, label)``: the labels of every segment."""
    inside = segments.where(F.col("href").isNotNull() & (F.col("seq") > F.col("card")))
    return classify_links(inside, keys=("page_id", "card"))


def segment_listing(nodes: DataFrame, pages: DataFrame,
                    allowed_hosts: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """EXT5: cards of a listing page and their labels, from segments kept once."""
    segments = durable(listing_segments(nodes, pages, allowed_hosts))
    return listing_cards(segments), listing_labels(segments)


def child_index(nodes: DataFrame, name: str = "child") -> DataFrame:
    """1-based position of each element among its parent's elements."""
    order = (Window.partitionBy("page_id", "parent_seq").orderBy("seq")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return nodes.withColumn(name, F.count_if(~F.col("tag").startswith("#")).over(order))


def row_scopes(row: Scope, cells: Mapping[str, Scope]) -> tuple[Scope, Scope]:
    """Owners that listing tables are read by: the row, and the outermost of its cells."""
    return replace(row, name="row"), Scope("_cell", inside="row", any_of=tuple(cells.values()))


def extract_table_rows(nodes: DataFrame, row_scope: Column | Scope, cells: Mapping[str, Column | Scope],
                       attributes: Mapping[str, tuple[str, str]] | None = None,
                       required: Sequence[str] = (), flags: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows of a listing table.

    ``cells`` names element predicates; each yields the text of its first
    element inside the row. ``attributes`` maps an output column to (cell,
    attribute). Rows lacking a ``required`` cell are dropped. ``flags`` tells
    whether any node of the row passes a predicate, in a cell or not. Rows and
    cells that are scopes need no window if the nodes have :func:`row_scopes`.
    """
    tests = {name: pred.column() if isinstance(pred, Scope) else pred for name, pred in cells.items()}
    tagged = nodes.withColumn("_kind", F.coalesce(*[F.when(pred, F.lit(name)) for name, pred in tests.items()]))
    if isinstance(row_scope, Scope):
        owned = with_scopes(tagged, row_scopes(row_scope, cells)).where(F.col("row").isNotNull())
    else:
        owned = mark_owner(tagged, row_scope, "row").where(F.col("row").isNotNull())
        owned = mark_owner(owned, F.col("_kind").isNotNull(), "_cell")
    seen = {f"_flag_{name}": F.coalesce(pred, F.lit(False)) for name, pred in (flags or {}).items()}
    worth = F.lit(False)
    for pred in seen.values():
        worth = worth | pred
    texts = owned.where(F.col("_cell").isNotNull() | worth).withColumn(
        "_piece", F.when((F.col("tag") == TEXT) & F.col("_cell").isNotNull(), F.nullif(squeeze("text"), F.lit("")))) \
        .groupBy("page_id", "row", "_cell").agg(
            ordered_text("_piece", "seq").alias("value"), F.min_by("_kind", "seq").alias("_kind"),
            F.min_by("attrs", "seq").alias("_attrs"), *[F.bool_or(pred).alias(name) for name, pred in seen.items()])
    outputs = [F.min_by(F.coalesce(squeeze("value"), F.lit("")), F.when(F.col("_kind") == name, F.col("_cell")))
               .alias(name) for name in cells]
    outputs += [F.min_by(F.col("_attrs")[a], F.when(F.col("_kind") == cell, F.col("_cell"))).alias(out)
                for out, (cell, a) in (attributes or {}).items()]
    outputs += [F.bool_or(f"_flag_{name}").alias(name) for name in flags or {}]
    rows = texts.groupBy("page_id", "row").agg(*outputs)
    for name in required:
        rows = rows.where(F.col(name).isNotNull())
    return rows


def unique_rows(rows: DataFrame, keys: Sequence[str], order: str = "row") -> DataFrame:
    """The first row of each key, such as an item that a listing repeats."""
    return first_by(rows, keys, [F.col(order)])


SEARCH_ROW = Scope("row", ("tr",))
SEARCH_CELLS = {"title": Scope("title", cls="tLink"), "size": Scope("size", cls="tor-size"),
                "seeds": Scope("seeds", ("td",), child=7), "leeches": Scope("leeches", ("td",), child=8)}


def search_nodes(pages: DataFrame) -> DataFrame:
    """Nodes of search pages as :func:`search_rows` reads them."""
    return page_nodes(pages, scopes=row_scopes(SEARCH_ROW, SEARCH_CELLS), within="row",
                      attrs=("class", "href", "data-ts_text"), numbered=True)


def search_rows(nodes: DataFrame) -> DataFrame:
    """Rows of the search layout, whose counters are known by column number only.

    The exact size is an attribute of its cell; without it the cell's text
    counts. Rows without a title or a download link are dropped. Nodes from
    :func:`search_nodes` need no window.
    """
    numbered = nodes if "child" in nodes.columns else child_index(nodes)
    rows = extract_table_rows(
        numbered, SEARCH_ROW, SEARCH_CELLS, {"href": ("title", "href"), "exact_size": ("size", "data-ts_text")},
        required=["title"], flags={"download": has_class("tr-dl")})
    return rows.where("download").drop("download").withColumn(
        "size", F.coalesce(F.nullif("exact_size", F.lit("")), "size"))


def counter(text: Column, age_word: str | None = None) -> Column:
    """A counter cell; with ``age_word``, a cell that shows an age instead counts as 0."""
    digits = F.regexp_extract(F.replace(F.coalesce(text, F.lit("")), F.lit(" "), F.lit("")), r"(\d+)", 1)
    number = F.coalesce(digits.try_cast("long"), F.lit(0).cast("long"))
    return number if age_word is None else F.when(F.contains(F.lower(text), F.lit(age_word)), F.lit(0).cast("long")).otherwise(number)


def has_href(fragment: str) -> Column:
    return F.coalesce((F.col("tag") == "a") & F.contains(attr("href"), F.lit(fragment)), F.lit(False))
