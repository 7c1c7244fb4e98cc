"""Keys from addresses (EXT3), link kinds (EXT4), last pages (AGG4), label rules (FLT1, FLT2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.scale import once, top_n
from ..functions.text import none_if_blank, squeeze
from ..functions.urls import host, path, query_value


def derive_keys(links: DataFrame, url: str = "url", id_parameter: str = "t",
                listing_parameter: str = "f") -> DataFrame:
    """Stable keys of a link target.

    ``external_id`` is the query parameter if numeric, else the trailing number
    of the path, else the path, else the address. ``listing_id`` is the listing
    parameter if numeric, ``series_id`` the number under /series/ or /cycle/.
    """
    p = F.col("_path")  # a column, so that its expression is computed once and not once for each key
    number = lambda c: F.when(c.rlike(r"^\d+$"), c)
    return links.withColumn("_path", path(F.col(url))).withColumns({
        "host": host(F.col(url)),
        "external_id": F.coalesce(
            number(query_value(F.col(url), id_parameter)),
            F.nullif(F.regexp_extract(p, r"/(\d+)/?$", 1), F.lit("")),
            F.nullif(F.regexp_replace(p, r"^/+|/+$", ""), F.lit("")),
            F.col(url)),
        "listing_id": number(query_value(F.col(url), listing_parameter)),
        "series_id": F.nullif(F.regexp_extract(p, r"/(?:index\.php/)?(?:series|cycle)/(\d+)(?:/|$)", 1),
                              F.lit("")),
    }).drop("_path")


def good_labels(df: DataFrame, col: str, stop_labels: Sequence[str] = tuple(fixed.STOP_LABELS), squeezed: bool = False) -> DataFrame:
    return df.where(is_good_label(F.col(col), stop_labels, squeezed))


def is_good_label(c: Column, stop_labels: Sequence[str] = tuple(fixed.STOP_LABELS), squeezed: bool = False) -> Column:
    """Not empty, at most 160 characters, not all digits, not a caption; ``squeezed`` text is not squeezed again."""
    text = c if squeezed else squeeze(c)
    return ((text != "") & (F.length(text) <= fixed.LABEL_MAX_LENGTH)
            & ~text.rlike(r"^\d+$") & ~F.lower(text).isin(list(stop_labels)))


def title_anchor_filter(links: DataFrame, allowed_hosts: Sequence[str] = (), exact_path: str | None = None,
                        text: str = "text", url: str = "url") -> DataFrame:
    """Textual links to item pages: no numbers, no generic captions, at most 300 characters."""
    read = {"_text": squeeze(F.col(text)), "_path": path(F.col(url)), **({"_host": host(F.col(url))} if allowed_hosts else {})}
    t, p = F.col("_text"), F.col("_path")
    keep = ((t != "") & ~t.rlike(r"^\d+$") & (F.length(t) <= fixed.TITLE_LINK_MAX_LENGTH)
            & ~F.lower(t).isin(fixed.GENERIC_TITLE_LINKS) & p.rlike(r"^/\d+/?$"))
    if allowed_hosts:
        h = F.col("_host")
        below = F.lit(False)
        for name in allowed_hosts:
            below = below | h.endswith(name)
        keep = keep & F.coalesce(below, F.lit(False))
    if exact_path is not None:
        keep = keep & (F.regexp_replace(p, r"/+$", "") == exact_path.rstrip("/"))
    return once(links, read).where(keep).drop(*read)


def distinct_list(df: DataFrame, keys: Sequence[str], value: str, order: str, limit: int | None = None,
                  fold: bool = False) -> DataFrame:
    """Order-preserving distinct values per key, at most ``limit`` (AGG2).

    Distinct is an aggregate with map-side combine; the limit is a partial
    top-N. The result stays in rows, so a long list never becomes one array.
    """
    same = F.lower(F.col(value)) if fold else F.col(value)
    distinct = (df.where(F.col(value).isNotNull()).withColumn("_same", same)
                .groupBy(*keys, "_same")
                .agg(F.min(order).alias(order), F.min_by(value, order).alias(value)).drop("_same"))
    return distinct if limit is None else top_n(distinct, keys, [F.col(order)], limit)


def classify_links(links: DataFrame, rules: Sequence[tuple[str, str, int]] = tuple(fixed.CARD_LINK_RULES),
                   keys: Sequence[str] = ("page_id",), text: str = "text", href: str = "href",
                   order: str = "seq", mode: str = "contains") -> DataFrame:
    """Links by kind with at most N distinct labels per key and kind (EXT4).

    The rules are a literal array filtered per row, so there is no join; each
    kind keeps the limit of its rule.
    """
    table = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(p).alias("pattern"), F.lit(n).alias("keep"))
                      for k, p, n in rules])

    def hit(rule: Column) -> Column:
        if mode == "contains":
            return F.contains(F.col(href), rule["pattern"])
        return (F.startswith(path(F.col(href)), rule["pattern"])
                | F.startswith(path(F.col(href)), F.concat(F.lit("/index.php"), rule["pattern"])))

    # Only links that a rule wants are squeezed, and once: below a generator no filter repeats it.
    found = links.select(*keys, F.col(order).alias("ord"), F.col(text).alias("_text"), F.inline(F.filter(table, hit)))
    tagged = once(found, {"label": squeeze(F.col("_text"))}).drop("_text")
    tagged = good_labels(tagged, "label", squeezed=True) if mode == "contains" else tagged.where(
        none_if_blank(F.col("label")).isNotNull())
    most = max(n for _, _, n in rules)
    limits = tagged.withColumn("_kind", F.struct("kind", "keep"))
    kept = distinct_list(limits, [*keys, "_kind"], "label", "ord", None, fold=mode != "contains")
    ranked = top_n(kept, [*keys, "_kind"], [F.col("ord")], most, rank="rank")
    return ranked.where(F.col("rank") <= F.col("_kind.keep")).select(
        *keys, F.col("_kind.kind").alias("kind"), "rank", "label")


def last_page_per_listing(links: DataFrame, keys: Sequence[str], page_host: Column | None = None,
                          href: str = "href", text: str = "text", page_size: int = 50,
                          previous: DataFrame | None = None) -> DataFrame:
    """Largest page number that the pager of each listing mentions (AGG4).

    Reads ``/p<N>`` paths, ``p=`` and ``page=`` parameters, ``start=`` offsets
    and "page x of y" texts of same-host links; never below 1. ``previous``
    (keys + last_page) keeps the known value where the page shows 1 only.
    """
    link, label = F.col(href), F.coalesce(F.col(text), F.lit(""))
    whole = lambda c: c.try_cast("int")
    same_host = F.lit(True)
    if page_host is not None:
        same_host = F.coalesce(host(link) == page_host, F.lit(True))
    numbers = [
        whole(F.regexp_extract(path(link), r"/p(\d+)/?$", 1)),
        whole(query_value(link, "p")), whole(query_value(link, "page")),
        (F.floor(F.greatest(whole(query_value(link, "start")), F.lit(0)) / page_size) + 1).cast("int"),
        F.when(query_value(link, "start").isNotNull() & label.rlike(r"^\d+$"), whole(label)),
        *[F.array_max(F.transform(F.regexp_extract_all(label, F.lit(p), 1), lambda x: x.try_cast("int")))
          for p in fixed.LAST_PAGE_TEXTS],
    ]
    seen = links.where(same_host).select(*keys, F.coalesce(F.greatest(*numbers), F.lit(1)).alias("_page"))
    last = seen.groupBy(*keys).agg(F.greatest(F.max("_page"), F.lit(1)).alias("last_page"))
    if previous is None:
        return last
    known = previous.select(*keys, F.col("last_page").alias("_known"))
    return last.join(known, list(keys), "left").select(
        *keys, F.when((F.col("last_page") == 1) & (F.col("_known") > 1), F.col("_known"))
        .otherwise(F.col("last_page")).alias("last_page"))
