"""Playable parts from playlists (SRC3) and from objects embedded in pages (SRC4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scale import first_by
from ..functions.text import none_if_blank, squeeze
from ..functions.urls import absolute, first_web_url

# Shape of embedded part objects and of quoted media addresses.
PART_OBJECT = r'(?s)(\{[^{}]*?"fileId"\s*:\s*\d+[^{}]*\})'
QUOTED_MEDIA = r"""(?i)["']((?:https?:)?(?:\\?/\\?/)[^"'\s]+?\.mp3(?:\?[^"'\s]*)?)["']"""
PART_FIELDS = "struct<fileId:string,title:string,src:string,duration:string>"
PLAYLIST_ITEM = "struct<id:string,title:string,file:string>"


def unescape_entities(c: Column) -> Column:
    """The entities that occur in titles; the ampersand last."""
    out = c
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&nbsp;", " "), ("&amp;", "&")]:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def explode_playlist(df: DataFrame, key: str, json_col: str, default_title: str = "Глава") -> DataFrame:
    """Playlist JSON to parts.

    An element that is not an object, has no id or no usable address is skipped
    but still consumes a number: ``source_position`` has gaps, ``position`` is
    dense. A playlist belongs to one item row, so its window is bounded.
    """
    payload = F.transform(
        F.from_json(F.col(json_col), "array<string>"), lambda s: F.from_json(s, PLAYLIST_ITEM))
    rows = df.select(F.col(key), F.posexplode(payload).alias("ord", "part"))
    number = (F.col("ord") + 1).cast("int")
    usable = rows.select(
        key, number.alias("source_position"),
        none_if_blank(squeeze(F.col("part.id"))).alias("part_id"),
        F.coalesce(none_if_blank(squeeze(F.col("part.title"))),
                   F.concat(F.lit(default_title + " "), number.cast("string"))).alias("title"),
        first_web_url(F.col("part.file")).alias("media_url"),
    ).where(F.col("part_id").isNotNull() & F.col("media_url").isNotNull())
    dense = F.row_number().over(Window.partitionBy(key).orderBy("source_position"))
    return usable.withColumn("position", dense)


def playlist_status(df: DataFrame, key: str, json_col: str) -> DataFrame:
    """One row per item: number of usable parts; none means preview only."""
    parts = explode_playlist(df, key, json_col).groupBy(key).agg(F.count("*").alias("parts"))
    return df.select(key).join(parts, key, "left").select(
        key, F.coalesce("parts", F.lit(0)).alias("parts"),
        F.col("parts").isNull().alias("preview_only"))


def extract_embedded_parts(pages: DataFrame, default_title: str = "Часть") -> DataFrame:
    """Part objects inside page scripts, one row per distinct address.

    Only pages without any usable object fall back to quoted media addresses;
    both branches come from one pass over the page text.
    """
    found = pages.select(
        "page_id", "url",
        F.regexp_extract_all("html", F.lit(PART_OBJECT), 1).alias("objects"),
        F.regexp_extract_all("html", F.lit(QUOTED_MEDIA), 1).alias("quoted"))
    objects = F.filter(
        F.transform("objects", lambda text, i: F.struct(
            (i + 1).cast("int").alias("ord"), F.from_json(text, PART_FIELDS).alias("o"))),
        lambda e: none_if_blank(e["o"]["src"]).isNotNull())
    from_objects = F.transform(objects, lambda e: F.struct(
        e["ord"].alias("ord"), e["o"]["fileId"].alias("part_id"), e["o"]["title"].alias("title"),
        e["o"]["src"].alias("src"),
        F.coalesce(e["o"]["duration"].try_cast("int"), F.lit(0)).alias("duration_seconds")))
    from_quotes = F.transform("quoted", lambda text, i: F.struct(
        (i + 1).cast("int").alias("ord"), F.lit(None).cast("string").alias("part_id"),
        F.lit(None).cast("string").alias("title"), text.alias("src"),
        F.lit(0).alias("duration_seconds")))
    rows = (found.withColumn("_objects", from_objects)
            .withColumn("parts", F.when(F.size("_objects") > 0, F.col("_objects")).otherwise(from_quotes))
            .select("page_id", "url", F.inline("parts")))
    located = rows.withColumn("media_url", absolute(F.col("url"), F.col("src"))).drop("src", "url")
    unique = first_by(located, ["page_id", "media_url"], [F.col("ord")])
    number = F.row_number().over(Window.partitionBy("page_id").orderBy("ord"))
    dense = unique.withColumn("_n", number)
    stated = none_if_blank(squeeze(unescape_entities(F.col("title"))))
    ordinal = F.when(F.col("part_id").isNull(), F.col("_n")).otherwise(F.col("ord"))
    return dense.select(
        "page_id", F.coalesce("part_id", F.col("_n").cast("string")).alias("part_id"),
        (F.col("_n") - 1).alias("position"),
        F.coalesce(stated, F.concat(F.lit(default_title + " "), ordinal.cast("string"))).alias("title"),
        "duration_seconds", "media_url")
