"""Items to catalog: merging (JN1, JN2), availability (FLT3), routing (FLT9), integrity (JN4),
enrichment (JN12), presence (REC2), records (REC1), nesting (AGG5), measures (AGG8), genres (CLN9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.scale import literal_table, running_totals
from ..functions.text import none_if_blank, squeeze
from ..functions.urls import host, path
from ..sources.files import part_url


# ---------------------------------------------------------------- joins

def merge_listing_into_detail(detail: DataFrame, listing: DataFrame, keys: Sequence[str],
                              fill: Sequence[str]) -> DataFrame:
    """JN1: the detail page wins; the listing only fills what is empty."""
    other = listing.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in fill])
    types = dict(detail.dtypes)

    def filled(c: str) -> Column:
        if types[c] == "string":
            return F.coalesce(none_if_blank(F.col(c)), F.col(f"_l_{c}"))
        if types[c].startswith("array"):
            return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.col(c)).otherwise(F.col(f"_l_{c}"))
        return F.coalesce(F.nullif(F.col(c), F.lit(0)), F.col(f"_l_{c}"))

    joined = detail.join(other, list(keys), "left")
    return joined.withColumns({c: filled(c) for c in fill}).select(*detail.columns)


def overlay_listing_counters(detail: DataFrame, listing: DataFrame, keys: Sequence[str], overwrite: Sequence[str],
                             when_unknown: Sequence[str]) -> DataFrame:
    """JN2: listing counters overwrite; sizes only where the detail has none."""
    cols = [*overwrite, *when_unknown]
    other = listing.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in cols])
    joined = detail.join(other, list(keys), "left")
    return joined.withColumns({
        **{c: F.coalesce(F.col(f"_l_{c}"), F.col(c)) for c in overwrite},
        **{c: F.coalesce(F.nullif(F.col(c), F.lit(0)), F.col(f"_l_{c}")) for c in when_unknown},
    }).select(*detail.columns)


def split_known_unknown(keys: DataFrame, state: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """JN3: rows whose key is already confirmed, and the others."""
    known = state.select(key)
    return keys.join(known, key, "left_semi"), keys.join(known, key, "left_anti")




def check_part_integrity(parts: DataFrame, files: DataFrame, items: DataFrame, key: str = "item") -> DataFrame:
    """JN4: typed violations of parts against the media files of their item.

    Part rows: the key must be an integer, hit a media file, and the address
    must be the one implied. Item rows: at least one media file and one part;
    these counts come from aggregates, so a hot item is never gathered.
    """
    media = files.where(F.col("media_type") == "audio")
    index = media.select(key, F.col("file_index").alias("_index")).distinct().withColumn("_hit", F.lit(True))
    number = F.col("part_id").try_cast("int")
    checked = (parts.withColumn("_index", number).join(index, [key, "_index"], "left")
               .join(items.select(key, "content_key"), key, "left"))
    problem = (F.when(F.col("_index").isNull(), "bad_key").when(F.col("_hit").isNull(), "missing_file")
               .when(~F.col("media_url").eqNullSafe(part_url(F.col("content_key"), F.col("_index"))), "url_mismatch"))
    rows = checked.select(key, "part_id", problem.alias("violation")).where(F.col("violation").isNotNull())
    counted = (items.select(key)
               .join(media.groupBy(key).agg(F.count("*").alias("_media")), key, "left")
               .join(parts.groupBy(key).agg(F.count("*").alias("_parts")), key, "left"))
    whole = counted.select(key, F.lit(None).cast("string").alias("part_id"),
                           F.when(F.col("_media").isNull(), "no_media").when(F.col("_parts").isNull(), "no_parts")
                           .alias("violation")).where(F.col("violation").isNotNull())
    return rows.unionByName(whole)


def enrich(items: DataFrame, manifests: DataFrame, mode: str, key: str = "content_key") -> DataFrame:
    """JN12: attach file manifests in one of three modes.

    ``none`` keeps items as they are; ``optional`` keeps an item without a
    usable manifest, with a fallback status and the error; ``required`` marks it
    for a blocking reject. ``manifests`` has (key, actual_key, media_files, ...).
    """
    if mode == "none":
        return items.withColumns({"metadata_status": F.lit("magnet"), "metadata_attempted": F.lit(False),
                                  "metadata_error": F.lit(None).cast("string"), "blocking": F.lit(False)})
    other = manifests.select(key, *[F.col(c).alias(f"_m_{c}") for c in manifests.columns if c != key])
    joined = items.join(other, key, "left")
    error = (F.when(none_if_blank(F.col(key)).isNull(), F.lit("no usable content key"))
             .when(F.col("_m_actual_key").isNull(), F.lit("manifest is missing"))
             .when(F.col("_m_actual_key") != F.col(key),
                   F.concat(F.lit("content key mismatch: "), F.col(key), F.lit(" != "), F.col("_m_actual_key")))
             .when(F.col("_m_media_files") == 0, F.lit("no supported media files")))
    short = F.substring(error, 1, fixed.MESSAGE_LIMIT)
    permanent = (F.col("_m_actual_key") == F.col(key)) & (F.col("_m_media_files") == 0)
    fallback = "magnet_fallback" if mode == "optional" else "rejected"
    marked = joined.withColumns({
        "metadata_error": short, "metadata_attempted": F.lit(True),
        "metadata_status": F.when(error.isNull(), "metadata_attached").otherwise(fallback),
        "blocking": F.lit(False) if mode == "optional" else F.coalesce(error.isNotNull() & ~F.coalesce(
            permanent, F.lit(False)), F.lit(False))})
    renamed = {f"_m_{c}": F.when(F.col("metadata_status") == "metadata_attached", F.col(f"_m_{c}"))
               for c in manifests.columns if c != key}
    return marked.withColumns(renamed).withColumnsRenamed(
        {f"_m_{c}": c for c in manifests.columns if c not in (key, "actual_key")}).drop("_m_actual_key")


# ---------------------------------------------------------------- FLT3, FLT9

def phrase_flags(text: Column) -> dict[str, Column]:
    """Removed, blocked and preview wording in a page's text."""
    folded = F.lower(F.coalesce(text, F.lit("")))
    any_of = lambda phrases: F.lit(False) if not phrases else folded.rlike(
        "|".join(p.replace("(", r"\(") for p in phrases))
    terms = F.lit(True)
    for words in fixed.REMOVED_TERMS:
        terms = terms & folded.rlike("|".join(words))
    return {"removed": any_of(fixed.REMOVED_PHRASES) | terms, "blocked": any_of(fixed.BLOCKED_PHRASES),
            "preview_text": any_of(fixed.PREVIEW_PHRASES), "purchase": any_of(fixed.PURCHASE_PHRASES)}


def classify_availability(items: DataFrame, parts: DataFrame, key: str, trial_hosts: Sequence[str],
                          text: str = "text") -> DataFrame:
    """FLT3: one availability condition per item.

    Removed wins over preview; preview only when all parts are trial addresses,
    or a purchase call stands beside a single teaser of zero length. Group
    facts are boolean and count aggregates over the part rows.
    """
    h = host(F.col("media_url"))
    trial_host = F.lit(False)
    for name in trial_hosts:
        trial_host = trial_host | (h == name) | h.endswith("." + name)
    trial = F.coalesce(trial_host & F.contains(path(F.lower("media_url")), F.lit(fixed.TRIAL_PATH)), F.lit(False))
    teaser = F.lower(squeeze("title")).isin(fixed.TEASER_TITLES) & (F.coalesce("duration_seconds", F.lit(0)) <= 0)
    facts = parts.groupBy(key).agg(F.count("*").alias("parts"), F.bool_and(trial).alias("_all_trial"),
                                   F.bool_or(teaser).alias("_teaser"))
    flags = phrase_flags(F.col(text))
    joined = items.join(facts, key, "left").withColumn("parts", F.coalesce("parts", F.lit(0)))
    one_teaser = flags["purchase"] & (F.col("parts") == 1) & F.coalesce("_teaser", F.lit(False))
    condition = (F.when(flags["removed"] | flags["blocked"], "removed")
                 .when(flags["preview_text"] | F.coalesce("_all_trial", F.lit(False)) | one_teaser, "preview_only")
                 .when(F.col("parts") == 0, "no_parts").otherwise("available"))
    return joined.withColumn("condition", condition).drop("_all_trial", "_teaser")


# Fixed values: (source, condition, outcome, reason, blocking). Sources are told
# apart by what they publish: cards, playlists or posts.
OUTCOME_POLICY = [
    ("cards", "removed", "tombstone", "rightsholder_removed", False),
    ("cards", "preview_only", "reject", "preview_only", False),
    ("cards", "no_parts", "reject", "missing_full_chapters", False),
    ("cards", "parse_error", "reject", "detail_fetch_or_parse_error", False),
    ("playlist", "removed", "tombstone", "rights_holder_blocked", False),
    ("playlist", "preview_only", "tombstone", "preview_only", False),
    ("playlist", "no_parts", "tombstone", "preview_only", False),
    ("playlist", "parse_error", "reject", "detail_fetch_or_parse_error", False),
    ("posts", "no_media", "reject", "unsupported_audio", False),
    ("posts", "no_parts", "reject", "topic_rejected", True),
    ("posts", "no_key", "reject", "topic_rejected", True),
    ("posts", "no_metadata", "reject", "topic_rejected", True),
    ("posts", "deferred", "reject", "topic_rejected", True),
    ("posts", "parse_error", "reject", "topic_rejected", False),
]


def route_outcomes(classified: DataFrame, policy: DataFrame | None = None, source: str = "source",
                   condition: str = "condition") -> DataFrame:
    """FLT9: every item gets exactly one outcome, reason and blocking flag.

    The policy is a rule table of checked size; a condition without a rule is a
    non-blocking reject, ``available`` is a record. Filter on ``outcome`` for
    the three tables.
    """
    rules = policy if policy is not None else literal_table(
        classified.sparkSession, OUTCOME_POLICY,
        "source string, condition string, outcome string, reason string, blocking boolean")
    renamed = rules.select(F.col("source").alias(source), F.col("condition").alias(condition), "outcome", "reason",
                           "blocking")
    joined = classified.drop("outcome", "reason", "blocking").join(renamed, [source, condition], "left")
    good = F.col(condition) == "available"
    return joined.withColumns({
        "outcome": F.when(good, "record").otherwise(F.coalesce("outcome", F.lit("reject"))),
        "reason": F.when(~good, F.coalesce("reason", F.lit("detail_fetch_or_parse_error"))),
        "blocking": F.when(good, F.lit(False)).otherwise(F.coalesce("blocking", F.lit(False)))})


def reject_rows(routed: DataFrame, message: str | None = None) -> DataFrame:
    text = F.col(message) if message else F.lit(None).cast("string")
    return routed.where(F.col("outcome") == "reject").select(
        "source", "external_id", "external_url", "reason", F.col("condition").alias("error_type"),
        F.substring(text, 1, fixed.MESSAGE_LIMIT).alias("message"), "blocking")


def tombstone_rows(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("outcome") == "tombstone").select("source", "external_id", "external_url", "reason")


# ---------------------------------------------------------------- REC1, REC2, AGG5, AGG8, CLN9

def presence_profile(items: DataFrame, fields: dict[str, Column], complete: Column) -> DataFrame:
    """REC2: sorted array of the fields an item's source supplied, and completeness."""
    present = F.array_compact(F.array(*[F.when(ok, F.lit(name)) for name, ok in sorted(fields.items())]))
    return items.withColumns({"fields_present": present, "complete": F.coalesce(complete, F.lit(False))})


def fill_rates(profiled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items and share of items per field and key."""
    totals = profiled.groupBy(*keys).agg(F.count("*").alias("items"))
    per_field = (profiled.select(*keys, F.explode("fields_present").alias("field"))
                 .groupBy(*keys, "field").agg(F.count("*").alias("filled")))
    return per_field.join(totals, list(keys))


def split_genres(c: Column) -> Column:
    """CLN9: array of genres without generic values and series hints."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"(?U)\s*[,;/]\s*"), squeeze)
    return F.filter(parts, lambda g: (g != "") & ~F.lower(g).isin(fixed.GENERIC_GENRES)
                    & ~g.rlike(r"(?iU)^серия\s*[:：]\s*.+$"))


def series_hint(c: Column) -> Column:
    """The first "series: X" value diverted from the genres."""
    parts = F.split(F.coalesce(c, F.lit("")), r"(?U)\s*[,;/]\s*")
    hints = F.filter(F.transform(parts, lambda g: F.regexp_extract(squeeze(g), r"(?iU)^серия\s*[:：]\s*(.+)$", 1)),
                     lambda g: g != "")
    return F.get(hints, F.lit(0))


def roll_up_measures(items: DataFrame, parts: DataFrame, key: str, stated: str = "duration_seconds",
                     part_measure: str = "duration_seconds") -> DataFrame:
    """AGG8: the stated measure, else the sum of positive part measures."""
    summed = parts.where(F.col(part_measure) > 0).groupBy(key).agg(F.sum(part_measure).alias("_sum"))
    return items.join(summed, key, "left").withColumn(
        stated, F.coalesce(F.nullif(F.col(stated), F.lit(0)), F.col("_sum"), F.lit(0))).drop("_sum")


def numbered_children(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk: Column,
                      payload: Sequence[str], rank: str = "ord") -> DataFrame:
    """AGG5, flat: one row per child with its position under its key, however many a key has."""
    return running_totals(rows, keys, order, {rank: F.lit(1)}, chunk=chunk).select(*keys, rank, *payload)


def assemble_nested(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk: Column | None,
                    payload: Sequence[str], out: str) -> DataFrame:
    """AGG5: one row per key with the ordered array of its children.

    Meant for the children of one source document (parts, files, entries),
    whose number that document bounds; a feed of keys without such a bound
    keeps :func:`numbered_children`. The array is one value anyway, so rows are
    shuffled once and sorted in it (ascending, ties by payload); ``chunk`` is
    only of use to numbered children.
    """
    places = [c.alias(f"_{i}") for i, c in enumerate(order)]
    nested = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*places, *payload))).alias("_rows"))
    return nested.select(*keys, F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in payload])).alias(out))


RECORD_DEFAULTS = {
    "title": "", "description": "", "cover_url": "", "rating": "",
}


def project_records(items: DataFrame, parts: DataFrame | None = None, manifests: DataFrame | None = None,
                    entries: DataFrame | None = None, keys: Sequence[str] = ("source", "external_id")) -> DataFrame:
    """REC1: items to nested feed records with the contract's defaults.

    One record per item row. Nested inputs come from :func:`assemble_nested`,
    with one row per item; an item without parts has an empty array. Entries
    that items share may stand in the items' own column ``entries``.
    """
    keys = list(keys)
    base = items
    if parts is not None:
        base = base.join(parts, keys, "left")
    if entries is not None:
        base = base.join(entries, keys, "left")
    if manifests is not None:
        cols = [c for c in manifests.columns if c not in keys]
        base = base.join(manifests.select(*keys, F.struct(*cols).alias("manifest")), keys, "left")
    have = set(base.columns)
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in have else F.lit("")
    array = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>")) if c in have else F.array().cast(
        "array<string>")
    named = none_if_blank(text("series_name")).isNotNull() | none_if_blank(text("series_id")).isNotNull()
    position = F.col("series_position") if "series_position" in have else F.lit(None).cast("int")
    series = F.struct(
        F.nullif(text("series_id"), F.lit("")).alias("external_id"), text("series_name").alias("name"),
        position.alias("position"), *([F.col("entries")] if "entries" in have else []))
    empty_series = F.filter(F.array(series), lambda s: F.lit(False))
    return base.select(
        *keys, text("external_url").alias("external_url"),
        *[text(c).alias(c) for c in RECORD_DEFAULTS],
        F.coalesce(F.col("duration_seconds").cast("long"), F.lit(0).cast("long")).alias("duration_seconds"),
        *[array(c).alias(c) for c in ("authors", "narrators", "genres")],
        F.sort_array(array("fields_present")).alias("fields_present"),
        (F.col("complete") if "complete" in have else F.lit(True)).alias("complete"),
        F.when(named, F.array(series)).otherwise(empty_series).alias("series"),
        *([F.coalesce("parts", F.array().cast(dict(base.dtypes)["parts"])).alias("parts")] if "parts" in have else []),
        *([F.col("manifest")] if manifests is not None else []))


def union_sources(*frames: DataFrame) -> DataFrame:
    """SET1: one record contract over all sources."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
