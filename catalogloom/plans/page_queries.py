"""Queries over page snapshots: the given ``pages`` and pages derived from ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.measures import size_bytes
from ..functions.text import squeeze
from ..functions.urls import absolute, first_web_url, host_allowed
from ..operators import fields, images, links, listing, nodes, series
from ..sources.pages import decode_pages, read_pages
from ..sources.parts import explode_playlist, extract_embedded_parts, playlist_status
from . import derived
from .registry import Tables, query

_UNESCAPE = ("regexp_replace(replace(replace(replace(replace(replace(replace({0},'&lt;','<'),'&gt;','>'),'&quot;','\"'),"
             "'&#39;',''''),'&copy;','©'),'&middot;','·'),'&amp;?','&','g')")
_CLEAN = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"


def _plain(sql: str) -> str:
    return _CLEAN.format(_UNESCAPE.format(sql))


_LINKS_SQL = r"""
with raw as (select page_id, url, regexp_extract(url, '^(https?://[^/?#]*)', 1) as origin,
    regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) as hrefs,
    regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) as texts from pages),
l as (select page_id, origin, unnest(range(1, len(hrefs) + 1)) as pos, unnest(hrefs) as href, unnest(texts) as text from raw)
"""


@query("src1_read_pages", "select count(*) as pages, count(distinct url) as urls, sum(length(html)) as characters from pages")
def src1(t: Tables):
    pages = read_pages(t.spark, t.path("pages"))
    return pages.agg(F.count("*").alias("pages"), F.countDistinct("url").alias("urls"),
                     F.sum(F.length("html")).alias("characters"))


_LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(chr(c) for c in range(0xA1, 0x100))
_CYRILLIC = "".join(chr(0x410 + i % 64) for i in range(len(_LATIN)))


@query("src2_decode_pages", f"""
select doc_id, case when doc_id % 4 < 2 then 'declared' else 'cp1251' end as decoded_as,
  md5(case when doc_id % 4 = 0 then text else translate(text, '{_LATIN}', '{_CYRILLIC}') end) as digest from documents""")
def src2(t: Tables):
    kind = F.col("doc_id") % 4
    letters = "".join(dict.fromkeys(_CYRILLIC))
    codes = F.translate(F.translate("text", _LATIN, _CYRILLIC), letters, letters.encode("cp1251").decode("latin-1"))
    raw = t.documents.select("doc_id", F.when(kind == 0, F.col("text").cast("binary")).otherwise(
        F.encode(codes, "ISO-8859-1")).alias("content"),
        F.when(kind == 0, "UTF-8").when(kind == 1, "windows-1251").when(kind == 2, "no-such-charset").alias("charset"))
    return decode_pages(raw, "content", "charset").select(
        "doc_id", "decoded_as", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("src3_explode_playlist", """
with n as (select p_partkey as item, p_size, unnest(range(0, p_size % 6)) as i from part),
good as (select * from n where (i + p_size) % 5 > 2)
select item, (i + 1)::int as source_position, (item * 10 + i)::varchar as part_id,
  row_number() over (partition by item order by i) as position,
  case when i % 2 = 0 then 'Track ' || (i + 1) else 'Глава ' || (i + 1) end as title,
  'https://m.example.net/' || item || '/' || i || '.mp3' as media_url from good""")
def src3(t: Tables):
    return explode_playlist(derived.playlists(t.part), "item", "playlist")


@query("src3_playlist_status", """
select p_partkey as item, len(list_filter(range(0, p_size % 6), lambda i: (i + p_size) % 5 > 2)) as parts,
  len(list_filter(range(0, p_size % 6), lambda i: (i + p_size) % 5 > 2)) = 0 as preview_only from part""")
def src3_status(t: Tables):
    return playlist_status(derived.playlists(t.part), "item", "playlist")


_PARTS_SQL = """
with obj as (select p_partkey, p_size, unnest(range(0, 1 + p_size % 4)) as i from part where p_size % 11 <> 0 and p_partkey % 4 <> 0),
parts as (select p_partkey as page_id, (p_partkey * 10 + i)::varchar as part_id, i as position, 'Part & ' || (i + 1) as title,
  (i * 60)::int as duration_seconds, 'https://' || case when p_size % 5 = 0 then 'trial.example.net/audiotrial' else 'media.example.net/a' end
  || '/' || p_partkey || '-' || i || '.mp3' as media_url from obj
  union all select p_partkey, '1', 0, 'Часть 1', 0, 'https://media.example.net/q/' || p_partkey || '.mp3' from part
  where p_size % 11 <> 0 and p_partkey % 4 = 0)
"""


@query("src4_embedded_parts", _PARTS_SQL + "select * from parts")
def src4(t: Tables):
    return extract_embedded_parts(derived.detail_pages(t.part))


@query("ext1_nodes_per_tag", """
with tags as (select unnest(['html','head','meta','title','style','script','body','nav','ul','li','a','div','article','h1','p','b','br','footer']) as tag)
select tag, sum(len(regexp_extract_all(html, '<' || tag || '[ >]')))::bigint as nodes from pages cross join tags group by tag""")
def ext1(t: Tables):
    tags = nodes.page_nodes(t.pages).where(~F.col("tag").startswith("#"))
    return tags.groupBy("tag").agg(F.count("*").alias("nodes"))


@query("ext1_interval_violations", "select count(*) as pages, 0 as violations from pages")
def ext1_intervals(t: Tables):
    tree = nodes.page_nodes(t.pages)
    parents = tree.select("page_id", F.col("seq").alias("parent_seq"), F.col("end_seq").alias("_pend"), F.col("depth").alias("_pdepth"))
    joined = tree.join(parents, ["page_id", "parent_seq"], "left")
    wrong = ((F.col("end_seq") < F.col("seq"))
             | ((F.col("parent_seq") > 0) & (F.col("_pend").isNull() | (F.col("end_seq") > F.col("_pend"))
                                             | (F.col("depth") != F.col("_pdepth") + 1)))
             | ((F.col("parent_seq") == 0) & (F.col("depth") != 0)))
    per_page = joined.groupBy("page_id").agg(F.count_if(wrong).alias("_bad"))
    return per_page.agg(F.count("*").alias("pages"), F.sum("_bad").cast("int").alias("violations"))


@query("ext2_links_from_text", _LINKS_SQL + "select page_id, pos, href, " + _CLEAN.format("text") + " as text, origin || href as url from l")
def ext2_text(t: Tables):
    return nodes.extract_links_from_text(t.pages)


@query("ext2_links_from_nodes", _LINKS_SQL + "select page_id, pos, " + _UNESCAPE.format("href") + " as href, " + _plain("text")
       + " as text, origin || " + _UNESCAPE.format("href") + " as url from l")
def ext2_nodes(t: Tables):
    found = nodes.extract_links(nodes.page_nodes(t.pages), t.pages)
    pos = F.row_number().over(Window.partitionBy("page_id").orderBy("seq"))
    return found.select("page_id", pos.alias("pos"), "href", "text", "url")


@query("ext3_page_keys", r"""
with p as (select page_id, url, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) as path from pages)
select page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) as host,
  coalesce(nullif(regexp_extract(path, '/(\d+)/?$', 1), ''), nullif(trim(path, '/'), ''), url) as external_id,
  nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') as listing_id from p""")
def ext3(t: Tables):
    keyed = links.derive_keys(t.pages, "url", listing_parameter="page")
    return keyed.select("page_id", "host", "external_id", "listing_id")


_KIND_RULES = (("author", "/t", 5), ("narrator", "/a", 8), ("series", "/e", 1))


@query("ext4_link_kinds", _LINKS_SQL + r"""
, rules(kind, pattern, keep) as (values ('author', '/t', 5), ('narrator', '/a', 8), ('series', '/e', 1)),
c as (select page_id, kind, keep, """ + _CLEAN.format("text") + r""" as label, min(pos) as pos from l join rules on contains(href, pattern)
  where trim(text) <> '' and not regexp_full_match(trim(text), '\d+') group by all),
r as (select *, row_number() over (partition by page_id, kind order by pos) as rank from c)
select page_id, kind, rank, label from r where rank <= keep""")
def ext4(t: Tables):
    return links.classify_links(nodes.extract_links_from_text(t.pages), _KIND_RULES, order="pos")


@query("agg2_first_distinct_labels", _LINKS_SQL + r"""
, c as (select page_id, lower(""" + _CLEAN.format("text") + r""") as folded, min(pos) as pos, arg_min(""" + _CLEAN.format("text")
       + r""", pos) as label from l group by all)
select page_id, pos, label from (select *, row_number() over (partition by page_id order by pos) as rn from c) where rn <= 3""")
def agg2(t: Tables):
    found = nodes.extract_links_from_text(t.pages)
    return links.distinct_list(found.select("page_id", "pos", F.col("text").alias("label")), ["page_id"], "label", "pos", 3, fold=True)


@query("agg4_last_page_per_host", r"""
select regexp_extract(url, '^https?://([^/?#:]+)', 1) as host,
  greatest(max(coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') as int), 1)), 1) as last_page
from pages group by 1""")
def agg4(t: Tables):
    keyed = links.derive_keys(t.pages).withColumn("text", F.lit(""))
    return links.last_page_per_listing(keyed, ["host"], href="url")


@query("agg4_last_page_of_listings", """
select p_partkey % 23 as listing_id, greatest(max(p_size) + 1, 1) as last_page from part group by 1
union all select 23, 77""")
def agg4_state(t: Tables):
    pages = derived.table_pages(t.part)
    found = nodes.extract_links(nodes.page_nodes(pages)).join(
        pages.select("page_id", F.col("url").alias("page_url")), "page_id")
    pager = found.withColumn("listing_id", F.regexp_extract("page_url", r"f=(\d+)", 1).cast("bigint")).where(
        F.contains("href", F.lit("start=")))
    quiet = t.spark.range(23, 24).select(F.col("id").alias("listing_id"), F.lit("/x").alias("href"), F.lit("1").alias("text"))
    seen = pager.select("listing_id", "href", "text").unionByName(quiet)
    before = t.spark.range(0, 24).select(F.col("id").alias("listing_id"), F.lit(77).alias("last_page"))
    return links.last_page_per_listing(seen, ["listing_id"], previous=before)


_CARDS_SQL = """
with c as (select *, unnest(range(0, 1 + p_size % 4)) as i from part),
cards as (select p_partkey as page_id, (p_partkey * 10 + i)::varchar as external_id, p_name || ' ' || i as title,
  case when i = 1 then 0 else 60 + (p_partkey + i) % 30000 end::int as duration_seconds, p_size::varchar as series_id,
  'Series ' || p_size as series_name, p_brand, p_partkey % 7 as reader, lower(p_type) as genre from c where i <> 2)
"""


@query("ext5_listing_cards", _CARDS_SQL + "select page_id, external_id, title, duration_seconds, series_id, series_name from cards")
def ext5(t: Tables):
    pages = derived.card_pages(t.part)
    tree = nodes.page_nodes(pages, scopes=[listing.LINK], attrs=["href"])
    segments = listing.listing_segments(tree, pages, ["example.org"])
    return listing.listing_cards(segments).select("page_id", "external_id", "title", "duration_seconds", "series_id", "series_name")


@query("ext5_listing_labels", _CARDS_SQL + """
select page_id, external_id, 'author' as kind, 1 as rank, p_brand as label from cards
union all select page_id, external_id, 'narrator', 1, 'Reader ' || reader from cards
union all select page_id, external_id, 'genre', 1, genre from cards
union all select page_id, external_id, 'series', 1, series_name from cards""")
def ext5_labels(t: Tables):
    pages = derived.card_pages(t.part)
    cards, labels = listing.segment_listing(nodes.page_nodes(pages, scopes=[listing.LINK], attrs=["href"]), pages, ["example.org"])
    return cards.select("page_id", "card", "external_id").join(labels, ["page_id", "card"]).select(
        "page_id", "external_id", "kind", "rank", "label")


@query("ext6_table_rows", """
with r as (select *, unnest(range(0, least(1 + p_size % 5, 4))) as i from part)
select p_partkey as page_id, (p_partkey * 10 + i)::varchar as external_id, p_name || ' ' || i as title,
  floor((p_size + i + 0.5) * power(1024, i % 3 + 1))::bigint as size_bytes, (p_size * 10 + i)::bigint as seeders,
  i::bigint as leechers from r""")
def ext6(t: Tables):
    row = nodes.Scope("row", ("tr",), attr="id", prefix="tr-")
    cells = {"title": nodes.Scope("title", ("a",), attr="href", value="viewtopic.php?t="),
             "size": nodes.Scope("size", ("a",), attr="href", value="dl.php?t="),
             "seeds": nodes.Scope("seeds", cls="seedmed"), "leeches": nodes.Scope("leeches", cls="leechmed")}
    tree = nodes.page_nodes(derived.table_pages(t.part), scopes=listing.row_scopes(row, cells), within="_cell", attrs=["class", "href"])
    rows = listing.extract_table_rows(tree, row, cells, {"href": ("title", "href")}, required=["title", "size"])
    keyed = listing.unique_rows(links.derive_keys(rows, "href"), ["page_id", "external_id"])
    return keyed.select("page_id", "external_id", "title", size_bytes(F.col("size")).alias("size_bytes"),
                        listing.counter(F.col("seeds")).alias("seeders"), listing.counter(F.col("leeches")).alias("leechers"))


@query("ext6_search_rows", """
with r as (select *, unnest(range(0, 1 + p_size % 4)) as i from part)
select p_partkey as page_id, (p_partkey * 10 + i)::varchar as external_id, p_name || ' ' || i as title,
  case when i % 2 = 0 then p_partkey * 1000 + i else (p_size + i) * 1024 end::bigint as size_bytes,
  case when i % 3 = 1 then 0 else p_size + i end::bigint as seeders, i::bigint as leechers from r""")
def ext6_search(t: Tables):
    rows = listing.search_rows(listing.search_nodes(derived.search_pages(t.part)))
    return links.derive_keys(rows, "href").select(
        "page_id", "external_id", "title", size_bytes(F.col("size")).alias("size_bytes"),
        listing.counter(F.col("seeds"), "дн").alias("seeders"), listing.counter(F.col("leeches")).alias("leechers"))


@query("flt2_scope_to_article", r"""
select page_id, len(regexp_extract_all(regexp_extract(html, '<article>.*</article>', 0, 's'), '<p[ >]')) as inside,
  len(regexp_extract_all(regexp_replace(html, '<article>.*</article>', '', 's'), '<(li|a|footer|nav|ul)[ >]')) as outside from pages""")
def flt2(t: Tables):
    tree = nodes.page_nodes(t.pages)
    owned = nodes.mark_owner(tree, F.col("tag") == "article", "_article")
    return owned.groupBy("page_id").agg(
        F.count_if(F.col("_article").isNotNull() & (F.col("tag") == "p")).alias("inside"),
        F.count_if(F.col("_article").isNull() & F.col("tag").isin("li", "a", "footer", "nav", "ul")).alias("outside"))


@query("flt2_title_anchors", """
with c as (select *, unnest(range(0, 1 + p_size % 4)) as i from part)
select p_partkey as page_id, '/' || (p_partkey * 10 + i) || '/' as href, p_name || ' ' || i as text from c""")
def flt2_anchors(t: Tables):
    pages = derived.card_pages(t.part)
    found = nodes.extract_links(nodes.page_nodes(pages, scopes=[nodes.LINK], within="_link", attrs=["href"]), pages)
    return links.title_anchor_filter(found, ["cards.example.org"]).select("page_id", "href", "text")


_FIELDS = {"author": ["Автор"], "narrator": ["Исполнитель"], "series": ["Цикл/серия"], "position": ["Номер книги"],
           "duration": ["Время звучания"], "description": ["Описание"]}
_POST_SQL = """
with f as (select p_partkey as page_id, p_size, p_name, p_type, unnest(['author','narrator','series','position','duration','description']) as field,
  unnest(['Brand ' || p_partkey % 5, case when p_partkey % 5 = 0 then '' else 'Reader ' || p_partkey % 7 end, 'Saga ' || p_type,
   (p_size % 3 + 1)::varchar, (p_partkey % 30000 // 3600) || ':' || lpad((p_partkey % 30000 // 60 % 60)::varchar, 2, '0') || ':' || lpad((p_partkey % 60)::varchar, 2, '0'),
   'All about ' || p_name]) as value from part)
"""


@query("ext7_labelled_fields", _POST_SQL + "select page_id, field, value, true as present from f")
def ext7(t: Tables):
    post = nodes.page_nodes(derived.post_pages(t.part), scopes=fields.POST_SCOPES, within="_post", attrs=["class"])
    found = fields.extract_fields(fields.labelled_segments(post), labels=_FIELDS)
    return found.select("page_id", "field", F.coalesce("value", F.lit("")).alias("value"), "present")


@query("ext7_labelled_lines", r"""
with n as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) as no, unnest(string_split(text, chr(10))) as raw from documents),
l as (select doc_id, no, """ + _CLEAN.format("raw") + r""" as line from n)
select doc_id, no as label_seq, case no % 3 when 0 then 'автор' when 1 then 'жанр' else 'описание' end as label, line as value
from l where line <> ''""")
def ext7_lines(t: Tables):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "raw"))
    label = F.element_at(F.array(*map(F.lit, ["Автор", "Жанр", "Описание"])), ((F.col("no") + 1) % 3 + 1).cast("int"))
    spread = lines.where(squeeze("raw") != "").select("doc_id", (F.col("no") + 1).alias("no"), F.explode(F.array(
        F.struct(F.lit(0).alias("k"), label.alias("text")), F.struct(F.lit(1).alias("k"), F.concat(F.lit(": "), "raw").alias("text")))).alias("l"))
    found = fields.labelled_lines(spread.select("doc_id", F.struct("no", "l.k").alias("at"), F.col("l.text").alias("text")), "doc_id", "at")
    return found.select("doc_id", F.col("label_seq.no").alias("label_seq"), "label", "value")


@query("ext8_article_text", "select page_id, md5(" + _plain(r"regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<[^>]+>', ' ', 'g')")
       + ") as digest from pages")
def ext8(t: Tables):
    tree = nodes.page_nodes(t.pages)
    texts = nodes.element_texts(tree, F.col("tag") == "article")
    return texts.select("page_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("ext8_marked_section", r"""
with n as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) as no, unnest(string_split(text, chr(10))) as raw from documents),
l as (select doc_id, no, """ + _CLEAN.format("raw") + r""" as line from n)
select doc_id, coalesce(substr(string_agg(line, ' ' order by no) filter (line <> ''), 1, 10000), '') as section from l group by doc_id""")
def ext8_section(t: Tables):
    """Whole texts behind a start marker; every second one has an end marker and a note after it, the others end with the page."""
    end = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("подробная информация"), F.lit("примечание"))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(F.array(F.lit("вступление"), F.lit("Описание  книги")), F.split("text", "\n"), end)
    marked = t.documents.where(F.col("text").isNotNull()).select("doc_id", F.posexplode(lines).alias("no", "text"))
    return fields.extract_sections(marked, key="doc_id", order="no")


@query("ext9_cover_per_page", """
with c as (select p_partkey as page_id, p_size * 20 as w, p_size, unnest([1, 2, 3]) as k from part),
s as (select page_id, k, case k
   when 1 then case when w < 80 or w / 600.0 >= 1.35 or w / 600.0 < 0.28 then null
     else (case when w / 600.0 between 0.45 and 0.82 then 60 when w / 600.0 < 0.45 then 35 when w / 600.0 <= 1.05 then 25 else 8 end)
       + least(15, w * 600 // 100000) end
   when 2 then 1 else case when p_size % 4 = 0 then 40 end end as score from c)
select page_id, case k when 1 then 'https://posts.example.org/i/' || page_id || '.jpg' when 2 then 'https://posts.example.org/plain/' || page_id || '.png'
  else 'https://posts.example.org/v/' || page_id || '.jpg' end as cover_url, score::int as score
from s where score is not null qualify row_number() over (partition by page_id order by score desc, case k when 3 then 0 else k end) = 1""")
def ext9(t: Tables):
    pages = derived.post_pages(t.part)
    return images.rank_images(images.image_candidates(nodes.page_nodes(pages), pages))


_LIST_SQL = """
with e as (select p_partkey as page_id, p_size, p_name, unnest(range(0, 3 + p_size % 4)) as i from part)
"""


@query("ext10_series_lists", _LIST_SQL + """
select page_id, (i + 1)::int as position, 'Tome of ' || p_name || ' ' || (i + 1) as raw_title,
  case when i = 1 and p_size % 2 = 0 then 'viewtopic.php?t=' || (page_id * 100 + i) end as href, p_size % 3 = 0 as spoiler from e""")
def ext10(t: Tables):
    pages = derived.post_pages(t.part)
    items = t.part.select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("Saga "), "p_type").alias("series_name"))
    found = series.extract_series_list(series.series_nodes(pages), items)
    return found.select("page_id", F.col("position").cast("int").alias("position"), "raw_title", "href", (F.col("ord.src") == 1).alias("spoiler"))


@query("jn8_linked_entries", _LIST_SQL + """
, k as (select *, i = 1 and p_size % 2 = 0 as linked, i + 1 = p_size % 3 + 1 as own from e)
select page_id, (i + 1)::int as position, 'Tome of ' || p_name || ' ' || (i + 1) as title,
  case when linked then (page_id * 100 + i)::varchar when own then page_id::varchar else
   'series-hint:' || substr(sha1('saga' || lower(p_type) || '|' || (i + 1) || '|' || 'tomeof' || replace(p_name, ' ', '') || (i + 1)), 1, 24) end as entry_id,
  case when linked then 'link' when own then 'self' else 'hint' end as matched_by
from k join part on p_partkey = page_id""".replace("select *, i = 1", "select e.*, i = 1").replace("k join part on p_partkey = page_id", "k join (select p_partkey, p_type from part) q on q.p_partkey = page_id"))
def jn8(t: Tables):
    pages = derived.post_pages(t.part)
    return series.series_entries(series.series_nodes(pages), _post_items(t)).select(
        "page_id", F.col("position").cast("int").alias("position"), "title", "entry_id", "matched_by")


def _post_items(t: Tables):
    key = F.col("p_partkey")
    return t.part.select(
        key.alias("page_id"), key.cast("string").alias("external_id"),
        F.concat(F.lit(derived.POST_HOST + "/forum/viewtopic.php?t="), key.cast("string")).alias("external_url"),
        F.concat(F.lit("Saga "), "p_type").alias("series_name"), (F.col("p_size") % 3 + 1).alias("series_position"),
        F.col("p_name").alias("title"))


@query("jn8_backfilled_positions", "select p_partkey as page_id, case when p_size % 2 = 0 and p_size % 3 = 1 then null else (p_size % 3 + 1)::int end as series_position from part")
def jn8_backfill(t: Tables):
    pages = derived.post_pages(t.part)
    items = _post_items(t)
    entries = series.series_entries(series.series_nodes(pages), items)
    blank = items.withColumn("series_position", F.lit(None).cast("int"))
    return series.backfill_positions(blank, entries).select("page_id", F.col("series_position").cast("int").alias("series_position"))


@query("ext11_page_titles", "select page_id, coalesce(nullif(" + _plain("regexp_extract(html, '<h1>([^<]*)</h1>', 1)") + ", ''), nullif("
       + _plain("regexp_extract(html, '<title>([^<]*)</title>', 1)") + ", '')) as value from pages")
def ext11(t: Tables):
    tree = nodes.page_nodes(t.pages)
    texts = nodes.element_texts(tree, F.col("tag").isin("h1", "title"))
    ranked = texts.select("page_id", F.lit("title").alias("field"), F.col("text").alias("value"),
                          F.when(F.col("tag") == "h1", 0).otherwise(1).alias("priority"))
    return fields.choose_value(ranked).select("page_id", "value")


@query("ext11_longest_block", "with c as (select page_id, " + _plain("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)") + " as a, "
       + _plain("regexp_extract(html, '<footer>([^<]*)</footer>', 1)") + """ as b from pages)
select page_id, substr(case when length(a) >= length(b) then a else b end, 1, 5000) as text from c""")
def ext11_longest(t: Tables):
    tree = nodes.page_nodes(t.pages)
    texts = nodes.element_texts(tree, (F.col("tag") == "footer") | ((F.col("tag") == "div") & nodes.has_class("ad")))
    return fields.choose_longest(texts, ["page_id"], "text", "element")


@query("flt8_url_policy", r"""
with u as (select page_id, url, regexp_extract(url, '^https?://([^/?#:]+)', 1) as host from pages)
select page_id, host like '%.example.com' or host = 'example.com' as allowed, url as first_url,
 regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/x' as resolved from u""")
def flt8(t: Tables):
    composite = F.concat(F.lit("see "), "url", F.lit(", or ftp://x/ y"))
    return t.pages.select("page_id", host_allowed(F.col("url"), ["example.com"]).alias("allowed"),
                          first_web_url(composite).alias("first_url"), absolute(F.col("url"), F.lit("/x")).alias("resolved"))


@query("catalog_links_per_host", _LINKS_SQL + r"""
, k as (select regexp_extract(origin, '^https?://(.*)$', 1) as host, href, case when contains(href, '/t') then 'author' when contains(href, '/a') then 'narrator'
  when contains(href, '/e') then 'series' else 'other' end as kind from l)
select host, kind, count(*) as links, count(distinct href) as targets from k group by all""")
def links_per_host(t: Tables):
    keyed = links.derive_keys(nodes.extract_links_from_text(t.pages))
    kind = F.lit("other")
    for name, fragment, _ in reversed(_KIND_RULES):
        kind = F.when(F.contains("href", F.lit(fragment)), name).otherwise(kind)
    return keyed.withColumn("kind", kind).groupBy("host", "kind").agg(
        F.count("*").alias("links"), F.countDistinct("href").alias("targets"))
