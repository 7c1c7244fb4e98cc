"""Queries that clean, split and match text: ``documents``, ``benchmark`` and strings derived from tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import fixed, measures
from ..functions.scale import running_totals
from ..functions.text import clean_unicode, natural_key, squeeze, title_key
from ..operators import catalog, links, people, series, titles
from .derived import clock, spread
from .registry import Tables, query


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _pick(number: Column, values: list) -> Column:
    return F.element_at(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


@query("cln1_clean_documents", r"select doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) as digest, length(trim(regexp_replace(text, '\s+', ' ', 'g'))) as characters from documents")
def cln1(t: Tables):
    noisy = F.concat(F.lit("﻿ "), F.replace("text", F.lit(" "), F.lit(" ​ ")))
    clean = clean_unicode(noisy)
    return t.documents.select("doc_id", clean.alias("text")).select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.length("text").alias("characters"))


@query("cln2_durations", """
with o as (select o_orderkey, o_orderkey % 90000 as s, (o_orderkey // 7) % 6 as f from orders)
select o_orderkey, case f when 0 then s when 1 then s + 61 when 2 then s % 3600 when 3 then (s // 3600) * 3600 + (s // 60 % 60) * 60
  when 4 then 0 else s end::int as seconds from o""")
def cln2_durations(t: Tables):
    s = F.col("s")
    o = t.orders.select("o_orderkey", (F.col("o_orderkey") % 90000).cast("int").alias("s"),
                        (F.floor(F.col("o_orderkey") / 7) % 6).alias("f"))
    minutes = _cat(_s(F.floor(s % 3600 / 60)), ":", F.lpad(_s(s % 60), 2, "0"))
    words = _cat(_s(F.floor(s / 3600)), " ч. ", _s(F.floor(s / 60) % 60), " мин.")
    text = _pick(F.col("f"), [clock(s), _cat(clock(s), " + 0:01:01"), minutes, words, _cat(_s(s), " страниц"),
                              _cat("около ", clock(s), " (два диска)")])
    return o.select("o_orderkey", measures.field_duration(text).alias("seconds"))


@query("cln2_labelled_durations", """
select o_orderkey, case when o_orderkey % 2 = 0 then o_orderkey % 36000 else 0 end::int as labelled,
  greatest(60, (o_orderkey % 20) * 3600 + (o_orderkey % 60) * 60)::int as longest,
  ((o_orderkey % 20) * 3600 + (o_orderkey % 60) * 60 + 5)::int as worded from orders""")
def cln2_labelled(t: Tables):
    key = F.col("o_orderkey")
    text = _cat(F.when(key % 2 == 0, "Диск. Общее время звучания: ").otherwise("Длина: "), clock((key % 36000).cast("int")))
    worded = _cat(_s(key % 20), " часов ", _s(key % 60), " минут")
    texts = F.array(F.lit("1 минута"), worded, F.lit("99 страниц"))
    full = _cat(worded, " 5 секунд")
    return t.orders.select("o_orderkey", measures.labelled_duration(text).alias("labelled"),
                           measures.longest_duration(texts).alias("longest"), measures.worded_duration(full).alias("worded"))


@query("cln2_sizes_and_ratings", """
select p_partkey, floor((p_size + 0.25) * power(1024, p_partkey % 5))::bigint as bytes, (p_size * 1000 + p_partkey % 1000)::bigint as number,
  case when p_partkey % 3 = 0 then null else (p_size % 10) || '.' || (p_partkey % 10) end as rating,
  p_retailprice_cents as plain from (select *, cast(round(p_retailprice * 100) as bigint) as p_retailprice_cents from part)""")
def cln2_sizes(t: Tables):
    key, size = F.col("p_partkey"), F.col("p_size")
    text = _cat(_s(size), ",25 ", _pick(key, ["байт", "КБ", "MiB", "GB", "ТБ"]))
    number = _cat("№ ", _s(size), " ", F.lpad(_s(key % 1000), 3, "0"), " раз 7")
    rating = _cat(_s(size % 10), F.when(key % 2 == 0, ",").otherwise("."), _s(key % 10), F.when(key % 3 == 0, "!").otherwise(""))
    return t.part.select("p_partkey", measures.size_bytes(text).alias("bytes"), measures.first_int(number).alias("number"),
                         measures.rating_text(rating).alias("rating"),
                         measures.size_bytes(_s(F.round(F.col("p_retailprice") * 100).cast("long"))).alias("plain"))


_CAP = "upper(substr({0}, 1, 1)) || substr({0}, 2)"
_NAME_SQL = ("with n as (select *, " + _CAP.format("split_part(p_name, ' ', 1)") + " as a, " + _CAP.format("split_part(p_name, ' ', 2)")
             + " as b from part)\n")


def _names(t: Tables):
    return spread(t.part, "p_partkey").select("*", F.initcap(F.split("p_name", " ")[0]).alias("a"), F.initcap(F.split("p_name", " ")[1]).alias("b"))


def _credits(t: Tables):
    """One author and one narrator credit per part, in six shapes each."""
    a, b, key = F.col("a"), F.col("b"), F.col("p_partkey")
    full = _cat(a, " ", b)
    author = _pick(key, [
        _cat(full, " (Ivan, alias), Anna ", b), _cat(full, " и Anna ", b, " и др."), _cat(full, " - идея; Anna ", b, " - стихи"),
        _cat("профессор ", full, "/ Anna ", b, "."), _cat(full, "], Anna ", b, ", архимандрит"), _cat("до XIX века, ", full)])
    narrator = _pick(key, [
        _cat("Лектор: ", full, ", подробности далее"), _cat("King Lear - ", full, ", Jester - Anna ", b),
        _cat("читает ", full, " (ЛИ)"), F.lit("Разные исполнители"), F.lit("автор"), _cat("Режиссёр: Max Stone, ", full, ", перевод Olga Fox")])
    base = _names(t)
    return base.select(key.alias("item"), F.explode(F.array(
        F.struct(F.lit("author").alias("role"), author.alias("credit")),
        F.struct(F.lit("narrator").alias("role"), narrator.alias("credit")))).alias("c")).select("item", "c.*")


_AUTHORS_SQL = """
authors as (select p_partkey as item, unnest(case p_partkey % 6 when 0 then [a || ' ' || b || ' (Ivan, alias)', 'Anna ' || b]
  when 5 then [a || ' ' || b] else [a || ' ' || b, 'Anna ' || b] end) as person,
  unnest(case p_partkey % 6 when 5 then [0] else [0, 1] end) as ord from n)"""
_NARRATORS_SQL = """
narrators as (select p_partkey as item, unnest(case p_partkey % 6 when 1 then [a || ' ' || b, 'Anna ' || b]
  when 3 then ['Разные исполнители'] when 4 then ['автор'] else [a || ' ' || b] end) as person,
  unnest(case p_partkey % 6 when 1 then [0, 1] else [0] end) as ord from n)"""


@query("cln3_people_table", _NAME_SQL.rstrip() + "," + _AUTHORS_SQL + "," + _NARRATORS_SQL + """
select item, 'author' as role, ord, person from authors union all select item, 'narrator', ord, person from narrators""")
def cln3(t: Tables):
    return people.people_table(_credits(t), ["item"], "role", "credit")


@query("jn10_author_alias", _NAME_SQL.rstrip() + "," + _AUTHORS_SQL + "," + _NARRATORS_SQL + """
select item, 'author' as role, ord, person from authors
union all select item, 'narrator', ord, person from narrators where item % 6 <> 4
union all select item, 'narrator', ord, person from authors where item % 6 = 4""")
def jn10(t: Tables):
    credits = _credits(t)
    table = people.people_table(credits, ["item"], "role", "credit")
    return people.resolve_aliases(credits, table, ["item"], "role", "credit")


@query("cln4_recovered_credits", _NAME_SQL + """
select p_partkey as item, case p_partkey % 6 when 0 then a || ' ' || b when 1 then b || ' ' || a || '|Fox Anna' when 2 then b || ' Ann|' || b || ' Max'
  when 3 then b when 4 then a || ' ' || b else 'Joan ' || b end as names,
  case p_partkey % 6 when 4 then 2 when 5 then 3 else 1 end as tier from n""")
def cln4(t: Tables):
    a, b, key = F.col("a"), F.col("b"), F.col("p_partkey")
    blank = F.lit("")
    base = _names(t).select(
        key.alias("item"), _pick(key, [a, _cat(a, ", Anna"), b, b, blank, blank]).alias("surname"),
        _pick(key, [b, _cat(b, ", Fox"), F.lit("Ann, Max"), F.lit("перевод Max Stone"), blank, blank]).alias("given"),
        _pick(key, [blank, blank, blank, _cat("Авторы сценария: ", b, " Wrong"), _cat("Авторы сценария: ", a, " ", b, ".\nдалее"),
                    _cat("Автор и исполнитель:\nчитает Joan ", b, "\nжанр: проза")]).alias("text"))
    tiers = people.pair_names(base, "surname", "given").select(
        "item", F.explode(F.array(
            F.struct(F.lit(1).alias("tier"), "names"),
            F.struct(F.lit(2).alias("tier"), people.screenplay_names(F.col("text")).alias("names")),
            F.struct(F.lit(3).alias("tier"), people.joint_names(F.col("text")).alias("names")),
            F.struct(F.lit(4).alias("tier"), people.text_credit_name(F.col("text")).alias("names")))).alias("x")).select("item", "x.*")
    kept = people.recover_credits(tiers, ["item"])
    return kept.select("item", F.array_join("names", "|").alias("names"), "tier")


@query("cln4_cast_lists", _NAME_SQL + """
select p_partkey as item, unnest([a || ' ' || b, 'Anna ' || b]) as person from n""")
def cln4_cast(t: Tables):
    a, b, key = F.col("a"), F.col("b"), F.col("p_partkey")
    lines = F.array(F.lit("Пролог"), _pick(key, ["Исполнители:", "В ролях:"]), _cat("Король - ", a, " ", b),
                    F.lit("В эпизодах: многие"), _cat("Шут - нар. артист Anna ", b), F.lit("Режиссёр Max Stone"), _cat("Слуга - Olga ", b))
    rows = _names(t).select(key.alias("item"), F.posexplode(lines).alias("no", "text"))
    return people.cast_list(rows, "item", "no").select("item", "person")


@query("cln5_inferred_authors", _NAME_SQL + """
select p_partkey as item, case p_partkey % 5 when 4 then '' when 2 then a || ' ' || b || '|Anna ' || b else a || ' ' || b end as author,
  case p_partkey % 5 when 0 then 'Max Stone|Olga Fox' when 3 then 'Max Stone' else '' end as narrators from n""")
def cln5(t: Tables):
    a, b, key = F.col("a"), F.col("b"), F.col("p_partkey")
    full, title = _cat(a, " ", b), _cat("тайна дома ", _s("p_size"))
    subject = _pick(key, [
        _cat(full, " - ", title, " [Max Stone, Olga Fox, 2010, 128 kbps, MP3]"), _cat(full, ' "', title, '"'),
        _cat(full, ", Anna ", b, " - ", title), _cat(full, ". ", title, " [Max Stone, MP3] [издание, WEB]"), _cat("сборник песен - ", title)])
    items = _names(t).select(key.alias("item"), subject.alias("subject"), title.alias("body"))
    found = people.infer_authors(items, "subject", "body", "author")
    named = F.array_join(people.author_names(F.col("author")), "|")
    return found.select("item", named.alias("author"), F.array_join(people.infer_narrators(F.col("subject")), "|").alias("narrators"))


@query("cln5_title_narrators", _NAME_SQL + """
select p_partkey as item, 'Тихий дом' as title, case when p_partkey % 2 = 0 then a || ' ' || b end as narrator from n""")
def cln5_title(t: Tables):
    key = F.col("p_partkey")
    text = _cat("Тихий дом", F.when(key % 2 == 0, _cat(". Чтец ", "", F.col("a"), " ", F.col("b"))).otherwise(F.lit("")))
    items = _names(t).select(key.alias("item"), text.alias("title"))
    return people.split_title_narrator(items, "title", "narrator")


@query("cln6_clean_titles", _NAME_SQL + """
select p_partkey as item, case p_partkey % 10 when 8 then 'Хроники 1941 года ' || p_size else 'Тихий дом ' || p_size end as title from n""")
def cln6(t: Tables):
    a, b, key = F.col("a"), F.col("b"), F.col("p_partkey")
    full, title = _cat(a, " ", b), _cat("Тихий дом ", _s("p_size"))
    subject = _pick(key, [
        _cat(full, " - ", title, " [Max Stone, 2010, 128 kbps, MP3]"), _cat(b, " ", a, ". ", title, " (2009, MP3)"),
        _cat("Аудиокнига «", title, "» [Max Stone, Olga Fox]"), _cat(full, ' "', title, '"'),
        _cat(title, " / CD / MP3 / 128 kbps"), _cat("Аудиокниги - ", title, ", mp3, 96 kbps"),
        _cat(title, " (аудиокнига)"), _cat(full, " - ", title, " + FB2, PDF"),
        _cat("Хроники 1941 года ", _s("p_size")), _cat("Серия - ", full, " - ", title, " <обновлено>")])
    subject = F.regexp_replace(subject, "^Серия - ", "")
    body = F.when(key % 4 == 1, title).otherwise(F.lit(""))
    authors = F.when(key % 10 == 8, F.array(F.lit("Кто Угодно"))).otherwise(F.array(full))
    items = _names(t).select(key.alias("item"), subject.alias("subject"),
                             F.when(key % 10 == 8, F.lit("")).otherwise(body).alias("body_title"), authors.alias("authors"))
    return titles.clean_titles(items).select("item", "title")


@query("cln6_healed_titles", r"""
with d as (select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) as t from documents where text is not null),
b as (select doc_id, trim(substr(t, 3, 24)) as body, t from d),
s as (select *, trim(regexp_replace(case doc_id % 3 when 0 then t when 1 then 'No. ' || doc_id || ': ' || substr(body, 1, 3) || '- ' || substr(body, 4, 5) || ' . ' || substr(body, 9) || ' (end)'
    else replace(body, ' ', ', ') || ' / ' || doc_id end, '\s+', ' ', 'g')) as subject from b),
c as (select *, [i for i in range(1, length(subject) + 1) if regexp_matches(subject[i], '[\p{L}\p{N}]')] as place,
  lower(regexp_replace(subject, '[^\p{L}\p{N}]', '', 'g')) as skeleton, lower(regexp_replace(body, '[^\p{L}\p{N}]', '', 'g')) as key from s),
f as (select *, case when length(key) >= 4 then strpos(skeleton, key) else 0 end as hit from c),
w as (select *, place[hit] as first, place[hit + length(key) - 1] as last from f)
select doc_id, md5(case when hit > 0 and length(subject[first:last]) - length(replace(subject[first:last], ' ', '')) > length(body) - length(replace(body, ' ', ''))
  then trim(regexp_replace(subject[1:first - 1] || body || subject[last + 1:], '\s+', ' ', 'g')) else subject end) as digest from w""")
def cln6_healed(t: Tables):
    """Whole texts, and broken spellings of a piece of each text, as subjects; the piece is the body title."""
    text = squeeze(F.col("text"))
    d = t.documents.where(F.col("text").isNotNull()).select("doc_id", text.alias("t")).withColumn("body", F.trim(F.substring("t", 3, 24)))
    b, key = F.col("body"), F.col("doc_id")
    broken = _cat("No. ", _s(key), ": ", F.substring(b, 1, 3), "- ", F.substring(b, 4, 5), " . ", F.substring(b, 9, 99), " (end)")
    subject = F.when(key % 3 == 0, F.col("t")).when(key % 3 == 1, broken).otherwise(_cat(F.replace(b, F.lit(" "), F.lit(", ")), " / ", _s(key)))
    return d.select("doc_id", F.md5(titles.heal_soft_breaks(subject, b).cast("binary")).alias("digest"))


@query("cln6_final_titles", _NAME_SQL + """
, f as (select p_partkey, p_name, p_type, p_size, p_partkey % 6 as shape from n)
select p_partkey as item, case shape when 0 then p_name when 1 then p_name when 2 then 'Ёлки ' || p_size || '0 ' || p_name when 3 then p_name
  when 4 then p_name || ' [' || upper(p_type) || '!]' else p_name end as title from f""")
def cln6_final(t: Tables):
    """Series and body run together, with zeros and a letter folded or not; confirmed and unconfirmed suffixes."""
    key, name = F.col("p_partkey"), F.col("p_name")
    title = _pick(key, [_cat("Ёлки 0", _s("p_size"), " ", name), _cat("ЕЛКИ 000", _s("p_size"), " - ", name), _cat("Ёлки ", _s("p_size"), "0 ", name),
                        _cat(name, " [", F.upper("p_type"), "]"), _cat(name, " [", F.upper("p_type"), "!]"), _cat(name, " [", F.col("b"), " ", F.col("a"), "]")])
    named = _names(t).select(key.alias("item"), titles.final_title(
        title, F.array(_cat(F.col("a"), " ", F.col("b"))), F.array("p_type"), _cat("Елки ", _s("p_size")), name).alias("title"))
    return named


@query("jn6_fuzzy_author_prefix", _NAME_SQL + """
select p_partkey as item, p_partkey % 5 <> 4 as named from n""")
def jn6(t: Tables):
    a, b, key = F.col("a"), F.col("b"), F.col("p_partkey")
    given = F.lit("Александра")
    left = _pick(key, [_cat(given, " ", a, " (", b, ")"), _cat("Алексндра ", a), _cat(F.substring(a, 1, 1), " ", given),
                       _cat("Алекс андра ", a, " и др"), _cat("Max ", a)])
    items = _names(t).select(key.alias("item"), left.alias("left"), F.array(_cat(given, " ", a)).alias("authors"))
    return items.withColumn("known", people.author_tokens("authors")).select(
        "item", F.expr(people.names_any("left", "authors", "known")).alias("named"))


_WORDS = "regexp_extract_all(lower({0}), '[a-zа-яё0-9]+')"
_NOISE = "('" + "', '".join(fixed.PERSON_TOKEN_NOISE) + "')"


@query("jn6_people_across_tables", "with recursive d as (select doc_id, array_to_string(" + _WORDS.format("text") + "[1:2], ' ') as txt from documents), "
       "b as (select array_to_string(" + _WORDS.format("text") + "[1:3], ' ') as name from benchmark), "
       "people as (select ts, min(name) as match from (select name, list_sort([w for w in " + _WORDS.format("name")
       + " if w not in " + _NOISE + "]) as ts from (select distinct name from b) q) k where len(ts) > 0 group by ts), "
       "texts as (select distinct txt, [w for w in " + _WORDS.format("txt") + " if w not in " + _NOISE + """] as ws from d),
readings as (select txt, [w for w in list_distinct(ws) if len(w) > 1] as r from texts
  union select txt, [w for w in [ws[1] || ws[2]] if len(w) > 1] from texts where len(ws) = 2),
words as (select distinct unnest(r) as w from readings), tokens as (select distinct unnest(ts) as t from people),
boxes as (select w, t, w as a, t as b, 0 as hit from words, tokens where w <> t and least(len(w), len(t)) >= 4
    and 200 * least(len(w), len(t)) >= 84 * (len(w) + len(t)) and 100 * levenshtein(w, t) <= 16 * (len(w) + len(t))
  union all
  select w, t, x.side.a, x.side.b, x.side.hit from (select w, t, unnest([
      {'a': a[1:i - 1], 'b': b[1:strpos(b, a[i:i + k - 1]) - 1], 'hit': k},
      {'a': a[i + k:], 'b': b[strpos(b, a[i:i + k - 1]) + k:], 'hit': 0}]) as side
    from (select w, t, a, b, i, k from (select w, t, a, b, i, k, row_number() over (partition by w, t, a, b order by k desc, i) as no
      from (select w, t, a, b, i, unnest(range(1, len(a) - i + 2)) as k from (
        select w, t, a, b, unnest(range(1, len(a) + 1)) as i from boxes where a <> '' and b <> '') s1) s2
      where contains(b, a[i:i + k - 1])) s3 where no = 1) s4) x),
close as (select w, t from words, tokens where w = t or (len(w) = 1 and len(t) > 1 and starts_with(t, w))
    or (len(t) = 1 and len(w) > 1 and starts_with(w, t))
  union select w, t from boxes group by w, t having 200 * sum(hit) >= 84 * (len(w) + len(t))),
places as (select ts, match, unnest(range(1, len(ts) + 1)) as i from people),
near as (select r, ts, match, 1 as no, i from (select distinct r from readings where len(r) > 0) q, places, close where w = r[1] and t = ts[i]
  union select r, ts, match, 2, i from (select distinct r from readings where len(r) = 2) q, places, close where w = r[2] and t = ts[i]),
firsts as (select r, ts, match, min(i) as i from near where no = 1 group by all),
named as (select r, match from firsts where len(r) = 1
  union select f.r, f.match from firsts f join near n on n.r = f.r and n.ts = f.ts and n.no = 2 and n.i <> f.i)
select distinct doc_id, match from d join readings using (txt) join named using (r)""")
def jn6_across(t: Tables):
    """People called by the first three words of a passage, named by the first two words of a document."""
    words = lambda n: F.array_join(F.slice(F.regexp_extract_all(
        F.lower("text"), F.lit("([a-zа-яё0-9]+)"), 1), 1, n), " ")
    left = t.documents.select("doc_id", words(2).alias("txt"))
    return people.match_people_fuzzy(left, t.benchmark.select(words(3).alias("name")), "txt", "name").select("doc_id", "match")


@query("jn5_same_people", """
with names as (select distinct p_name, array_to_string(list_sort(string_split(p_name, ' ')), ' ') as k from part),
rev as (select p_partkey, split_part(p_name, ' ', 2) || '  ' || upper(split_part(p_name, ' ', 1)) as written, p_name from part)
select p_partkey, written, k as person_key, (select min(n.p_name) from names n where n.k = array_to_string(list_sort(string_split(rev.p_name, ' ')), ' ')) as match
from rev join names on names.p_name = rev.p_name""")
def jn5(t: Tables):
    words = F.split("p_name", " ")
    left = t.part.select("p_partkey", _cat(words[1], "  ", F.upper(words[0])).alias("written"))
    return people.match_people_exact(left, t.part, "written", "p_name")


_TOK = r"list_distinct(regexp_extract_all(lower({0}), '[a-zа-яё0-9]{{2,}}'))"


@query("jn7_passages_in_documents", "with b as (select item_id, " + _TOK.format("text") + " as w from benchmark), d as (select doc_id, " + _TOK.format("text")
       + """ as w from documents), p as (select item_id, doc_id, len(list_intersect(b.w, d.w)) as shared, len(b.w) as words from b, d)
select * from p where words > 0 and shared >= words * 0.67 - 1e-9""")
def jn7(t: Tables):
    return titles.match_titles(t.benchmark, t.documents, "item_id", "doc_id", "text", "text")


@query("jn7_titles_by_rules", """
with b as (select item_id * 4 + k as title_no, lower(trim(regexp_replace(case k when 0 then split_part(text, '.', 1)
      when 1 then array_to_string(string_split_regex(text, '\\s+')[1:2], ' ') when 2 then substr(text, 2, 4)
      else split_part(text, '.', 2) || '!' end, '\\s+', ' ', 'g'))) as t from benchmark, range(4) as r(k)),
d as (select doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) as t from documents where text is not null),
bw as (select *, """ + _TOK.format("t") + " as w, regexp_replace(t, '[^\\p{L}\\p{N}]', '', 'g') as key from b where t <> ''), "
       "dw as (select *, " + _TOK.format("t") + """ as w, regexp_replace(t, '[^\\p{L}\\p{N}]', '', 'g') as key from d where t <> ''),
p as (select title_no, doc_id, bw.key as bk, dw.key as dk, bw.t as bt, dw.t as dt, len(list_intersect(bw.w, dw.w)) as n, len(bw.w) as nb, len(dw.w) as nd from bw, dw)
select title_no, doc_id, rule from (select *, case when bk <> '' and bk = dk then 'equal key' when contains(dt, bt) or contains(bt, dt) then 'contained'
  when n > 0 and n >= nb * 0.67 - 1e-9 then 'shared words' when n >= 4 and n >= least(nb, nd) * 0.6 - 1e-9 then 'shared most' end as rule from p) q
where rule is not null""")
def jn7_rules(t: Tables):
    """Sentences, word pairs and letters of the passages as titles, whole documents as subjects."""
    sentence = lambda n: F.coalesce(F.get(F.split("text", r"\."), F.lit(n)), F.lit(""))
    kinds = F.array(sentence(0), F.array_join(F.slice(F.split("text", r"\s+"), 1, 2), " "), F.substring("text", 2, 4),
                    _cat(sentence(1), "!"))
    bodies = t.benchmark.select("item_id", F.posexplode(kinds).alias("k", "title")).select(
        (F.col("item_id") * 4 + F.col("k")).alias("title_no"), "title")
    return titles.match_titles_by_rules(bodies, t.documents, "title_no", "doc_id", "title", "text")


@query("jn9_reconciled_titles", """
select p_partkey, case p_partkey % 5 when 0 then p_name when 1 then p_name || ' volume' when 2 then upper(p_name) || '!' when 3 then p_name || ' stored' else p_name || ' stays' end as title,
  case p_partkey % 5 when 0 then 'gone' when 1 then 'new' else 'both' end as side from part""")
def jn9(t: Tables):
    key, name = F.col("p_partkey"), F.col("p_name")
    stored = t.part.where(key % 5 != 1).select("p_partkey", _pick(key, [name, name, _cat(name, " [MP3, 128 kbps]"), _cat(name, " stored"), _cat(name, " stays")]).alias("title"), F.array().cast("array<string>").alias("authors"))
    incoming = t.part.where(key % 5 != 0).select(
        "p_partkey", _pick(key, [name, _cat(name, " volume"), _cat(F.upper(name), "!"), name, F.lit("unrelated thing")]).alias("title"), F.array().cast("array<string>").alias("authors"))
    return titles.reconcile(stored, incoming, "p_partkey", authors="authors")


@query("jn11_confirmed_suffixes", """
select p_partkey, p_name || case when p_partkey % 3 = 1 then ' [other]' else '' end as clean_title, p_partkey % 3 <> 1 as confirmed from part""")
def jn11(t: Tables):
    key = F.col("p_partkey")
    items = t.part.select("p_partkey", _cat(F.col("p_name"), " [", _pick(key, [F.array_join(F.reverse(F.split(F.upper("p_type"), " ")), " "), F.lit("other"), F.lower("p_brand")]), "]").alias("title"))
    dimension = t.part.select("p_partkey", F.explode(F.array("p_type", "p_brand")).alias("value"))
    return titles.suffix_matches_dimension(items, dimension, ["p_partkey"], "title", "value", people=True).select("p_partkey", "clean_title", "confirmed")


@query("cln7_series_names", """
select o_orderkey, case (o_orderkey // 3) % 6 when 3 then null when 5 then null else 'Хроники ' || o_orderkey end as name from orders""")
def cln7(t: Tables):
    key = F.col("o_orderkey")
    name = _cat("Хроники ", _s(key))
    raw = _pick(F.floor(key / 3), [_cat("Цикл «", name, "»"), _cat(name, " Номер книги: 7 Жанр: проза"), _cat("/Серия: ", name, ";"),
                                   F.lit("Номер книги"), _cat('"', name, '"'), F.repeat(F.lit("длинно "), 40)])
    return t.orders.select("o_orderkey", series.clean_series_name(raw).alias("name"))


@query("cln7_entry_titles", "select o_orderkey, 'Книга ' || o_orderkey as title from orders")
def cln7_entries(t: Tables):
    key = F.col("o_orderkey")
    base = _cat("Книга ", _s(key))
    raw = _pick(F.floor(key / 2), [
        _cat(base, " https://posts.example.org/t1 читает кто-то"), _cat(base, " в исполнении Кого-то"), _cat(base, " - данная раздача"),
        _cat(base, " // Автор: Кто-то"), _cat(base, " *примечание"), _cat(base, ", Max Stone, 2011]"), _cat(base, "; книга вышла в 1999 году")])
    narrators = F.array(F.lit("Max Stone"))
    return t.orders.select("o_orderkey", series.clean_entry_title(raw, narrators).alias("title"))


_ROMAN = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X"]


@query("cln8_series_positions", """
select o_orderkey, case o_orderkey % 6 when 0 then o_orderkey % 999 + 1 when 1 then o_orderkey % 10 + 1 when 2 then o_orderkey % 900 + 1
  when 3 then o_orderkey % 50 + 1 when 4 then null else null end::int as position,
  case when o_orderkey % 3 = 0 then o_orderkey % 77 + 1 when o_orderkey % 3 = 1 then o_orderkey % 9 + 1 else o_orderkey % 300 + 1 end::int as from_fields from orders""")
def cln8(t: Tables):
    key = F.col("o_orderkey")
    text = _pick(key, [
        _cat("Мрак. Книга №", _s(key % 999 + 1)), _cat("Мрак том ", _pick(key, _ROMAN)), _cat("Мрак ", _s(key % 900 + 1), ". Начало"),
        _cat("Иной мрак и свет - ", _s(key % 50 + 1)), _cat("Совсем другое 1999"), F.lit("Мрак и свет")])
    position = series.position_in_title(text, F.lit("Мрак"))
    field = F.when(key % 3 == 0, _cat(_s(key % 77 + 1), " из 99")).otherwise("")
    title = F.when(key % 3 == 1, _cat("Путь. Часть № 0", _s(key % 9 + 1))).otherwise(_cat("Мрак - 00", _s(key % 300 + 1), " окончание"))
    title = F.when(key % 3 == 2, F.regexp_replace(title, " 0+", " ")).otherwise(title)
    return t.orders.select("o_orderkey", position.cast("int").alias("position"),
                           series.position_in_fields(title, F.lit(""), F.lit("Мрак"), field).cast("int").alias("from_fields"))


@query("cln9_genres", """
select p_partkey, p_type || '|' || p_brand as genres, case when p_partkey % 2 = 0 then 'Cycle ' || p_size end as hint from part""")
def cln9(t: Tables):
    key = F.col("p_partkey")
    text = _cat(F.col("p_type"), " ; ", F.col("p_brand"), "/ Аудиокнига", F.when(key % 2 == 0, _cat(", серия: Cycle ", _s("p_size"))).otherwise(F.lit(", ")))
    return t.part.select("p_partkey", F.array_join(catalog.split_genres(text), "|").alias("genres"), catalog.series_hint(text).alias("hint"))


_LINES_SQL = r"""
with n as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) as no, unnest(string_split(text, chr(10))) as raw from documents),
l as (select doc_id, no, trim(regexp_replace(raw, '\s+', ' ', 'g')) as line from n)
"""


def _lines(t: Tables):
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "raw")).select(
        "doc_id", (F.col("no") + 1).alias("no"), squeeze("raw").alias("line"))


@query("flt1_good_labels", _LINES_SQL + r"""
select doc_id, count(*) as labels, sum(length(line))::bigint as characters from l
where line <> '' and length(line) <= 160 and not regexp_full_match(line, '\d+') group by doc_id""")
def flt1(t: Tables):
    return links.good_labels(_lines(t), "line").groupBy("doc_id").agg(
        F.count("*").alias("labels"), F.sum(F.length("line")).alias("characters"))


@query("flt4_person_like", """
select c_custkey, c_custkey % 6 in (0, 1, 4) as person, c_custkey % 6 = 0 as strict, c_custkey % 2 = 0 as list from customer""")
def flt4(t: Tables):
    key = F.col("c_custkey")
    text = _pick(key, ["Анна Петрова", "А. Б. Петров-Водкин", F.col("c_name"), "сборник Петрова", F.initcap("c_mktsegment"), "Анна петрова"])
    listed = F.when(key % 2 == 0, F.lit("Анна Петрова, Олег Смирнов; Max Stone")).otherwise(F.lit("Анна Петрова, 1999"))
    return t.customer.select("c_custkey", people.person_like(text).alias("person"), people.person_like_strict(text).alias("strict"),
                             people.person_list_like(listed).alias("list"))


@query("flt5_release_metadata", _LINES_SQL + r"""
select doc_id, no, regexp_matches(line || ' ' || doc_id, '(?i)(\b(19|20)\d{2}\b|\b(\d{2,4}\s*)?k(bps|bs)\b|\b\d{2,4}\s*kb/s\b|\b(mp3|m4a|m4b|aac|ogg|opus|flac|wav|wma)\b|\b(web|digital\s+release|cd|lossless)\b)') as release,
  doc_id % 2 = 0 as dirty from l where line <> ''""")
def flt5(t: Tables):
    lines = _lines(t).where(F.col("line") != "")
    marked = F.when(F.col("doc_id") % 2 == 0, F.lit("x [128 kbps")).otherwise(F.lit("чистое"))
    return lines.select("doc_id", "no", titles.has_release_metadata(F.concat_ws(" ", "line", _s("doc_id"))).alias("release"),
                        titles.title_is_dirty(marked).alias("dirty"))


@query("flt6_non_entries", _LINES_SQL + r"""
select doc_id, count(*) as kept from l where line <> '' and length(line) <= 240
 and not regexp_matches(line, '(?i)(\.(mp3|m4[ab]|aac|ogg|opus|flac|wav|wma)\b|\bbitrate\b|\b\d{2,4}\s*(kbps|kb/s)\b|[\[(]\d{1,3}:\d{2}(:\d{2})?[\])]\s*$)') group by doc_id""")
def flt6(t: Tables):
    return series.drop_non_entries(_lines(t), "line").groupBy("doc_id").agg(F.count("*").alias("kept"))


@query("flt7_content_lists", """
with e as (select o_custkey as item, o_orderkey, o_orderkey % 11 as position, o_custkey % 3 = 0 and o_orderkey % 4 = 0 as linked from orders),
s as (select item, count(*) as n, bool_or(linked) as linked, bool_or(position = 0) as zero from e group by item)
select item, n from s where not (not linked and (n > 50 or (n >= 10 and zero)))""")
def flt7(t: Tables):
    key = F.col("o_orderkey")
    entries = t.orders.select(
        F.col("o_custkey").alias("item"), (key % 11).alias("position"), _cat("Tome ", _s(key)).alias("title"),
        F.when((F.col("o_custkey") % 3 == 0) & (key % 4 == 0), F.lit("u")).alias("entry_url"),
        F.lit("Saga").alias("series_name"), F.lit("Tome").alias("current_title"))
    kept = series.drop_content_lists(entries, ["item"])
    return kept.groupBy("item").agg(F.count("*").alias("n"))


@query("set3_token_sets", """
with w as (select p_partkey, string_split(p_name, ' ') as n, [lower(p_type), split_part(p_name, ' ', 1)] as k from part)
select p_partkey, len(list_intersect(n, k)) as shared, len(list_distinct(list_concat(n, k))) as united from w""")
def set3(t: Tables):
    names, kinds = F.split("p_name", " "), F.array(F.lower("p_type"), F.split("p_name", " ")[0])
    return t.part.select("p_partkey", F.size(F.array_intersect(names, kinds)).alias("shared"), F.size(F.array_union(names, kinds)).alias("united"))


@query("srt1_natural_order", """
select p_partkey, row_number() over (partition by p_brand order by p_size, p_partkey) as place from part""")
def srt1(t: Tables):
    path = _cat("Disc ", F.when(F.col("p_partkey") % 2 == 0, F.lit("0")).otherwise(F.lit("")), _s("p_size"), "/track ", _s("p_partkey"))
    keyed = t.part.select("p_brand", "p_partkey", natural_key(path).alias("key"))
    placed = running_totals(keyed, ["p_brand"], [F.col("key")], {"place": F.lit(1)})
    return placed.select("p_partkey", "place")


@query("srt2_stable_entry_order", """
select p_size, lower(p_name) as folded, p_partkey, row_number() over (partition by p_size order by lower(p_name), p_partkey) as place from part""")
def srt2(t: Tables):
    entries = t.part.select("p_size", "p_partkey", F.lower("p_name").alias("folded"))
    return running_totals(entries, ["p_size"], [F.col("folded"), F.col("p_partkey")], {"place": F.lit(1)})


@query("srt3_truncated_text", "select doc_id, length(substr(text, 1, 500)) as message, length(substr(text, 1, 5000)) as whole, md5(substr(text, 1, 500)) as digest from documents")
def srt3(t: Tables):
    cut = F.substring("text", 1, 500)
    return t.documents.select("doc_id", F.length(cut).alias("message"), F.length(F.substring("text", 1, 5000)).alias("whole"),
                              F.md5(cut.cast("binary")).alias("digest"))


@query("title_keys", r"""
select p_partkey, 'тихийелкидом' || p_partkey || replace(p_name, ' ', '') as title_key from part""")
def title_keys(t: Tables):
    text = _cat("Тихий Ёлки - дом, 00", _s("p_partkey"), " ", F.col("p_name"))
    return t.part.select("p_partkey", title_key(text).alias("title_key"))
