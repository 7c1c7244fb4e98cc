"""Page snapshots derived from the given tables.

The given pages have no cards, labelled fields, images or lists. These frames
turn every row of ``part`` into one page of each kind by row-local expressions,
so their size follows the table and no group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CARD_HOST = "https://cards.example.org"
POST_HOST = "https://posts.example.org"


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows over all tasks before a page is built from each: a small
    one-file table would otherwise be tokenized in a single task."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, key)


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _each(count: Column, build) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), count - 1), build), "")


def two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def clock(seconds: Column) -> Column:
    hour = F.floor(seconds / 3600)
    return F.concat_ws(":", hour.cast("string"), two_digits(F.floor(seconds / 60) % 60), two_digits(seconds % 60))


def card_pages(part: DataFrame) -> DataFrame:
    """Listing pages: 1 to 4 cards per part row, with numbers ``10 * key + i``.

    Card 2 has no signal at all; card 0 repeats its title link at the end; all
    but card 1 show a duration; a numeric pager opens the page.
    """
    def card(i: Column) -> Column:
        number = F.col("p_partkey") * 10 + i
        anchor = _cat('<a href="/', _s(number), '/">', F.col("p_name"), " ", _s(i), "</a>")
        labels = _cat(
            '<a href="/author/', _s("p_size"), '/">', F.col("p_brand"), "</a><a href='/voice/1/'>Reader ",
            _s(F.col("p_partkey") % 7), '</a><a href="/genre/x/">', F.lower("p_type"), '</a><a href="/series/',
            _s("p_size"), '/">Series ', _s("p_size"), "</a>")
        duration = F.when(i != 1, _cat("<span>", clock(60 + (F.col("p_partkey") + i) % 30000), "</span>")).otherwise("")
        return _cat('<div class="card"><a href="/', _s(number), '/"><img src="/c.jpg"></a>', anchor,
                    F.when(i == 2, F.lit("")).otherwise(F.concat(labels, duration)), "</div>")

    body = _each(1 + F.col("p_size") % 4, card)
    return spread(part, "p_partkey").select(
        F.col("p_partkey").alias("page_id"), _cat(CARD_HOST, "/p", _s("p_partkey"), "/").alias("url"),
        _cat("<html><body><nav><a href='/9/'>9</a><a href=\"/p", _s(F.col("p_size") + 1), '/">',
             _s(F.col("p_size") + 1), "</a></nav>", body, "</body></html>").alias("html"))


def table_pages(part: DataFrame) -> DataFrame:
    """Listing tables: 1 to 5 rows per part row; the last row of long tables has no download link."""
    def row(i: Column) -> Column:
        number = F.col("p_partkey") * 10 + i
        size = _cat(_s(F.col("p_size") + i), ".5 ", F.element_at(F.array(*map(F.lit, ["KB", "MB", "GB"])), (i % 3 + 1).cast("int")))
        download = F.when(i == 4, F.lit("<td>-</td>")).otherwise(
            _cat('<td><a href="dl.php?t=', _s(number), '">', size, "</a></td>"))
        return _cat('<tr id="tr-', _s(number), '"><td><a class="torTopic" href="viewtopic.php?t=', _s(number), '">',
                    F.col("p_name"), "<wbr> ", _s(i), "</a></td>", download,
                    '<td><b class="seedmed">', _s(F.col("p_size") * 10 + i), '</b></td><td><b class="leechmed">',
                    _s(i), F.when(i == 3, F.lit(" дн")).otherwise(F.lit("")), "</b></td></tr>")

    body = _each(1 + F.col("p_size") % 5, row)
    return spread(part, "p_partkey").select(
        F.col("p_partkey").alias("page_id"),
        _cat(POST_HOST, "/forum/viewforum.php?f=", _s(F.col("p_partkey") % 23)).alias("url"),
        _cat('<html><body><table class="forum">', body, "</table>",
             '<a href="viewforum.php?f=1&amp;start=', _s(F.col("p_size") * 50), '">next</a>',
             "</body></html>").alias("html"))


def search_pages(part: DataFrame) -> DataFrame:
    """Search results: 1 to 4 rows per part row; even rows state the exact size as an
    attribute, some counter cells show an age."""
    def row(i: Column) -> Column:
        number = F.col("p_partkey") * 10 + i
        exact = F.when(i % 2 == 0, _cat(' data-ts_text="', _s(F.col("p_partkey") * 1000 + i), '"')).otherwise("")
        seeds = F.when(i % 3 == 1, _cat(_s(i), " дн")).otherwise(_s(F.col("p_size") + i))
        return _cat('<tr><td>1</td><td>2</td><td class="f-name-col"><a href="tracker.php?f=9">F</a></td><td class="t-title-col">',
                    '<a class="tLink" href="viewtopic.php?t=', _s(number), '">', F.col("p_name"), " ", _s(i), "</a></td><td>who</td>",
                    '<td class="tor-size"', exact, '><a class="tr-dl" href="dl.php?t=', _s(number), '">', _s(F.col("p_size") + i),
                    " KB</a></td><td>", seeds, "</td><td>", _s(i), " дн</td></tr>")

    return spread(part, "p_partkey").select(
        F.col("p_partkey").alias("page_id"), _cat(POST_HOST, "/forum/tracker.php").alias("url"),
        _cat('<html><body><table id="tor-tbl"><tbody>', _each(1 + F.col("p_size") % 4, row), "</tbody></table></body></html>").alias("html"))


def post_pages(part: DataFrame) -> DataFrame:
    """Posts with labelled fields, images, and a series list.

    The list is linked for even sizes (entry 2 has a link), a spoiler for sizes
    divisible by 3, else plain lines behind a heading; the third field is
    present but empty for every fifth part.
    """
    name, size, key = F.col("p_name"), F.col("p_size"), F.col("p_partkey")
    series = _cat("Saga ", F.col("p_type"))
    field = lambda label, value: _cat('<span class="post-b">', label, "</span>: ", value, "<br>")
    count = 3 + size % 4

    def entry(i: Column) -> Column:
        text = _cat("Tome of ", name, " ", _s(i + 1))
        linked = F.when((i == 1) & (size % 2 == 0), _cat(
            '<a href="viewtopic.php?t=', _s(key * 100 + i), '">', text, "</a>")).otherwise(text)
        return _cat(_s(i + 1), ". ", linked, "<br>")

    entries = _each(count, entry)
    block = F.when(size % 3 == 0, _cat(
        '<div class="sp-wrap"><div class="sp-head">Цикл «', series, '»</div><div class="sp-body">', entries,
        "</div></div>")).otherwise(_cat("<br>Книги цикла «", series, "»<br>", entries, "конец<br>"))
    images = _cat('<img src="/smiles/x.gif"><img width="', _s(size * 20), '" height="', _s(F.lit(600)),
                  '" src="/i/', _s(key), '.jpg"><img src="/plain/', _s(key), '.png">',
                  F.when(size % 4 == 0, _cat('<var class="postImg img-right" title="', POST_HOST, "/v/", _s(key),
                                             '.jpg"></var>')).otherwise(F.lit("")))
    return spread(part, "p_partkey").select(
        key.alias("page_id"), _cat(POST_HOST, "/forum/viewtopic.php?t=", _s(key)).alias("url"),
        _cat('<html><body><h1 class="maintitle"><a>', name, '</a></h1><div class="post_body">',
             field("Автор", _cat("Brand ", _s(key % 5))),
             field("Исполнитель", F.when(key % 5 == 0, F.lit("")).otherwise(_cat("<i>Reader</i> ", _s(key % 7)))),
             field("Цикл/серия", series),
             field("Номер книги", _s(size % 3 + 1)),
             field("Время звучания", clock(key % 30000)),
             '<span class="post-b">Описание</span>: <span class="post-b">All</span> about ', name, "<hr>", images, block,
             "</div></body></html>").alias("html"))


def detail_pages(part: DataFrame) -> DataFrame:
    """Detail pages: embedded part objects (one repeated), quoted media for every
    fourth part, takedown wording for sizes divisible by 7, trial addresses for
    sizes divisible by 5, nothing at all for sizes divisible by 11."""
    key, size = F.col("p_partkey"), F.col("p_size")
    host = F.when(size % 5 == 0, F.lit("trial.example.net\\/audiotrial")).otherwise(F.lit("media.example.net\\/a"))

    def part_object(i: Column) -> Column:
        return _cat('{"fileId":', _s(key * 10 + i), ',"title":"Part &amp; ', _s(i + 1), '","src":"https:\\/\\/', host, "\\/",
                    _s(key), "-", _s(i), '.mp3","duration":', _s(i * 60), "},")

    count = 1 + size % 4
    script = _cat("<script>var list=[", _each(count, part_object), part_object(F.lit(0)), "];</script>")
    quoted = _cat('<script>play("', "//media.example.net/q/", _s(key), '.mp3");</script>')
    media = F.when(size % 11 == 0, F.lit("")).when(key % 4 == 0, quoted).otherwise(script)
    notice = F.when(size % 7 == 0, F.lit("Аудиокнига удалена по требованию правообладателя")).otherwise(F.lit(""))
    return spread(part, "p_partkey").select(
        key.alias("page_id"), _cat(CARD_HOST, "/", _s(key), "/").alias("url"),
        _cat('<html><head><title>', F.col("p_name"), " | Shelf</title></head><body><h1>", F.col("p_name"),
             '</h1><div class="book-page-description">', notice, "</div>", media, "</body></html>").alias("html"))


def playlists(part: DataFrame) -> DataFrame:
    """Playlist JSON per part: gaps from a text, an empty id and a missing address."""
    key, size = F.col("p_partkey"), F.col("p_size")

    def item(i: Column) -> Column:
        good = _cat('{"id":', _s(key * 10 + i), ',"title":"', F.when(i % 2 == 0, _cat("Track ", _s(i + 1))).otherwise(""),
                    '","file":"https://m.example.net/', _s(key), "/", _s(i), ".mp3 or https://m.example.net/",
                    _s(key), "/", _s(i), '.mp3?d=1"}')
        return F.when((i + size) % 5 == 0, F.lit('"note"')).when(
            (i + size) % 5 == 1, F.lit('{"id":"","title":"x","file":"https://m.example.net/z.mp3"}')).when(
            (i + size) % 5 == 2, F.lit('{"id":"7","title":"no address","file":"none"}')).otherwise(good)

    count = size % 6
    body = F.when(count > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), item), ",")).otherwise(F.lit(""))
    return spread(part, "p_partkey").select(key.alias("item"), F.concat(F.lit("["), body, F.lit("]")).alias("playlist"))


def file_lists(part: DataFrame) -> DataFrame:
    """File lists per part: 1 to 12 tracks in mixed order, a cover and a blank path."""
    key, size = F.col("p_partkey"), F.col("p_size")
    track = lambda i: F.struct(
        _cat("disc", _s(F.pmod(i, F.lit(2)) + 1), "\\Track ", _s(i + 1), F.when(i % 3 == 0, F.lit(".MP3")).otherwise(F.lit(".ogg"))).alias("path"),
        ((i + 1) * 1000 + key % 100).cast("string").alias("length"))
    extra = F.array(F.struct(F.lit(" ").alias("path"), F.lit("5").alias("length")),
                    F.struct(F.lit("cover.jpg").alias("path"), F.lit("-7").alias("length")))
    tracks = F.transform(F.sequence(F.lit(0), size % 12), track)
    return spread(part, "p_partkey").select(
        key.alias("item"), F.substring(F.sha1(_s(key).cast("binary")), 1, 40).alias("content_key"),
        (key % 5000).cast("int").alias("duration_seconds"), F.concat(extra, tracks).alias("files"))


def whole_posts(part: DataFrame) -> DataFrame:
    """Posts of six shapes: release brackets and a series hint among genres; surname and given name without a
    description; an undisclosed author; a sermon; people named by the subject alone; a reader in the title and a
    numbered list of entries."""
    key, size, k = F.col("p_partkey"), F.col("p_size"), _s("p_partkey")
    shape = key % 6
    book, saga = _cat("Повесть ", k, " ", F.col("p_name")), _cat("Сага ", F.col("p_type"))
    field = lambda label, value: _cat('<span class="post-b">', label, "</span>: ", value, "<br>")
    choose = lambda values: F.element_at(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (shape + 1).cast("int"))
    subject = choose([
        _cat("Анна Лугова - ", book, " [проза] [Max Stone, 2010, MP3, 128 kbps]"), book, _cat("Бренд - Аудиокнига «", book, "»"),
        "Аудиопроповеди пастора Петра Зимина", _cat("Олег Туров - ", book, " [Max Stone, Olga Fox, 2011, MP3, 96 kbps]"),
        _cat(book, ". Чтец Max Stone")])
    reader = field("Исполнитель", F.lit("Ада Орлова"))
    about = field("Описание", _cat("About ", k))
    head = choose([
        _cat(field("Автор", F.lit("Анна Лугова")), field("Жанр", _cat("аудиокнига, проза; серия: ", saga)), field("Исполнитель", F.lit("Max Stone")),
             field("Номер книги", _s(size % 3 + 1)), about),
        _cat(field("Фамилия автора", F.lit("Лугова")), field("Имя автора", F.lit("Анна")), reader),
        _cat("автор неизвестен<br>", reader, about), _cat("краткая биография: Пётр Зимин, проповедник<br>", about),
        _cat(field("Название", book), about),
        _cat(field("Автор", F.lit("Анна Лугова")), field("Цикл/серия", saga), reader, about)])
    time = F.when(shape == 1, F.lit("")).otherwise(field("Время звучания", clock(key % 30000)))
    entries = F.when(shape == 5, _cat("<br>Книги цикла «", saga, "»<br>1. Начало ", k, "<br>2. ", book, "<br>3. Конец ", k, "<br>прочее<br>")).otherwise("")
    image = _cat('<img src="/smiles/x.gif"><var class="postImg img-right" title="', POST_HOST, "/v/", k, '.jpg"></var>')
    return spread(part, "p_partkey").select(
        key.alias("page_id"), _cat(POST_HOST, "/forum/viewtopic.php?t=", k).alias("url"),
        _cat('<html><body><h1 class="maintitle"><a>', subject, '</a></h1><div class="post_body">', head, time, "<hr>", image, entries,
             "</div></body></html>").alias("html"))


def post_media(part: DataFrame) -> DataFrame:
    """File lists of posts: tracks, for every third size a scan instead, and none for sizes divisible by 7."""
    size = F.col("p_size")
    scan = F.array(F.struct(F.lit("scan.jpg").alias("path"), F.lit("7").alias("length")))
    lists = file_lists(part).join(part.select(F.col("p_partkey").alias("item"), "p_size"), "item")
    return lists.select(F.col("item").alias("page_id"), "content_key", F.col("content_key").alias("actual_key"), F.when(
        size % 7 == 0, F.lit(None)).when(size % 3 == 0, scan).otherwise(F.col("files")).alias("files"))
