"""Page fixtures: nodes, cards, tables, fields, images, series lists, parts."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from catalogloom.functions import fixed
from catalogloom.operators import catalog, fields, images, links, listing, nodes, series
from catalogloom.sources import files, parts
from catalogloom.sources.pages import decode_pages


def pages(spark, *html, url="https://cards.example.org/x/"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(html)], "page_id bigint, url string, html string")


def test_nodes_of_broken_markup(spark):
    tree = nodes.page_nodes(pages(spark, "<p>a<b>b<br>c</p>d<script>x<y</script><wbr></z>"))
    rows = {r.seq: (r.tag, r.end_seq, r.depth, r.parent_seq, r.text) for r in tree.collect()}
    assert rows[1] == ("p", 6, 0, 0, None) and rows[3] == ("b", 6, 1, 1, None)
    assert rows[7] == ("#text", 7, 0, 0, "d") and rows[9] == ("#raw", 9, 1, 8, "x<y")


def test_owner_is_outermost(spark):
    tree = nodes.page_nodes(pages(spark, "<ul><li>a<ul><li>b</li></ul></li></ul><p>c</p>"))
    owned = nodes.mark_owner(tree, F.col("tag") == "li", "o").where(F.col("text").isNotNull())
    assert {r.text: r.o for r in owned.collect()} == {"a": 2, "b": 2, "c": None}


def test_two_cards_do_not_mix(spark):
    html = ('<div><a href="/11/">First</a><a href="/author/1/">Ann Lee</a><a href="/series/9/">Saga</a> 01:02:03'
            '<a href="/12/">Second</a><a href="/voice/2/">Max Fox</a></div>')
    cards, labels = listing.segment_listing(nodes.page_nodes(pages(spark, html)), pages(spark, html))
    got = {r.external_id: (r.title, r.duration_seconds, r.series_id, r.series_name) for r in cards.collect()}
    assert got == {"11": ("First", 3723, "9", "Saga"), "12": ("Second", 0, None, None)}
    assert sorted((r.kind, r.label) for r in labels.collect()) == [("author", "Ann Lee"), ("narrator", "Max Fox"), ("series", "Saga")]


def test_fields_stop_at_known_labels(spark):
    html = ('<div class="post_body"><span class="post-b">Автор</span>: <span class="post-b">Анна Лугова</span><br>'
            '<span class="post-b">Имя автора</span>:<br><span class="post-b">Жанр</span>: проза '
            '<span class="post-b">Описание</span>: река<hr>хвост</div>')
    found = fields.labelled_segments(nodes.page_nodes(pages(spark, html)))
    assert {r.label: r.value for r in found.collect()} == {
        "автор": "Анна Лугова", "имя автора": "", "жанр": "проза", "описание": "река"}


def test_cover_choice(spark):
    def best(*tags):
        p = pages(spark, "".join(tags))
        row = images.rank_images(images.image_candidates(nodes.page_nodes(p), p)).first()
        return row and row.cover_url
    assert best('<img src="/i.png" width="16" height="16">', '<img src="/wide.jpg" width="1200" height="180">',
                '<img src="/ok.jpg" width="500" height="780">') == "https://cards.example.org/ok.jpg"
    assert best('<img src="/smiles/a.gif">', '<img src="/banner.jpg">', '<img src="/t.jpg" width="48" height="72">') is None
    assert best('<img src="/a.jpg">', '<var class="postImg" title="https://v.example/p.jpg"></var>') == "https://v.example/p.jpg"


SERIES_ITEM = "page_id bigint, external_id string, external_url string, series_name string, series_position int, title string"


def entries(spark, html, position=None, title="Исток"):
    p = pages(spark, f'<div class="post_body">{html}</div>')
    items = spark.createDataFrame([(0, "77", "u", "Река", position, title)], SERIES_ITEM)
    return sorted((r.position, r.title, r.matched_by) for r in series.series_entries(nodes.page_nodes(p, keep=True), items).collect())


def test_series_list_after_heading(spark):
    got = entries(spark, 'Текст<br>Книги цикла «Река»:<br>1. Исток<br>2. <a href="viewtopic.php?t=5">Русло</a><br>3. Устье<br>Главы<br>1. Нет<br>')
    assert got == [(1, "Исток", "self"), (2, "Русло", "link"), (3, "Устье", "hint")]


def test_ordinary_field_and_timings_do_not_open_a_list(spark):
    assert entries(spark, '<span class="post-b">Цикл/серия</span>: Река<br>1. Глава<br>2. Глава вторая<br>') == []
    assert entries(spark, 'Цикл «Река»<br>1. Начало [01:02]<br>2. Конец [02:03]<br>') == []


def test_spoiler_skips_notes_and_ordered_list_counts(spark):
    spoiler = '<div class="sp-wrap"><div class="sp-head">Цикл Река</div><div class="sp-body">1. Исток<br>заметка<br>2. Русло<br></div></div>'
    assert [e[:2] for e in entries(spark, spoiler)] == [(1, "Исток"), (2, "Русло")]
    ol = '<span class="post-b">Цикл «Река»</span><ol start="4"><li>Мост</li><li value="9">Порт<ul><li>часть</li></ul></li></ol>'
    assert [(p, m) for p, _, m in entries(spark, ol)] == [(4, "hint"), (9, "hint")]


def test_contents_lists_are_dropped(spark):
    rows = "".join(f"{i}. Часть {i}<br>" for i in range(1, 61))
    assert entries(spark, f"Книги цикла «Река»<br>{rows}") == []
    credited = "".join(f"{i}. Стих {i} (Анна Лугова)<br>" for i in range(1, 8))
    assert entries(spark, f"Книги цикла «Река»<br>{credited}") == []
    assert len(entries(spark, "Книги цикла «Река»<br>1. Раз<br>2. Два<br>3. Три<br>")) == 3


def test_embedded_parts(spark):
    html = '<script>[{"fileId":1,"title":"A","src":"https:\\/\\/m.example\\/1.mp3","duration":61},{"fileId":2,"src":"//m.example/2.mp3"}]</script>'
    got = parts.extract_embedded_parts(pages(spark, html)).orderBy("position").collect()
    assert [(r.part_id, r.position, r.title, r.duration_seconds, r.media_url) for r in got] == [
        ("1", 0, "A", 61, "https://m.example/1.mp3"), ("2", 1, "Часть 2", 0, "https://m.example/2.mp3")]


def test_bad_playlists_are_previews(spark):
    df = spark.createDataFrame([(1, "[]"), (2, "not json"), (3, '[{"id":5,"file":"https://m.example/a.mp3, or x"}]'), (4, None)], "item int, body string")
    status = {r.item: r.preview_only for r in parts.playlist_status(df, "item", "body").collect()}
    assert status == {1: True, 2: True, 3: False, 4: True}


def test_cp1251_and_broken_bytes(spark):
    df = spark.createDataFrame([(1, "Река".encode("cp1251"), None), (2, "Река".encode(), "utf-8"), (3, b"a\x98\xff", None)],
                               "k int, b binary, c string")
    got = {r.k: (r.text, r.decoded_as) for r in decode_pages(df, "b", "c").collect()}
    assert got[1] == ("Река", "cp1251") and got[2] == ("Река", "declared") and got[3][1] == "utf-8-replace"


def test_last_page_reads_offsets_and_texts(spark):
    df = spark.createDataFrame([("a", "?f=1&start=4950", "100"), ("b", "/p7/", ""), ("c", "/x", "страница 2 из 31"), ("d", "/x", "")],
                               "k string, href string, text string")
    assert {r.k: r.last_page for r in links.last_page_per_listing(df, ["k"]).collect()} == {"a": 100, "b": 7, "c": 31, "d": 1}


def test_availability_order(spark):
    items = spark.createDataFrame([(1, "контент удалён по требованию правообладателя"), (2, "купить"), (3, ""), (4, "")], "k int, text string")
    rows = [(1, "A", 5, "https://trial.example.net/audiotrial/1"), (2, "Фрагмент", 0, "https://m.example/1"),
            (3, "A", 0, "https://x.trial.example.net/audiotrial/2"), (3, "B", 0, "https://m.example/2")]
    table = spark.createDataFrame(rows, "k int, title string, duration_seconds int, media_url string")
    got = catalog.classify_availability(items, table, "k", ["trial.example.net"])
    assert {r.k: r.condition for r in got.collect()} == {1: "removed", 2: "preview_only", 3: "available", 4: "no_parts"}


def test_manifest_keeps_source_index(spark):
    df = spark.createDataFrame([("i", [("a.mp3", "5"), (" ", "9"), ("d\\b.txt", "-3")])], "item string, files array<struct<path:string,length:string>>")
    rows, manifest = files.build_file_manifest(df, "item", "files")
    assert sorted((r.file_index, r.path, r.size_bytes, r.media_type) for r in rows.collect()) == [
        (0, "a.mp3", 5, "audio"), (2, "d/b.txt", 0, "other")]
    assert manifest.first().total_size_bytes == 5


def test_scopes_of_the_tokenizer_equal_owner_windows(spark):
    """Owners from the tokenizer and from windows are the same on tangled markup; ``within`` and ``attrs`` only leave things out."""
    rng = random.Random(3)
    tags = ["div", "ol", "ul", "li", "span", "a", "br", "p"]
    classes = ["", "post_body", "sp-wrap", "sp-head", "sp-body", "post-b"]

    def piece():
        tag = rng.choice(tags)
        return rng.choice([f'<{tag} class="{rng.choice(classes)} x" href="h">', f"<{tag}>", f"</{tag}>", f"</{tag}>", "text ", "<br/>"])
    spoiler = '<div class="post_body"><div class="sp-wrap"><div class="sp-head">a</div><div class="sp-body">'
    html = [(i, spoiler * (i % 2) + "".join(piece() for _ in range(rng.randint(5, 120)))) for i in range(60)] + [(100, ""), (101, None)]
    df = spark.createDataFrame(html, "page_id long, html string")
    scopes = [*series.SERIES_SCOPES, listing.LINK]
    names = [s.name for s in scopes]
    plain = nodes.with_scopes(nodes.page_nodes(df), scopes).select("page_id", "seq", *names)
    scoped = nodes.page_nodes(df, scopes=scopes)
    want = sorted(plain.collect(), key=lambda r: (r.page_id, r.seq))
    assert sorted(scoped.select("page_id", "seq", *names).collect(), key=lambda r: (r.page_id, r.seq)) == want
    assert any(r._li for r in want) and any(r._body_list for r in want)
    pruned = nodes.page_nodes(df, scopes=scopes, within="_post", attrs=["class"]).collect()
    assert sorted((r.page_id, r.seq) for r in pruned) == [(r.page_id, r.seq) for r in want if r._post]
    assert all(set(r.attrs or {}) <= {"class"} for r in pruned)


def test_tokenizer_passes_nodes_on_in_small_batches():
    html = "<html><body>" + "<p class='x'>word</p>" * 30 + "</body></html>"
    pages = pa.RecordBatch.from_arrays([pa.array(range(1_000), pa.int64()), pa.array([html] * 1_000)], names=["page_id", "html"])
    sizes = [b.num_rows for b in nodes._flatten([pages], (), "", None)]
    assert sum(sizes) == 62_000 and max(sizes) <= 10_000


def test_entry_titles_are_cleaned_once_a_row(spark, monkeypatch):
    """A cleaned title is not computed again for every mention in later filters and joins."""
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df
    monkeypatch.setattr(series, "durable", watched)
    page = spark.createDataFrame([(1, "<div class='post_body'></div>")], "page_id long, html string")
    item = spark.createDataFrame([(1, "1", "u", "Saga", 1, "T")], "page_id long, external_id string, external_url string, "
                                 "series_name string, series_position int, title string")
    series.series_entries(series.series_nodes(page, keep=False), item)
    assert plans[-1].count(fixed.ENTRY_CUTS[4]) == 1
