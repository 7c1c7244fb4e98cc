"""Pages read without the parser, listing rows without windows, runs that compute their pages once."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from catalogloom.functions import scale, text
from catalogloom.operators import listing, nodes
from catalogloom.operators.series import SERIES_SCOPES
from catalogloom.plans import derived, source_runs, specs
from catalogloom.plans.registry import QUERIES

PIECES = ["<p>", "</p>", '<b class="x y">', "<a href='/1/'>", "</a>", "text ", "&amp;", "&", "&lt;b", "<br>", "<br/>", "<script>",
          "</script>", "<script>a</p>b</script>", "<style>", "a<b", "<", ">", "<!-- ad 3 -->", "<!--x<b>--->", "<!DOCTYPE html>",
          "<title>", "</title>", "<title>q</title>", '<div class="post_body">', "</div>", "<ul>", "<li>", "</li>", "</ul>",
          '<IMG SRC="/a?b=1&amp;c">', "</A>", "&nbsp", "é\n", "<SCRIPT>", "<a href=x>", "<a b>", "<x-y>", "</p >", "<wbr>", '<p a="">']


def _dump(page):
    return (page.tags, page.attrs, page.texts, page.ends, page.depths, page.parents, page.owners, page.children)


def test_plain_markup_reads_like_the_parser():
    rng, plain = random.Random(5), 0
    for _ in range(5_000):
        html = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 8)))
        quick, slow = nodes._Flattener(SERIES_SCOPES), nodes._Flattener(SERIES_SCOPES)
        if nodes._read_plain(quick, html):
            plain += 1
            slow.feed(html)
            assert _dump(quick) == _dump(slow.finish()), html
    assert plain > 1_000


def test_search_rows_need_no_window(spark):
    row = ('<tr><td>1</td><td>2</td><td>3</td><td><a class="tLink" href="v?t={0}">T {0} <b class="tor-size">no</b></a></td><td>5</td>'
           '<td class="tor-size" data-ts_text="9{0}"><a class="tr-dl" href="d">4 KB</a></td><td>{0}</td><td>8<i>x</i></td></tr>')
    html = "<td class='tLink'>out</td><table>" + row.format(1) + row.format(2) + "<tr><td>t</td></tr></table>"
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    quick = listing.search_rows(listing.search_nodes(pages))
    assert sorted(quick.collect()) == sorted(listing.search_rows(nodes.page_nodes(pages)).select(*quick.columns).collect())
    assert quick.count() == 2
    assert "Window" not in quick._jdf.queryExecution().optimizedPlan().toString()


def test_links_of_known_scopes_need_no_window(spark):
    pages = spark.createDataFrame([(1, "https://a.example/", '<a href="/1/">x <a href="/2/">y</a></a><a>z</a>')], "page_id bigint, url string, html string")
    quick = nodes.extract_links(nodes.page_nodes(pages, scopes=[nodes.LINK], within="_link", attrs=["href"]), pages)
    assert sorted(quick.collect()) == sorted(nodes.extract_links(nodes.page_nodes(pages), pages).collect())
    assert "Window" not in quick._jdf.queryExecution().optimizedPlan().toString()


def test_rows_told_by_the_start_of_an_attribute(spark):
    row = nodes.Scope("row", ("tr",), attr="id", prefix="tr-")
    cells = {"title": nodes.Scope("title", ("a",), attr="href", value="v?t=")}
    pages = spark.createDataFrame([(1, '<table><tr id="tr-1"><td><a href="v?t=1">A</a></td></tr><tr id="xtr-2"><td><a href="v?t=2">B</a></td></tr></table>')],
                                  "page_id bigint, html string")
    quick = listing.extract_table_rows(nodes.page_nodes(pages, scopes=listing.row_scopes(row, cells), within="_cell"), row, cells)
    slow = listing.extract_table_rows(nodes.page_nodes(pages), (F.col("tag") == "tr") & nodes.attr("id").startswith("tr-"),
                                      {"title": listing.has_href("v?t=")})
    assert quick.collect() == slow.collect() and [r.title for r in quick.collect()] == ["A"]


def test_titles_and_texts_of_pages(spark):
    pages = spark.createDataFrame(list(enumerate([
        "<title>A <b>b</b> | Shelf</title><h1> </h1><p>one", "<h1>H <i>i</i>  j</h1>two<title>T</title>", "<p><br>", "<title></title>", "x<h1><h1>n</h1></h1>y", ""])),
        "page_id bigint, html string")
    got = {r.page_id: (r.title, r.text) for r in source_runs._titles_and_texts(nodes.page_nodes(pages), specs.CARDS).collect()}
    tree = nodes.page_nodes(pages)
    texts = {r.page_id: r.text for r in nodes.page_text(tree).collect()}
    assert {k: v[1] for k, v in got.items() if v[1] is not None} == texts
    assert got[1][0] == "H i j" and got[3] == (None, None) and got[4][0] == "n" and 2 not in got


def test_a_run_computes_its_pages_once(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    made = source_runs.run_cards(derived.detail_pages(part))
    for frame in made.values():
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" not in plan and "regexp_extract_all" not in plan


def test_stream_batches_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(source_runs, "BATCH_BYTES", 1)
    monkeypatch.setattr(source_runs, "PAGES_A_FILE", 100)
    seen = []
    publish = source_runs.publish_batches
    monkeypatch.setattr(source_runs, "publish_batches", lambda df, path, checkpoint, build: publish(
        df, path, checkpoint, lambda batch: seen.append(batch.count()) or build(batch)))
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    found = QUERIES["str1_streamed_records"](spark, "/root/testdata/sf0.001")
    assert found.count() == part.count() == sum(seen) and len(seen) > 1 and max(seen) <= 100


def test_only_text_that_nfkc_may_change_goes_to_python(spark):
    stable = re.compile(f"[{text.NFKC_STABLE}]")
    kept = [c for c in map(chr, range(0x10000)) if stable.match(c)]
    assert all(unicodedata.normalize("NFKC", a + b) == a + b for a in kept for b in kept)
    rows = ["﻿ plain ​ é ё", "ﬁ ½ x", "é ‍", "e​́", None, "Å й"]
    found = spark.createDataFrame(list(enumerate(rows)), "i int, t string").select(
        "i", text.clean_unicode(F.col("t")).alias("c"), F.col("t").rlike(f"[^{text.NFKC_STABLE}]").alias("asks"))
    drop = lambda t: "".join(c for c in unicodedata.normalize("NFKC", t) if unicodedata.category(c) != "Cf")
    got = {r.i: (r.c, r.asks) for r in found.collect()}
    assert got == {i: ("" if t is None else " ".join(drop(t).split()), None if t is None else i not in (0,)) for i, t in enumerate(rows)}


def test_running_totals_sort_their_rows_once(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = scale.running_totals(rows, ["k"], [F.col("id")], {"n": F.lit(1)}, chunk=F.floor(F.col("id") / 10))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and len(re.findall(r"Sort \[_cell#\d+ ASC", plan)) == 2  # rows, sums of chunks
        assert {r.id: r.n for r in found.collect()} == {i: i // 3 + 1 for i in range(100)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
