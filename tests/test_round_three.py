"""Whole jobs of single queries on small tables made for them."""

import datetime

import pyspark.sql.functions as F

import __spark_entry__ as entry
from catalogloom.operators import catalog, nodes


def test_streamed_links_read_a_table_of_several_files(spark, tmp_path):
    rows = [(i, "https://a.example.org/", f'<a href="/x{i}">text {i}</a><a href="/y">other</a>') for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = entry.queries()["str1_streamed_links"](spark, str(tmp_path)).collect()
    want = nodes.extract_links_from_text(pages).select("page_id", "pos", "href", "url").collect()
    assert len(got) == 40 and sorted(got) == sorted(want)


def test_feed_records_list_all_orders_of_their_customer(spark, tmp_path):
    day = datetime.date(1998, 1, 1)
    orders = [(4, 1, "O", "1-URGENT", day), (5, 1, "O", "2-HIGH", day), (12, 1, "O", "2-HIGH", day), (8, 2, "O", "3-MEDIUM", day)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, o_orderdate date") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(4, 2, 70, 9, 5.0), (4, 1, 80, 9, 6.0), (8, 1, 90, 7, 1.0)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint, l_quantity double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.external_id: r for r in entry.queries()["rec1_feed_records"](spark, str(tmp_path)).collect()}
    assert {k: r.entries for k, r in got.items()} == {"4": "4,5,12", "5": "", "12": "4,5,12", "8": "8"}
    assert (got["4"].parts, got["4"].manifest_files, got["4"].manifest_bytes, got["5"].parts) == ("80,70", 2, 11, "")


def test_nested_children_are_shuffled_once(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 1000).alias("n"))
    nested = catalog.assemble_nested(rows, ["k"], [F.col("n")], F.col("n"), ["n"], "all")
    plan = nested._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert all([c.n for c in r["all"]] == sorted(i * 37 % 1000 for i in range(1000) if i % 7 == r.k) for r in nested.collect())


def test_title_rules_write_little_more_than_their_texts(spark):
    import os
    import random

    from catalogloom.operators import titles
    from catalogloom.session import shared_root
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(250)) for _ in range(600)]
    names = [" ".join(t.split()[3:6]) for t in texts[:20]] + [t[2:6] for t in texts[20:40]]
    subjects = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bodies = spark.createDataFrame(list(enumerate(names)), "no long, title string")
    root = shared_root(spark)
    stored = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(root) for f in files)
    before = stored()
    got = titles.match_titles_by_rules(bodies, subjects, "no", "doc_id", "title", "text").where("rule = 'contained'").collect()
    assert {(r.no, r.doc_id) for r in got} == {(n, d) for n, b in enumerate(names) for d, t in enumerate(texts) if b.strip() in t}
    assert stored() - before < 2.5 * sum(map(len, texts))


def test_title_rules_agree_on_light_and_heavy_sides(spark, monkeypatch):
    import random

    from catalogloom.operators import titles
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 14))) for _ in range(80)]
    names = [t[rng.randrange(4):][:rng.randrange(3, 20)] for t in texts[:40]] + [rng.choice("abc-!") for _ in range(4)] + texts[50:60]
    bodies = spark.createDataFrame(list(enumerate(names)), "no long, title string")
    subjects = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    run = lambda: sorted(titles.match_titles_by_rules(bodies, subjects, "no", "doc_id", "title", "text").collect())
    light = run()
    monkeypatch.setattr(titles, "LIGHT_BYTES", -1)
    monkeypatch.setattr(titles, "LIGHT_ROWS", -1)
    assert run() == light
    inside = {(n, d) for n, b in enumerate(names) for d, t in enumerate(texts) if b.strip() and t and (b.strip() in t or t in b.strip())}
    assert {(r.no, r.doc_id) for r in light if r.rule in ("equal key", "contained")} >= inside
