"""The pipeline, stage by stage, against plain versions."""

import re

from test_dedup import brute_components
from test_native import brute_hits

import corpus_pipeline
from catalogloom.llm import secrets


def test_stages_are_named_and_ordered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near duplicates", "decontamination", "secrets", "packing"]


def test_every_stage_equals_its_plain_version(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for no, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        made = stage(spark, docs, sf)
        assert made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/{no}")
        docs = spark.read.parquet(f"{tmp_path}/{no}")
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(after)
        if name == "language":
            assert len(after) >= 0.98 * len(before)
        elif name == "near duplicates":
            whole = brute_components(before, 5)
            assert set(after) == {i for i, (_, c) in whole.items() if i == c}
        elif name == "decontamination":
            assert set(after) == {i for i, t in before if brute_hits(t, items)[1] == 0}
        else:
            assert set(after) == {i for i, _ in before}
            for i, t in before:
                assert after[i].n_chars == len(after[i].text)
                assert not re.search(r"[0-9a-f]{24,}", after[i].text)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {p.doc_id for p in pieces} == set(after)


def test_run_equals_its_stages(spark, sf):
    whole = corpus_pipeline.run(spark, sf).select("doc_id", "doc_tokens").distinct().collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert sorted(whole) == sorted(docs.select("doc_id", "doc_tokens").distinct().collect())


def test_stages_take_odd_and_empty_tables(spark, sf, frame):
    odd = [(1, None), (2, ""), (3, "42"), (4, "the and of"), (4, "the and of"), (None, "the and of"), (5, "the " * 20_000)]
    for rows in (odd, []):
        docs = frame(rows, extra=False)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
        docs.collect()


def test_the_mark_is_what_redaction_writes():
    assert "[REDACTED]" in secrets.redacted.__defaults__
