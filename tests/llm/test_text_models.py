"""Language, quality, token counts and packing."""

import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalogloom.llm import language, packing, quality, tokens

ODD = [(0, None), (1, ""), (2, " \n\t"), (3, "12 34 .."), (4, "é"), (5, "the and of " * 20_000), (6, "the and"),
       (6, "the and"), (None, "the and")]


def test_held_out_languages_are_told(spark, sf):
    rows = entry.queries()["op5_language"](spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark, frame):
    labelled = frame([(i, "the cat and the dog of that house") for i in range(8)], extra=False).union(
        frame([(i, "der hund und die katze aus dem haus") for i in range(8)], extra=False).withColumn("lang", F.lit("de")))
    model = language.train(labelled)
    got = {(r.doc_id, r.text): r for r in language.predict(frame(ODD), model).collect()}
    assert {k[0] for k, r in got.items() if r.lang_pred == "und"} == {0, 1, 2, 3}
    assert got[6, "the and"].lang_pred == "en" and got[0, None].score == 0
    assert language.predict(frame([(1, "und die")]), model).first().lang_pred == "de"
    assert language.predict(frame([]), model).collect() == []


def test_without_labels_every_text_is_unknown(spark, frame):
    model = language.train(frame([(1, "x")]).withColumn("lang", F.lit(None).cast("string")))
    assert language.predict(frame(ODD), model).where("lang_pred != 'und'").count() == 0


def test_codewords_differ(spark):
    for n in (2, 3, 4, 5, 9, 40):
        code = language.codewords(n)
        distances = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert len(code) == n and min(distances) >= (1 if n == 2 else 2)


def test_quality_follows_the_labels(spark):
    sf = "/root/testdata/sf0.01"  # the smallest tables label eleven bad documents only
    rows = {r.doc_id: r for r in entry.queries()["op2_quality"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    found = Counter((r.quality, rows[r.doc_id].kept) for r in labels)
    assert found[1, True] >= 0.97 * (found[1, True] + found[1, False])
    assert found[0, False] >= 0.8 * (found[0, True] + found[0, False])


def test_quality_of_odd_rows(spark, frame):
    model = quality.train(frame(ODD))
    got = quality.score(frame(ODD), model).collect()
    assert len(got) == len(ODD)
    assert all(r.score == 0 and not r.kept and r.weak_label is None for r in got if not (r.text or "").split())
    assert quality.score(frame([]), quality.train(frame([]))).collect() == []


def greedy(word, pieces, longest):
    n = at = 0
    while at < len(word):
        at += next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at:at + k] in pieces)
        n += 1
    return n


@given(st.lists(st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 for x in b)), max_size=12),
       st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)))
@settings(max_examples=300, deadline=None)
def test_automaton_counts_greedy_pieces(pieces, word):
    known = set(pieces) | {bytes([i]) for i in range(256)}
    assert tokens.LongestMatch(pieces).count(word) == greedy(word, known, 5)


def test_token_counts_of_documents(spark, frame, vocabulary):
    pieces = set(tokens.read_vocabulary(vocabulary)) | {bytes([i]) for i in range(256)}
    longest = max(map(len, pieces))
    rows = ODD[:5] + ODD[6:] + [(9, "Straße naïve 日本語 don't <|endoftext|> a,b;c"), (10, "x" * 5000)]
    for r in tokens.token_counts(frame(rows), vocabulary).collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode())
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(b" " + w, pieces, longest) for w in words))
    assert tokens.token_counts(frame([]), vocabulary).collect() == []


def test_packing_is_a_round_trip(spark, frame, tokenizer):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer)
    rows = ODD[:5] + ODD[6:7] + [(9, "Straße İ don't <|endoftext|> É×é÷ á 12a3's"), (10, "tok " * 9000),
                                 (11, None)] + [(20 + i, f"word{i} and more " * (i * 7)) for i in range(40)]
    pieces = packing.pack(frame(rows), tokenizer, with_ids=True).collect()
    texts = dict(rows)
    for doc_id, text in texts.items():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted((p for p in pieces if p.doc_id == doc_id), key=lambda p: p.start)
        assert [x for p in own for x in p.ids] == ids
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
        for p in own:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    for sequence in {p.sequence_id for p in pieces}:
        own = sorted((p for p in pieces if p.sequence_id == sequence), key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
        total = sum(p.length for p in own)
        assert total <= 2048 and total & (total - 1) == 0
    assert packing.pack(frame([]), tokenizer).collect() == []


@given(st.lists(st.integers(1, 700), min_size=1, max_size=60), st.sampled_from([64, 128, 256]))
@settings(max_examples=200, deadline=None)
def test_arranged_sequences_hold_every_token_once(counts, capacity):
    counts = np.array(counts)
    covered = [[] for _ in counts]
    for sequence in packing.arrange(counts, capacity):
        total = sum(p[2] for p in sequence)
        assert total <= capacity and total & (total - 1) == 0
        for item, start, length in sequence:
            covered[item].append((start, start + length))
    for n, parts in zip(counts, covered):
        parts.sort()
        assert [p[0] for p in parts] + [n] == [0] + [p[1] for p in parts]


@given(st.lists(st.integers(1, 100), min_size=1, max_size=40), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_differencing_keeps_all_items_and_balances(sizes, windows):
    groups = packing.differencing(np.array(sizes), windows)
    assert sorted(i for g in groups for i in g.tolist()) == list(range(len(sizes)))
    assert len(groups) <= windows
    loads = [sum(sizes[i] for i in g) for g in groups] + [0] * (windows - len(groups))
    assert max(loads) - min(loads) <= max(sizes)
