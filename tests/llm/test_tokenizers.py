"""Pieces and alignments against the libraries' own whole-text results."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from catalogloom.llm import alignment, pieces, queries

P = pytest.importorskip("public_tokenizers")
MODEL, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")

ODD = ["", None, " ", "  ", "a", "a ", " a", "  two  spaces  ", "tab\there \n\n line ", "▁literal▁ mark", "x▁", "don't they'll I'm",
       "\x00\x1c \x1d a\x1fb", "ｆｕｌｌ① ½", "日本語 の テキスト", "👩‍👩‍👧 fam 🎉🎉", "<s> </s> <0x0A> <unk> <|endoftext|>", " nbsp  x y",
       "a" * 5000, "word " * 3000, "é é ​ zero", "1234567 8,9.10", "﻿bom", "end with newline\n", "a \n b", "😀", "a  b   c    d"]


def _brute_align(texts):
    """Counts and groups by walking the bytes of whole tokenisations."""
    from tokenizers import Tokenizer
    a_tok = Tokenizer.from_file(BYTES)
    a_tok.encode_special_tokens = True
    sp = pieces.processor(MODEL)
    raw_a, raw_b = alignment.byte_level(BYTES).raw, alignment.sentence_pieces(MODEL).raw
    found, count = [], Counter()
    for t in texts:
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        if not t or b"".join(raw_a[i] for i in a) != (" " + t).encode() or b"".join(raw_b[i] for i in b) != (" " + t).encode():
            found.append(([], [], [], []))
            continue
        owner_a = [k for k, i in enumerate(a) for _ in raw_a[i]]
        owner_b = [k for k, i in enumerate(b) for _ in raw_b[i]]
        links = sorted(set(zip(owner_a, owner_b)))
        ends = lambda o: {p for p in range(len(o)) if p + 1 == len(o) or o[p + 1] != o[p]}
        groups, x, y = [], 0, 0
        for p in sorted(ends(owner_a) & ends(owner_b)):
            groups.append((a[x:owner_a[p] + 1], b[y:owner_b[p] + 1]))
            x, y = owner_a[p] + 1, owner_b[p] + 1
        pairs = [(a[i], b[j]) for i, j in links]
        count.update(pairs)
        found.append((a, b, groups, pairs))
    most = {}
    for (_, b), c in count.items():
        most[b] = max(most.get(b, 0), c)
    return [(len(a), len(b), len(g), len(p), sum(count[x] == most[x[1]] for x in p), sum(count[x] for x in p),
             ";".join(",".join(map(str, q)) + "|" + ",".join(map(str, r)) for q, r in g)) for a, b, g, p in found]


def _digest(groups):
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def test_marked_words_give_the_library_ids():
    sp = pieces.processor(MODEL)
    assert pieces.separable(sp)
    for t in ODD:
        words = pieces.marked_words(t or "")
        assert [i for x in pieces.segment(sp, words) for i in x] == sp.encode(t or ""), t


def test_pieces_of_odd_texts(spark, frame):
    sp = pieces.processor(MODEL)
    docs = frame([(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id")])
    made = pieces.decode(pieces.encode(docs, MODEL), MODEL)
    assert set(docs.columns) <= set(made.columns)
    rows = made.collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        ids = [1, *sp.encode(r.text or ""), 2]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == sp.decode(ids)
    assert pieces.encode(docs.limit(0), MODEL).count() == 0
    bare = pieces.encode(frame([(1, ""), (2, None)], extra=False), MODEL, begin=False, end=False)
    assert [r.n_tokens for r in bare.collect()] == [0, 0]


def test_pieces_query_equals_the_library(spark, sf):
    sp = pieces.processor(MODEL)
    got = {r.doc_id: r for r in queries.op13_pieces(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = [1, *sp.encode(r.text or ""), 2]
        mine = got[r.doc_id]
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert mine.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_small_tables_and_blocks_give_the_same_pieces(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    whole = {(r.doc_id, bytes(r.ids)) for r in pieces.encode(docs, MODEL).collect()}
    sp = pieces.processor(MODEL)
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    table = pieces.word_table(sp)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert {(i, np.array([1], "<u4").tobytes() + table.ids([t])[0] + np.array([2], "<u4").tobytes()) for i, t in rows} == whole


def test_ranks_and_whole_tokenizer_agree_on_parts():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    side, other = alignment.byte_level(BYTES), alignment.sentence_pieces(MODEL)
    sp = pieces.processor(MODEL)
    for t in ODD:
        if t:
            parts = alignment.parts_of(t)
            assert side.ids(parts)[0].tolist() == tokenizer.encode(" " + t, add_special_tokens=False).ids, t
            assert other.ids(parts)[0].tolist() == sp.encode(t), t
    every = sorted({p for t in ODD for p in alignment.parts_of(t)}, key=hash)
    for one in (side, other):
        ids, count = one.ids(every)
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [list(one.encode(p)) for p in every]


def test_small_blocks_give_the_same_alignment(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    whole = Counter(alignment.aligned(docs, BYTES, MODEL, carry=["doc_id"]).collect())
    monkeypatch.setattr(alignment, "BLOCK_PARTS", 500)
    assert Counter(alignment.aligned(docs.repartition(3), BYTES, MODEL, carry=["doc_id"]).collect()) == whole


def test_other_models_are_encoded_whole(monkeypatch, spark, frame):
    sp = pieces.processor(MODEL)
    monkeypatch.setattr(pieces, "separable", lambda sp: False)
    rows = pieces.encode(frame([(i, t) for i, t in enumerate(ODD)], extra=False), MODEL).collect()
    assert all(np.frombuffer(r.ids, "<u4").tolist() == [1, *sp.encode(r.text or ""), 2] for r in rows)


def test_alignment_of_odd_texts(spark, frame):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(5, ODD[5]), (None, "no id no id")]
    docs = frame(rows)
    got = alignment.aligned(docs, BYTES, MODEL).collect()
    assert len(got) == len(rows) and set(docs.columns) <= set(got[0].asDict())
    want = Counter((i, *w) for (i, _), w in zip(rows, _brute_align([t for _, t in rows])))
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got) == want
    assert alignment.aligned(docs.limit(0), BYTES, MODEL).count() == 0


def test_alignment_query_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(rows, _brute_align([r.text for r in rows]))}
    got = queries.op11_alignment(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (*w[:6], _digest(w[6]))
