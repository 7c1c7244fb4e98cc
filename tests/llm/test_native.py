"""Secrets, fingerprints, sharding and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalogloom.llm import decontaminate, secrets, sharding, simhash

KEY = "AKIA" + "ABCDEFGH12345678"
ASSIGN = re.compile("(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in (
    "password", "passwd", "secret", "token", "api_?key")).replace("[_]", "_") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def random_secret_text(rng):
    atoms = ["password", "Token", "SECRET", "api_key", "apikey", "passwd", " ", " ", "=", ":", '"', "'", "abcdef", "a1b2c",
             "AKIA", "ABCD1234EFGH5678", "AKIAX", "0123456789abcdef", "deadbeef", "é", "日", "\n", ".", "-", "x"]
    return "".join(rng.choice(atoms) for _ in range(rng.randint(0, 60)))


def test_base_spans_equal_the_patterns(spark, frame):
    rng = random.Random(2)
    rows = [(i, random_secret_text(rng)) for i in range(300)] + [
        (400, None), (401, ""), (402, "token=abcdef " * 3000), (403, "secret=token: abcdefgh"), (0, "token: abcdef"),
        (None, "token: abcdef"), (None, None), (0, "token: abcdef")]
    got = secrets.scan(frame(rows), carry=["doc_id", "text", "n_words"]).collect()
    assert len(got) == len(rows)
    for r in got:
        found = [(s.begin, s.order, s.end, s.kind) for s in r.spans if s.strong]
        assert found == base_spans(r.text or ""), r
        assert r.n_words == "clash"


def test_weak_parts_need_their_complement(spark, frame):
    material = "Ab3" + "x9Yz" * 9 + "Q"
    far = " word" * 100
    cases = [(0, f"login = bob {material}", {"account", "material"}), (1, f"login = bob{far} {material}", set()),
             (2, f"{KEY} then {material}", {"access", "material"}), (3, "see https://host/path", set()),
             (4, "https://host/path token=abcdef", {"assign", "endpoint"}), (5, f"login = bob {far}", set()),
             (6, "login = bob " * 2000 + "token=abcdef", None)]
    got = {r.doc_id: r.spans for r in secrets.scan(frame([(i, t) for i, t, _ in cases])).collect()}
    for i, _, kinds in cases:
        if kinds is not None:
            assert {s.kind for s in got[i]} == kinds, i
    near = [s for s in got[6] if s.kind == "account"]
    assert near and all(cases[6][1].index("token") - s.end <= secrets.SCOPE for s in near) and len(near) < 20


def test_redaction_replaces_spans_alone(spark, frame):
    rows = [(0, 'é token = "' + "a1" * 20 + '" rest'), (1, "clean text"), (2, None), (3, "token=abcdef"),
            (4, "a token=abcdef b secret: ghijkl c")]
    found = secrets.scan(frame(rows), carry=["doc_id", "text"])
    got = dict(found.select("doc_id", secrets.redacted(F.col("text"), F.col("spans"))).collect())
    assert got == {0: 'é [REDACTED]" rest', 1: "clean text", 2: None, 3: "[REDACTED]", 4: "a [REDACTED] b [REDACTED] c"}


def test_secrets_of_an_empty_table(spark, frame):
    assert secrets.scan(frame([])).collect() == []


def test_edited_texts_and_likeness(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = {r.doc_id: r for r in entry.queries()["op3_fingerprints"](spark, sf).collect()}
    for (doc_id, text), following in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following.text[:half]
        r = rows[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        distance = bin(int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).count("1")
        assert r.near_edited == 1 - distance / 128
        assert r.near_next == 1 - bin(int(r.fingerprint, 16) ^ int(rows[following.doc_id].fingerprint, 16)).count("1") / 128
        if doc_id % 50 == 0:
            assert r.near_documents == sum(
                bin(int(r.fingerprint, 16) ^ int(x.fingerprint, 16)).count("1") <= 3 for x in rows.values())
    assert sum(r.near_edited > r.near_next for r in rows.values()) >= 0.9 * len(rows)


def test_a_bit_follows_most_of_the_weight(spark):
    text = " ".join(f"w{i % 70}" for i in range(700)) + " a b c d e f"
    df = spark.createDataFrame([(1, text), (2, "x y"), (3, ""), (4, None)], "no int, text string")
    found = {r.no: r.bits for r in simhash.fingerprints(df, ["no"]).collect()}
    hashed = df.where("no < 3").select("no", F.explode(simhash.terms(F.col("text"))).alias("t")).select(
        "no", F.xxhash64(*[f"t.w{k}" for k in range(5)]).alias("a")).withColumn("b", F.xxhash64("a", F.lit(1))).collect()
    assert sum(r.no == 1 for r in hashed) == 702 and sum(r.no == 2 for r in hashed) == 1
    for no in (1, 2):
        own = [r for r in hashed if r.no == no]
        for half in "ab":
            for place in range(64):
                votes = sum(r[half] >> place & 1 for r in own)
                assert (found[no][half] >> place & 1) == (votes * 2 > len(own))
    assert set(found) == {1, 2}


def test_fingerprints_of_odd_rows(spark, frame):
    rows = [(3, None), (1, ""), (2, "one two"), (2, "one two"), (None, "x"), (9, "w " * 30_000), (4, "one two")]
    got = simhash.edited_fingerprints(frame(rows)).collect()
    assert len(got) == len(rows)
    assert len({r.own for r in got if r.n_chars == 7}) == 1
    assert all(r.own == (0, 0) for r in got if r.n_chars == 0)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = Counter()
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, half = t or "", len(t or "") // 2
        expected[i, hashlib.sha256((t[:len(t) - half] + (after or "")[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == expected
    assert simhash.edited_fingerprints(frame([])).collect() == []


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(4)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(128)
        for flips in (0, 0, 1, 2, 3, 3, 4, 5):
            value = base
            for place in rng.sample(range(128), flips):
                value ^= 1 << place
            prints.append(value)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, (signed(p >> 64), signed(p & (2**64 - 1)))) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "no long, bits struct<a:long,b:long>")
    got = {tuple(r.bits): r.near for r in simhash.near_counts(df, F.col("no") % 3 == 0).collect()}
    for i, bits in rows:
        if i % 3 == 0:
            assert got[bits] == sum(bin(prints[i] ^ p).count("1") <= 3 for p in prints)


def test_shards_are_exact_and_cover_all(spark, frame):
    rows = [(i % 90 if i % 7 else None, f"text {i}" if i % 11 else None) for i in range(203)] + [(1, "same")] * 30
    got = sharding.shuffle(frame(rows), 8, ["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    size = Counter(r.shard for r in got)
    assert sorted(size) == list(range(8)) and max(size.values()) - min(size.values()) <= 1
    for s in size:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(size[s]))
    again = sharding.shuffle(frame(rows), 8, ["doc_id", "text"]).collect()
    key = lambda r: (r.doc_id or -1, r.text or "", r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert sharding.shuffle(frame([]), 8, ["doc_id"]).collect() == []
    assert {r.shard for r in sharding.shuffle(frame([(1, "a"), (2, "b")]), 8, ["doc_id"]).collect()} <= set(range(8))


def test_shards_are_even_over_positions(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    got = sharding.shuffle(df, 4, ["doc_id"]).collect()
    quarter = Counter((r.doc_id // 1000, r.shard) for r in got)
    assert all(180 <= n <= 320 for n in quarter.values())
    half = sum(r.slot < 500 for r in got if r.doc_id < 2000)
    assert 850 <= half <= 1150


def test_matrix_sums_and_draws():
    rng = np.random.default_rng(1)
    homes = [int(x) for x in rng.integers(0, 50, 30)]
    sizes = [sum(homes) // 4 + (s < sum(homes) % 4) for s in range(4)]
    matrix = np.array(sharding.communication_matrix(homes, sizes, 3))
    assert matrix.sum(axis=1).tolist() == homes and matrix.sum(axis=0).tolist() == sizes and (matrix >= 0).all()
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(draws) - 6) < 0.15 and abs(np.var(draws) - 20 * .3 * .7 * 80 / 99) < 0.4
    huge = sharding.hypergeometric(rng, 10**12, 3 * 10**12, 4 * 10**6)
    assert abs(huge - 10**6) < 12 * 900


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute_hits(text, items, size=10):
    words, hit, found = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        n = min(size, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            for i in range(len(words) - n + 1):
                if words[i:i + n] == own[k:k + n]:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [1_000_000, 25])
def test_contamination_equals_brute_force(spark, frame, block_words):
    rng = random.Random(7)
    say = lambda n: " ".join(rng.choice("ab cd ef gh the of".split()) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(14)] + [(3, "The, the the"), (None, "zz yy"), (50, None)]
    rows = [(i, say(rng.randint(0, 40)) + rng.choice([" ", "."]) + rng.choice(items[:14])[1]) for i in range(50)]
    rows += [(60, None), (61, ""), (62, "ZZ-yy"), (62, "ZZ-yy"), (None, "zz yy"), (63, "the " * 20_000)]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("n_hit", F.lit("clash"))
    got = decontaminate.contamination(frame(rows), table, block_words=block_words).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id != 63:
            assert (r.n_words, r.n_hit, list(r.items)) == brute_hits(r.text, items), r
        assert r.score == "clash"
    empty = decontaminate.contamination(frame(rows), table.limit(0), carry=["doc_id"]).collect()
    assert all(r.n_hit == 0 and r["items"] == [] for r in empty)
    assert decontaminate.contamination(frame([]), table).collect() == []


def test_near_documents_hold_texts_of_similarity_080(spark, tmp_path):
    rng = random.Random(8)
    runs = lambda words: {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    rows, pairs = [], 0
    for base in range(40):
        words = [f"w{rng.getrandbits(30)}" for _ in range(rng.choice([100, 250, 800]))]
        rows.append((50 * base, " ".join(words)))
        for copy in range(1, 6):
            near = list(words)
            while True:
                more = list(near)
                more[rng.randrange(len(more))] = "changed"
                if len(runs(words) & runs(more)) < 0.8 * len(runs(words) | runs(more)):
                    break
                near = more
            rows.append((50 * base + copy, " ".join(near)))
            pairs += 1
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = entry.queries()["op3_fingerprints"](spark, str(tmp_path)).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    for r in got:
        near = sum((prints[r.doc_id] ^ p).bit_count() <= simhash.NEAR_BITS for p in prints.values())
        assert r.near_documents == (None if r.doc_id % 50 else near)
    found = sum(r.near_documents - 1 for r in got if r.doc_id % 50 == 0)
    assert 0.98 * pairs <= found <= pairs


def test_near_counts_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ASKED_BLOCK", 7)
    monkeypatch.setattr(simhash, "TASK_PAIRS", 50)
    rng = random.Random(9)
    base = rng.getrandbits(63)
    rows = [(i, (base ^ (rng.getrandbits(63) & rng.getrandbits(63) & rng.getrandbits(63)), base)) for i in range(60)]
    df = spark.createDataFrame(rows + rows[:5], "no long, bits struct<a:long,b:long>")
    got = {tuple(r.bits): r.near for r in simhash.near_counts(df, F.col("no") % 3 == 0, 12).collect()}
    assert got == {x: sum((x[0] ^ y[0]).bit_count() <= 12 for _, y in rows + rows[:5]) for i, x in rows if i % 3 == 0}
