"""Near-duplicates, substring removal and components against brute force."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from catalogloom.llm import near_dedup, substring_dedup
from catalogloom.llm.components import components

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text)


def shingles(text, size):
    words = SPACE.findall(lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def brute_components(rows, size, percent=80):
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 5, 40, 120]))
        rows.append((i, " ".join(words)))
    return rows


EDGES = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "é one"), (None, "one"),
         (906, "long " * 30_000), (907, "long " * 30_000), (903, "one")]


def test_near_duplicates_equal_brute_force(spark, frame):
    rows = corpus(3, 260) + EDGES
    for size in (2, 5):
        expected = brute_components(rows, size)
        got = near_dedup.near_duplicates(frame(rows), shingle=size).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.doc_id is None:
                assert r.component_id is None and r.kept
            else:
                assert (r.n_shingles, r.component_id) == expected[r.doc_id], r
                assert r.kept == (r.doc_id == r.component_id)


def test_one_large_group_of_near_copies_stays_together(spark, frame):
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(150)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    expected = brute_components(rows, 2)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(rows), shingle=2).collect()}
    assert got == {i: c for i, (_, c) in expected.items()}


def test_trees_follow_the_depth():
    """Pairs that agree in exactly 0.8 of all places but for chance, through deep trees: the miss rate is as computed."""
    rng = np.random.default_rng(6)
    for depth in (0, 1, 3, 5, 10, 15):
        trees = near_dedup.trees_needed(0.8, depth)
        assert near_dedup.missed(0.8, depth, trees) <= near_dedup.MISS
        assert trees == 1 or near_dedup.missed(0.8, depth, trees - 1) > near_dedup.MISS
    assert near_dedup.trees_needed(0.8, 3) < near_dedup.trees_needed(0.8, 10) < near_dedup.trees_needed(0.8, 15)
    pairs, depth = 2000, 10
    one = rng.integers(0, 256, (pairs, near_dedup.PLACES), dtype=np.uint8)
    two = np.where(rng.random(one.shape) < 0.8, one, rng.integers(0, 256, one.shape, dtype=np.uint8))
    for trees, bound in ((9, None), (near_dedup.trees_needed(0.8, depth), 4)):
        met = np.zeros(pairs, bool)
        for start in near_dedup.W.mix(np.arange(1, trees + 1, dtype=np.uint64)):
            sides = [set(zip(*(x.tolist() for x in near_dedup._descend(
                sig, np.arange(pairs), np.full(pairs, start), depth)))) for sig in (one, two)]
            met[[row for row, _ in sides[0] & sides[1]]] = True
        gone = int((~met).sum())
        assert gone <= bound if bound else 20 <= gone <= 100


def test_pairs_of_a_shared_template_are_found_in_deep_trees(spark, frame, monkeypatch):
    ran = []
    candidates = near_dedup._candidates

    def watched(classes, threshold, trees, scout):
        out = candidates(classes, threshold, trees, scout)
        ran.append((trees, scout, out[2]))
        return out
    monkeypatch.setattr(near_dedup, "_candidates", watched)
    template = [f"t{i}" for i in range(150)]
    rows = []
    for k in range(120):
        own = template + [f"o{k}_{i}" for i in range(60)]
        near = own[:-23] + [f"n{k}_{i}" for i in range(23)]
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(near))]
    expected = brute_components(rows, 2)
    assert len({c for _, c in expected.values()}) == 120
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(rows), shingle=2).collect()}
    assert got == {i: c for i, (_, c) in expected.items()}
    depth = max(d for _, scout, d in ran if not scout)
    assert depth >= 3 and sum(len(t) for t, scout, _ in ran if not scout) >= near_dedup.trees_needed(0.8, depth) > 9


def test_candidates_of_a_near_group_grow_with_its_size(spark, frame, monkeypatch):
    """Copies around the threshold: what is passed on grows with the copies, not with their pairs."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    copies = []
    for _ in range(600):
        words = list(base)
        for k in rng.sample(range(100), 6 + rng.randrange(4)):
            words[k] = f"x{rng.randrange(100_000)}"
        copies.append(" ".join(words))
    passed = {}
    candidates = near_dedup._candidates

    def rows_of(table):
        return table.selectExpr("sum(size(rest)) as n").first().n or 0 if "rest" in table.columns else table.count()

    def watched(classes, threshold, trees, scout):
        out = candidates(classes, threshold, trees, scout)
        if not scout:
            passed.setdefault(size, []).append(sum(rows_of(x) for x in out if hasattr(x, "columns")))
        return out
    monkeypatch.setattr(near_dedup, "_candidates", watched)
    for size in (200, 600):
        rows = list(enumerate(copies[:size]))
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(rows), shingle=2).collect()}
        assert got == {i: c for i, (_, c) in brute_components(rows, 2).items()}
    assert passed[600][0] <= 5 * passed[200][0], passed


def test_a_node_of_one_task_is_followed_to_its_leaves_there(spark, frame, monkeypatch):
    """One round of members for all levels of small nodes, and one row a member of a cell, not one a level."""
    written, asked = [], []
    written_by, candidates = near_dedup.kept, near_dedup._candidates

    def watched_kept(df, label):
        written.append(label)
        return written_by(df, label)

    def watched(*args):
        asked.append(candidates(*args))
        return asked[-1]
    monkeypatch.setattr(near_dedup, "kept", watched_kept)
    monkeypatch.setattr(near_dedup, "_candidates", watched)
    template = [f"t{i}" for i in range(150)]
    rows = []
    for k in range(60):
        own = template + [f"o{k}_{i}" for i in range(60)]
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(own[:-23] + [f"n{k}_{i}" for i in range(23)]))]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(rows), shingle=2).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows, 2).items()}
    assert max(depth - steps for _, steps, depth in asked) >= 1
    assert written.count("level") == len(asked)


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    from catalogloom.llm import components as module
    written, written_by = [], module.kept
    monkeypatch.setattr(module, "kept", lambda df, label: written.append(label) or written_by(df, label))
    links = spark.createDataFrame([(k, 1) for k in range(2, 40)] + [(101, 100), (1, 1)], "x long, y long")
    assert dict(components(links).collect()) == {**{k: 1 for k in range(1, 40)}, 100: 100, 101: 100}
    assert written == ["links"]


def test_near_duplicates_of_an_empty_table(spark, frame):
    assert near_dedup.near_duplicates(frame([])).collect() == []


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
def test_components_equal_union_find(spark, pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(components(spark.createDataFrame(pairs, "x long, y long")).collect())
    linked = {v for p in pairs if p[0] != p[1] for v in p}
    assert got == {v: find(v) for v in linked}


def brute_removal(rows, size):
    seen, out = {}, {}
    ordered = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    for i, text in ordered:
        words = SPACE.findall(text or "")
        gone = set()
        for k in range(len(words) - size + 1):
            window = tuple(words[k:k + size])
            if window in seen:
                gone.update(range(k, k + size))
            else:
                seen[window] = (i, k)
        out[i, text] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return out


def passages(seed, n):
    rng = random.Random(seed)
    common = [[f"p{k}_{j}" for j in range(rng.choice([19, 20, 21, 60]))] for k in range(5)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(common)[rng.randint(0, 3):] if rng.random() < 0.5 else [
                f"r{rng.randrange(50)}" for _ in range(rng.randint(0, 30))]
        rows.append((i, " ".join(words)))
    return rows + [(n, "same " * 100), (n + 1, None), (n + 2, ""), (n, "same " * 100), (n + 3, "same " * 19)]


def check_removal(frame, rows):
    expected = brute_removal(rows, 20)
    got = substring_dedup.remove_repeats(frame(rows)).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(
        str(type(got[0])(doc_id=i, n_words=e[0], n_removed=e[1], kept_text=e[2]))
        for i, t in rows for e in [expected[i, t]])


def test_repeats_equal_brute_force(spark, frame):
    check_removal(frame, passages(1, 60))


def test_anchors_with_many_pieces_are_exact_too(spark, frame, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_PIECES", 2)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 50)
    check_removal(frame, passages(2, 60))


def test_rows_without_id_come_last(spark, frame):
    text = " ".join(f"q{i}" for i in range(25))
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(frame([(None, text), (7, text)])).collect()}
    assert got == {7: 0, None: 25}


def test_repeats_of_an_empty_table(spark, frame):
    assert substring_dedup.remove_repeats(frame([])).collect() == []


@given(st.lists(st.integers(0, 2), max_size=40), st.lists(st.integers(0, 2), max_size=40), st.integers(1, 6))
@settings(max_examples=200, deadline=None)
def test_automaton_finds_known_substrings(known, asked, size):
    automaton = substring_dedup.SuffixAutomaton()
    automaton.extend(known)
    automaton.extend(known[::-1])
    windows = {tuple(x[i:i + size]) for x in (known, known[::-1]) for i in range(len(x) - size + 1)}
    assert automaton.matches(asked, size) == [i + size for i in range(len(asked) - size + 1)
                                              if tuple(asked[i:i + size]) in windows]
