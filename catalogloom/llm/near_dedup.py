"""MinHash near-duplicates by a chosen-path set similarity join.

Equal shingle sets are one class first. Every class has a signature of minwise
tokens. A tree starts with all classes in one node; a node chooses one or two
signature places by its own hash, and every class goes on to the child named by
its token there, 1.25 children on average, so a pair at the threshold stays
together in one child in expectation. Nodes of at most ``LEAF`` classes are
compared exhaustively by signature; larger ones branch on. How often a pair
dies out on the way grows with the depth of the leaves, so trees are added until
``missed`` for the depth reached falls to ``MISS``: one in ten thousand pairs at
the threshold, fewer above it. The scout trees below are not counted in.

Signatures only propose pairs; a link counts when the full shingle sets confirm
it. The pairs of a node that are linked to each other through pairs are a cell;
it is passed on as its members, never as its pairs, of which a group of near
copies has the square. A task confirms all pairs between a cell's leads and its
members by the words that they share, and returns only links between different
components. The first ``SCOUTS`` trees compare a few leads of each node, so that
large groups are connected early. The other trees propose every pair between
different components: in a large node, classes outside its largest component are
leads, compared with all others and taken out, and the node is finished when the
rest is one component, because pairs inside a component decide nothing. A node
that fits one task is followed down to its leaves there; only children of larger
nodes are shuffled again.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogloom.llm import words as W
from catalogloom.llm.components import components
from catalogloom.llm.frames import map_texts
from catalogloom.llm.shared import kept

PLACES = 192
#: Trees at least, and how many of those that the depth asks for run together.
TREES = 12
BATCH = 9
#: Chance to miss a pair at the threshold.
MISS = 1e-4
LEAF = 64
#: Trees that go first, levels they look at, and leads of a large node there.
SCOUTS, SCOUT_LEVELS, SCOUT_LEADS = 3, 3, 16
#: Classes of a large node that are compared with all others at a level: so many, or a quarter of the node up to ``MOST_LEADS``.
LEADS, MOST_LEADS = 64, 1024
#: A node's members per task; with more, one lead goes to all tasks of its node.
SPLIT = 8_192
#: Shingles of a cell's members that are confirmed at once; its leads go to each such part.
CELL_SHINGLES = 1 << 20
#: Distance below the threshold (in standard deviations of the agreement) from which on pairs are proposed; 2e-5 lie lower.
SLACK = 4.4
#: Bytes of a shingle hash in a full set.
WIDTH = 6

_RANDOM = np.random.default_rng(99)
_SCALE = _RANDOM.integers(1, 1 << 31, PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _RANDOM.integers(0, 1 << 32, PLACES, dtype=np.uint32)
_CHILD = np.uint64(0x9E3779B97F4A7C15)


def lowest(threshold: float) -> float:
    """Agreement of signatures from which on pairs are proposed."""
    return threshold - SLACK * math.sqrt(threshold * (1 - threshold) / PLACES)


def missed(threshold: float, depth: int, trees: int) -> float:
    """Chance that no tree with leaves at ``depth`` proposes a pair at the threshold.

    All trees share one signature, so the chance is a mean over the places that
    agree. With a share ``p`` of them, a pair in a node has one child with chance
    3/4 and two else, and stays together in each with chance ``p``.
    """
    agreed = np.arange(PLACES + 1)
    p = agreed / PLACES
    ways = np.array([math.comb(PLACES, int(k)) * threshold ** int(k) * (1 - threshold) ** int(PLACES - k) for k in agreed])
    gone = np.zeros(PLACES + 1)
    for _ in range(depth):
        child = 1 - p + p * gone
        gone = 0.75 * child + 0.25 * child ** 2
    return float((ways * np.where(p < lowest(threshold), 1, gone ** trees)).sum())


def trees_needed(threshold: float, depth: int) -> int:
    """Trees that bring ``missed`` to ``MISS``, or as far down as the tail below ``lowest`` lets it."""
    goal = max(MISS, 1.25 * missed(threshold, 0, 1))
    trees = 1
    while missed(threshold, depth, trees) > goal:
        trees += 1
    return trees


def _sets(b: W.Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within their row, and where each row's begin (n + 1 positions)."""
    count = np.diff(b.first)
    row = b.row_of_word()
    n = len(b.words)
    shingle = W.grams(b.words, size)
    at = np.arange(len(shingle))
    fits = at + size <= b.first[row[:len(shingle)] + 1]
    owner, value = row[:len(shingle)][fits], shingle[fits]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        owner = np.append(owner, short)
        value = np.append(value, [W.whole(b.words[b.first[i]:b.first[i + 1]]) for i in short])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    if n and len(value):
        new = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))
        owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(b.rows) + 1))


def _set_ids(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each row's set; 0 for an empty set."""
    out = []
    for salt in (0x1234567, 0x7654321):
        total = np.append(np.uint64(0), np.cumsum(W.mix(value ^ np.uint64(salt)), dtype=np.uint64))
        out.append(W.mix(total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _signatures(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One byte of the minimum at each place."""
    out = np.zeros((len(first) - 1, PLACES), np.uint8)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        x = (value >> np.uint64(32)).astype(np.uint32)
        for j in range(PLACES):
            low = np.minimum.reduceat(x * _SCALE[j] + _SHIFT[j], first[some])
            out[some, j] = (low * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


def sketches(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """Per row: ``n`` shingles, the set's identity ``a``, ``b`` and its signature ``sig``."""
    def maker():
        def work(texts: pa.Array):
            n, a, b2, sig = [], [], [], []
            for b in W.word_blocks(texts, W.SPACED, lower=True):
                value, first = _sets(b, size)
                ids = _set_ids(value, first)
                n.append(np.diff(first))
                a.append(ids[0])
                b2.append(ids[1])
                sig += [s.tobytes() for s in _signatures(value, first)]
            joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            return {"n": joined(n), "a": joined(a), "b": joined(b2), "sig": sig}
        return work
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("body"))
    return map_texts(rows, "body", ["doc_id"], "n long, a long, b long, sig binary", maker)


def _descend(sig: np.ndarray, row: np.ndarray, node: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of (row, node) after some steps; the choice of places depends on the node alone."""
    for _ in range(steps):
        r = W.mix(node ^ _CHILD)
        again = ((r >> np.uint64(56)) & np.uint64(3)) == 0
        place = np.append(r % np.uint64(PLACES), (r[again] >> np.uint64(20)) % np.uint64(PLACES)).astype(np.int64)
        row, node = np.append(row, row[again]), np.append(node, node[again])
        node = W.mix(node * _CHILD + (sig[row, place].astype(np.uint64) << np.uint64(8)) + place.astype(np.uint64)
                     + np.uint64(1))
    return row, node


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), PLACES)


def _roots(classes: DataFrame, steps: int, trees: range) -> DataFrame:
    """Members of the nodes at the first level that is looked at."""
    start = W.mix(np.arange(trees.start + 1, trees.stop + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                sig, ids, mark = _matrix(part.column(2)), part.column(0).to_numpy(), part.column(1).to_numpy()
                row, node = _descend(sig, np.tile(np.arange(len(ids)), len(start)), np.repeat(start, len(ids)), steps)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(ids[row]), pa.array(mark[row])],
                                                 names=["node", "id", "mark"])
    return classes.select("id", "mark", "sig").mapInArrow(run, "node long, id long, mark long")


_FOUND = "kind int, p long, q long, mark long, lead boolean"
_CELL, _MEMBER, _DEPTH = 0, 1, 2


def _compare(nodes: DataFrame, low: float, threshold: float, scout: bool, level: int) -> DataFrame:
    """Cells to confirm, the members that go on and the last level looked at, from the sorted members of nodes.

    Rows: node, salt, first (the lead of a node of several tasks), n (members
    of the node), id, mark (its component or itself), size, sig. A node of one
    task is followed down to its leaves there; only the children of larger ones
    go on as members.
    """
    def run(batches):
        held, deepest = None, -1

        def cells_of(table):
            nonlocal deepest
            made, last = _groups(table, low, threshold, scout, level)
            deepest = max(deepest, last)
            for kind, p, q, marks, leads in made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), kind, np.int32)), pa.array(p), pa.array(q), pa.array(marks), pa.array(leads)],
                    names=["kind", "p", "q", "mark", "lead"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            node, salt = table["node"].to_numpy(), table["salt"].to_numpy()
            cut = np.flatnonzero((node[1:] != node[:-1]) | (salt[1:] != salt[:-1])) + 1
            if not len(cut):
                held = table
                continue
            yield from cells_of(table.slice(0, int(cut[-1])))
            held = table.slice(int(cut[-1]))
        if held is not None and held.num_rows:
            yield from cells_of(held)
        if deepest >= 0:
            yield pa.RecordBatch.from_pylist([{"kind": _DEPTH, "p": deepest, "q": 0, "mark": 0, "lead": False}], schema=pa.schema(
                [("kind", pa.int32()), ("p", pa.int64()), ("q", pa.int64()), ("mark", pa.int64()), ("lead", pa.bool_())]))
    return nodes.mapInArrow(run, _FOUND)


def _groups(table: pa.Table, low: float, threshold: float, scout: bool, level: int) -> tuple[list[tuple], int]:
    """What whole nodes give (kind, p, q, mark, lead), and the last level looked at."""
    node, salt = table["node"].to_numpy(), table["salt"].to_numpy()
    ids, mark, size = (table[c].to_numpy() for c in ("id", "mark", "size"))
    sig = _matrix(table["sig"].combine_chunks())
    begin = np.append(0, np.flatnonzero((node[1:] != node[:-1]) | (salt[1:] != salt[:-1])) + 1)
    at, count, part = np.arange(len(node)), table["n"].to_numpy()[begin], salt[begin]
    made = []
    while True:
        found, lead, split, onward = _level(at, begin, count, part, sig, ids, mark, size, low, threshold, scout,
                                            scout and level >= SCOUT_LEVELS - 1)
        if len(found[0]):
            key, row = _cells(*found, lead, ids[at], size[at])
            made.append((_CELL, key, ids[at[row]], mark[at[row]], lead[row]))
        if len(split):
            row, child = _descend(sig, at[split], node[split].view(np.uint64), 1)
            made.append((_MEMBER, child.view(np.int64), ids[row], mark[row], np.zeros(len(row), bool)))
        at, child = _descend(sig, at[onward], node[onward].view(np.uint64), 1)
        node = child.view(np.int64)
        order = np.lexsort((ids[at], node))
        at, node = at[order], node[order]
        if len(at):
            begin = np.append(0, np.flatnonzero(node[1:] != node[:-1]) + 1)
            length = np.diff(np.append(begin, len(node)))
            goes_on = np.minimum.reduceat(mark[at], begin) != np.maximum.reduceat(mark[at], begin)
            stays = np.repeat(goes_on, length)
            at, node, count = at[stays], node[stays], length[goes_on]
            begin, part = np.cumsum(count) - count, np.zeros(len(count), np.int64)
        if not len(at):
            return made, level
        level += 1


def _level(at, begin, count, part, sig, ids, mark, size, low, threshold, scout, last):
    """One level of nodes: the pairs found, who is a lead, and who goes on, from split nodes and from others (as positions in ``at``)."""
    length = np.diff(np.append(begin, len(at)))
    large = count > LEAF
    lead = ~np.repeat(large, length)
    near = np.zeros(len(at), bool)
    found, split, onward = [], [], []

    def propose(i, j):
        one, two = at[i], at[j]
        fits = (mark[one] != mark[two]) & (np.minimum(size[one], size[two]) >= threshold * np.maximum(size[one], size[two]))
        i, j, one, two = i[fits], j[fits], one[fits], two[fits]
        est = np.concatenate([(sig[one[k:k + 65536]] == sig[two[k:k + 65536]]).mean(axis=1)
                              for k in range(0, len(i), 65536)] or [np.zeros(0)])
        found.append((i[est >= low], j[est >= low]))
        near[j[est >= threshold]] = True

    for s in np.unique(length[~large]):
        here = begin[~large & (length == s)]
        one, two = np.triu_indices(int(s), 1)
        step = max(1, (1 << 18) // max(1, len(one)))
        for k in range(0, len(here) if s > 1 else 0, step):
            some = here[k:k + step]
            propose((some[:, None] + one).ravel(), (some[:, None] + two).ravel())
    for g in np.flatnonzero(large):
        members = np.arange(begin[g], begin[g] + length[g])
        whole = count[g] <= SPLIT
        most = LEADS
        if not whole:
            leads = members[:1]
        elif scout:
            leads = members[:SCOUT_LEADS]
        else:
            names, times = np.unique(mark[at[members]], return_counts=True)
            leads = members[mark[at[members]] != names[times.argmax()]]
            most = max(LEADS, min(MOST_LEADS, len(members) // 4))
        done = not scout and whole and len(leads) <= most
        leads = leads[:most]
        lead[leads] = True
        rest = members[~np.isin(members, leads)]
        for k, one in enumerate(leads):
            others = np.append(leads[k + 1:], rest)
            propose(np.full(len(others), one), others)
        if last if scout else done:
            continue
        if scout:  # who looks like a copy of a lead need not be met again
            own = members if whole or not part[g] else members[1:]
            rest = own[~near[own]]
        (onward if whole else split).append(rest)
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, int)
    return (i, j), lead, joined(split), joined(onward)


def _joined(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest row reachable from each of ``n`` rows through the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _cells(i: np.ndarray, j: np.ndarray, lead: np.ndarray, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and rows of the cells that pairs make. The members decide the key, so that cells met again are the same."""
    label = _joined(i, j, len(ids))
    row = np.unique(np.concatenate([i, j]))
    row = row[np.lexsort((ids[row], ~lead[row], label[row]))]
    cuts = np.append(np.flatnonzero(np.append(True, label[row][1:] != label[row][:-1])), len(row))
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        cell = row[a:b]
        if size[cell].sum() <= CELL_SHINGLES:
            parts.append(cell)
            continue
        leads, rest = cell[lead[cell]], cell[~lead[cell]]
        which = np.cumsum(size[rest]) // CELL_SHINGLES
        parts += [np.append(leads, rest[which == k]) for k in np.unique(which)] or [leads]
    rows = np.concatenate(parts)
    first = np.append(0, np.cumsum([len(x) for x in parts])[:-1])
    mixed = W.mix(W.mix(ids[rows].view(np.uint64)) + lead[rows].astype(np.uint64))
    keys = W.mix(np.add.reduceat(mixed, first))
    return np.repeat(keys.view(np.int64), [len(x) for x in parts]), rows


def _full_sets(docs: DataFrame, doc_id: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """The shingle sets of the wanted classes (``id``, ``rep``), from the texts of their representatives."""
    rows = docs.select(docs[doc_id].cast("long").alias("rep"), docs[text].alias("body")).join(wanted, "rep")

    def maker():
        def work(texts: pa.Array):
            own, sets = [], []
            for b in W.word_blocks(texts, W.SPACED, lower=True):
                value, first = _sets(b, size)
                own.append(_set_ids(value, first)[0])
                raw = np.sort(value >> np.uint64(64 - 8 * WIDTH)) if len(first) == 2 else value >> np.uint64(64 - 8 * WIDTH)
                small = np.ascontiguousarray(raw.view(np.uint8).reshape(-1, 8)[:, :WIDTH])
                sets += [small[first[i]:first[i + 1]].tobytes() for i in range(len(b.rows))]
            return {"own": np.concatenate(own) if own else np.zeros(0, np.int64), "shingles": sets}
        return work
    made = map_texts(rows, "body", ["id"], "own long, shingles binary", maker)
    return made.where("own = id").dropDuplicates(["id"]).select("id", "shingles")


def _unpacked(raw: pa.Array) -> np.ndarray:
    """The shingles of all rows, one after another."""
    small = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(-1, WIDTH)
    wide = np.zeros((len(small), 8), np.uint8)
    wide[:, :WIDTH] = small
    return wide.view(np.uint64).ravel()


def _links(cells: DataFrame, threshold: float) -> DataFrame:
    """``x``, ``y``: components that cells link, from their sorted members (key, lead, mark, shingles)."""
    percent = round(threshold * 100)

    def links_of(value, size, lead, mark):
        """Links from the marks of one cell to the smallest that each reaches in it."""
        owner = np.repeat(np.arange(len(size)), size)
        order = np.argsort(value, kind="stable")
        known, owners = value[order], owner[order]
        first = np.append(0, np.cumsum(size))
        names, mine = np.unique(mark, return_inverse=True)
        label = mine.copy()
        for p in np.flatnonzero(lead):
            other = label != label[p]
            if not other.any():
                continue
            own = value[first[p]:first[p + 1]]
            low, high = np.searchsorted(known, own, "left"), np.searchsorted(known, own, "right")
            count = high - low
            if size[other].sum() < count.sum():
                asked = np.repeat(other, size)
                among = value[asked]
                place = np.minimum(np.searchsorted(own, among), len(own) - 1)
                shared = np.bincount(owner[asked][own[place] == among], minlength=len(size))
            else:
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                shared = np.bincount(owners[at], minlength=len(size))
            linked = (100 * shared >= percent * (size + size[p] - shared)) & other
            if linked.any():
                label[np.isin(label, label[linked])] = label[p]
        group = np.zeros(len(names), np.int64)
        group[mine] = label
        least = np.full(len(names), len(names))
        np.minimum.at(least, group, np.arange(len(names)))
        least = least[group]
        some = np.flatnonzero(least != np.arange(len(names)))
        return zip(names[some].tolist(), names[least[some]].tolist())

    def cells_of(table):
        key, lead, mark = (table[c].to_numpy() for c in ("key", "lead", "mark"))
        cut = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        found = []
        for a, b in zip(cut[:-1], cut[1:]):
            raw = table["shingles"].slice(a, b - a).combine_chunks()
            size = pc.binary_length(raw).to_numpy() // WIDTH
            found += links_of(_unpacked(raw), size.astype(np.int64), lead[a:b], mark[a:b])
        one, two = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["x", "y"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            key = table["key"].to_numpy()
            cut = np.flatnonzero(key[1:] != key[:-1]) + 1
            held = table
            if len(cut):
                yield cells_of(table.slice(0, int(cut[-1])))
                held = table.slice(int(cut[-1]))
        if held is not None and held.num_rows:
            yield cells_of(held)
    return cells.select("key", "lead", "mark", "shingles").mapInArrow(run, "x long, y long")


def _candidates(classes: DataFrame, threshold: float, trees: range, scout: bool) -> tuple[DataFrame, int, int]:
    """Cells (key, id, mark, lead) of some trees, the depth they are looked at from, and the depth of the leaves."""
    low = lowest(threshold)
    steps = max(0, math.ceil(math.log(max(1, classes.select("id").count() / LEAF)) / math.log(12)))
    members = _roots(classes, steps, trees)
    # Counted and met in one shuffle: nearly every node has few members, so that counts first would travel as rows.
    signed = classes.select("id", F.col("n").alias("size"), "sig")
    cells, deepest = [], 0
    while True:
        members = members.repartition("node")
        nodes = members.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("_lead"),
                                            F.min("mark").alias("_low"), F.max("mark").alias("_high"))
        open_nodes = nodes.where("n > 1 and _low != _high").select("node", "n", "_lead")
        salts = F.when(F.col("n") > SPLIT, F.ceil(F.col("n") / SPLIT)).otherwise(1).cast("int")
        first = F.col("id") == F.col("_lead")
        placed = members.join(open_nodes, "node").join(signed, "id").select(
            "node", F.explode(F.when(first, F.sequence(F.lit(0), salts - 1)).otherwise(
                F.array(F.pmod("id", salts).cast("int")))).alias("salt"),
            first.alias("first"), "n", "id", "mark", "size", "sig")
        sorted_level = placed.repartition("node", "salt").sortWithinPartitions("node", "salt", F.desc("first"), "id")
        found = kept(_compare(sorted_level, low, threshold, scout, len(cells)), "level")
        cells.append(found.where(f"kind = {_CELL}").select(F.col("p").alias("key"), F.col("q").alias("id"), "mark", "lead"))
        members = found.where(f"kind = {_MEMBER}").select(F.col("p").alias("node"), F.col("q").alias("id"), "mark")
        at, more = found.agg(F.max(F.when(F.col("kind") == _DEPTH, F.col("p"))),
                             F.max(F.col("kind") == _MEMBER)).first()
        deepest = max(deepest, at or 0)
        if not more:
            break
    return _union(cells).distinct(), steps, steps + deepest


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Roots after links between roots: only the components that they touch are worked on."""
    more = components(links)
    if labels is None:
        return kept(more, "labels")
    above = more.select(F.col("id").alias("root"), F.col("root").alias("_top"))
    moved = labels.join(above, "root", "left").select("id", F.coalesce("_top", "root").alias("root"))
    return kept(moved.union(more.join(labels.select("id"), "id", "left_anti").select("id", "root")), "labels")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
                    threshold: float = 0.8, trees: int = TREES) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Words are lower-cased (A-Z) runs without white space; a document's set is
    its distinct runs of ``shingle`` words, or its whole sequence when shorter.
    Documents whose Jaccard similarity reaches ``threshold`` are linked;
    ``component_id`` is the smallest id reachable, and ``kept`` marks the
    document that has it. A null or wordless text has no shingles and links
    with nothing. A row without id is linked with nothing either: its
    component is null and it is kept. Repeated rows share a component and are
    marked alike. Other columns are not read. An empty table gives no rows.
    """
    rows = kept(sketches(docs, doc_id, text, shingle), "sketches")
    classes = kept(rows.where("n > 0 and doc_id is not null").groupBy("a", "b").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.first("sig").alias("sig")).select(
        F.col("a").alias("id"), "b", "rep", "n", "sig"), "classes")
    labels = sets = seen = None

    def _more_sets(known: DataFrame | None, of: DataFrame) -> DataFrame | None:
        wanted = of.select("id").distinct()
        if known is not None:
            wanted = wanted.join(known.select("id"), "id", "left_anti")
        # Written first, so that few wanted classes are known to be few and the texts stay where they are.
        wanted = kept(classes.select("id", "rep").join(wanted, "id"), "wanted")
        if wanted.isEmpty():
            return known
        more = kept(_full_sets(docs, doc_id, text, shingle, wanted), "sets")
        return more if known is None else known.unionByName(more)

    ran, wanted, spare = 0, max(trees, SCOUTS + 1), 0
    while ran < wanted:
        scout = ran < SCOUTS
        some = range(ran, SCOUTS if scout else min(max(wanted, spare), ran + BATCH))
        marked = classes.withColumn("mark", F.col("id")) if labels is None else classes.join(labels, "id", "left").select(
            classes["*"], F.coalesce("root", "id").alias("mark"))
        found, _, depth = _candidates(marked, threshold, some, scout)
        # A cell met before has been confirmed, and its components have only grown since.
        cells = kept(found if seen is None else found.join(seen, "key", "left_anti"), "cells")
        seen = cells.select("key").distinct() if seen is None else seen.union(cells.select("key").distinct())
        if not cells.isEmpty():
            sets = _more_sets(sets, cells)
            whole = cells.join(sets, "id").repartition("key").sortWithinPartitions("key")
            links = kept(_links(whole, threshold), "confirmed")
            if not links.isEmpty():
                labels = _merged(labels, links)
        if not scout:
            wanted = max(wanted, SCOUTS + trees_needed(threshold, depth))
            spare = SCOUTS + trees_needed(threshold, depth + 1)  # a last batch that goes one level deeper asks for no other
        ran = some.stop
    names = classes.select(F.col("id").alias("a"), "b", "rep")
    if labels is not None:
        roots = names.join(labels.withColumnRenamed("id", "a"), "a")
        lowest = roots.groupBy("root").agg(F.min("rep").alias("low"))
        linked = roots.join(lowest, "root").select("a", "b", "low")
        names = names.join(linked, ["a", "b"], "left").select("a", "b", F.coalesce("low", "rep").alias("rep"))
    return rows.drop("sig").join(names, ["a", "b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(
            F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("component_id")).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
