"""Benchmark decontamination by a prefix-filtered set join.

A window is ``size`` consecutive words of an item (a shorter item is one
window). For a document to contain a window it must hold every word of it, so
one necessary word is enough as the prefix: the rarest by document frequency
over the whole corpus. Documents are joined on those words only; a candidate is
bounded by position and length, then its words are compared one by one.

Items are taken in blocks of at most ``BLOCK_WORDS`` words, the bound of what a
task receives; each block reads the documents in one more pass. Documents are
never shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogloom.llm import words as W
from catalogloom.llm.frames import map_texts

#: Words of benchmark items handed to the tasks at once (8 bytes each).
BLOCK_WORDS = 1_000_000
#: Candidate positions verified at once.
STEP = 1 << 20


def item_words(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item``, ``n`` and the hashes of its lower-cased words."""
    def maker():
        def work(texts: pa.Array):
            hashes: list[bytes] = []
            for b in W.word_blocks(texts, W.LETTERED, lower=True):
                hashes += [b.words[b.first[i]:b.first[i + 1]].tobytes() for i in range(len(b.rows))]
            return {"hashes": hashes, "n": [len(h) // 8 for h in hashes]}
        return work
    source = items.select(items[item_id].cast("string").alias("item"), items[text].alias("body"))
    return map_texts(source, "body", ["item"], "hashes binary, n int", maker)


def _frequencies(docs: DataFrame, text: str, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each word of a bounded vocabulary occurs."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    size = len(vocabulary)

    def run(batches):
        known, found = _Lookup(shared.value), np.zeros(size, np.int64)
        for batch in batches:
            for b in W.word_blocks(batch.column(0), W.LETTERED, lower=True):
                at, which = known.find(b.words)
                pairs = np.unique(b.row_of_word()[at] * size + which)
                found += np.bincount(pairs % size, minlength=size)
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(found[seen], pa.int64())],
                                         names=["word", "docs"])

    counts = (docs.select(docs[text].cast("string").alias("_text")).mapInArrow(run, "word long, docs long")
              .groupBy("word").agg(F.sum("docs").alias("docs")).toArrow())
    out = np.zeros(size, np.int64)
    out[counts["word"].to_numpy()] = counts["docs"].to_numpy()
    return out


class _Lookup:
    """Positions of known hashes in a long hash array; a bit table drops most."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << 20, bool)
        self.bits[keys & np.uint64(0xFFFFF)] = True

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys) or not len(words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.bits[words & np.uint64(0xFFFFF)])
        which = np.minimum(np.searchsorted(self.keys, words[at]), len(self.keys) - 1)
        same = self.keys[which] == words[at]
        return at[same], which[same]


class _Windows:
    """Distinct windows of one length, found through their rarest word."""

    def __init__(self, bodies: np.ndarray, owners: list[np.ndarray], rarity: dict):
        keys, counts = rarity["keys"], rarity["docs"]
        rank = counts[np.searchsorted(keys, bodies)].astype(np.float64)
        least = np.argmin(np.where(rank == rank.min(axis=1, keepdims=True), bodies, np.iinfo(np.uint64).max), axis=1)
        rare = bodies[np.arange(len(bodies)), least]
        order = np.argsort(rare, kind="stable")
        self.bodies, self.offset = bodies[order], least[order]
        self.owners = [owners[i] for i in order]
        tokens, self.low, self.count = np.unique(rare[order], return_index=True, return_counts=True)
        self.lookup = _Lookup(tokens)
        self.size = bodies.shape[1]

    def occurrences(self, b: W.Block) -> tuple[np.ndarray, np.ndarray]:
        """Verified (first word, window) pairs in a block."""
        at, token = self.lookup.find(b.words)
        row = np.searchsorted(b.first, at, side="right") - 1
        long_enough = (b.first[row + 1] - b.first[row]) >= self.size
        at, token, row = at[long_enough], token[long_enough], row[long_enough]
        starts, windows, low = [], [], 0
        ends = np.cumsum(self.count[token])
        while low < len(at):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + STEP, side="right")))
            n = self.count[token[low:high]]
            window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.low[token[low:high]], n)
            start = np.repeat(at[low:high], n) - self.offset[window]
            r = np.repeat(row[low:high], n)
            fits = (start >= b.first[r]) & (start + self.size <= b.first[r + 1])
            start, window = start[fits], window[fits]
            for j in range(self.size):
                same = b.words[start + j] == self.bodies[window, j]
                start, window = start[same], window[same]
            starts.append(start)
            windows.append(window)
            low = high
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(windows)


def _windows(hashes: list[bytes], size: int, rarity: dict) -> list[_Windows]:
    """Windows by length: nearly all of ``size``, and the short items'."""
    by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
    for item, raw in enumerate(hashes):
        words = np.frombuffer(raw, np.uint64)
        if len(words):
            length = min(size, len(words))
            bodies = np.lib.stride_tricks.sliding_window_view(words, length)
            by_length.setdefault(length, []).append((bodies, item))
    out = []
    for _, parts in sorted(by_length.items()):
        bodies = np.concatenate([p[0] for p in parts])
        item = np.concatenate([np.full(len(p[0]), p[1]) for p in parts])
        distinct, which = np.unique(bodies, axis=0, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        cuts = np.searchsorted(which.ravel()[order], np.arange(1, len(distinct)))
        out.append(_Windows(distinct, [np.unique(x) for x in np.split(item[order], cuts)], rarity))
    return out


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, doc_text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", carry: list[str] | None = None,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every document row with the benchmark windows that it contains.

    Adds ``n_words``, ``hits`` (runs of hit word positions, end exclusive),
    ``n_hit`` and ``items`` (ids as sorted distinct strings). A null or empty
    text has no words and no hits. A null or wordless item has no window; an
    item without id marks words but is not listed. Repeated items count once;
    repeated rows stay. Added columns replace kept ones of the same name.
    """
    spark = docs.sparkSession
    bodies = item_words(items, item_id, item_text).where("n > 0")
    total = bodies.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_words))
    own = [c for c in (docs.columns if carry is None else carry) if c not in ("n_words", "hits", "n_hit", "items")]
    fields = "n_words long, hits array<struct<begin:long,stop:long>>, items array<string>"
    out = docs.withColumn("hits", F.lit(None).cast("array<struct<begin:long,stop:long>>")).withColumn(
        "items", F.lit(None).cast("array<string>"))
    for block in range(blocks):
        part = bodies if blocks == 1 else bodies.where(F.pmod(F.xxhash64("item", "hashes"), F.lit(blocks)) == block)
        local = part.toArrow()
        hashes, names = local["hashes"].to_pylist(), local["item"].to_pylist()
        keys = np.unique(np.frombuffer(b"".join(hashes), np.uint64))
        rarity = {"keys": keys, "docs": _frequencies(docs, doc_text, keys) if len(keys) else keys}
        out = _marked(spark, out, doc_text, own + ([doc_text] if block < blocks - 1 and doc_text not in own else []),
                      (hashes, names, size, rarity), fields, first=block == 0)
    return out.withColumn("n_hit", F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["begin"])
                          ).select(*own, "n_words", "hits", "n_hit", "items")


def _marked(spark, docs: DataFrame, text: str, carry: list[str], block: tuple, fields: str, first: bool) -> DataFrame:
    """One block's occurrences, added to those of the blocks before."""
    shared = spark.sparkContext.broadcast(block)

    def maker():
        hashes, names, size, rarity = shared.value
        indexes = _windows(hashes, size, rarity)

        def work(texts: pa.Array):
            n_words, hits, items = [], [], []
            for b in W.word_blocks(texts, W.LETTERED, lower=True):
                n_words.append(np.diff(b.first))
                covered = np.zeros(len(b.words) + 1, np.int64)
                mine: list[set] = [set() for _ in b.rows]
                for index in indexes:
                    start, window = index.occurrences(b)
                    np.add.at(covered, start, 1)
                    np.add.at(covered, start + index.size, -1)
                    for r, w in zip(np.searchsorted(b.first, start, side="right") - 1, window):
                        mine[r].update(index.owners[w].tolist())
                inside = np.cumsum(covered[:-1]) > 0
                runs = [[] for _ in b.rows]
                if inside.any():
                    opens, stops = inside.copy(), inside.copy()
                    opens[1:] &= ~inside[:-1]
                    stops[:-1] &= ~inside[1:]
                    edge = b.first[1:-1][(b.first[1:-1] > 0) & (b.first[1:-1] < len(inside))]
                    opens[edge] |= inside[edge]
                    stops[edge - 1] |= inside[edge - 1]
                    for low, high in zip(np.flatnonzero(opens), np.flatnonzero(stops)):
                        r = int(np.searchsorted(b.first, low, side="right")) - 1
                        runs[r].append({"begin": int(low - b.first[r]), "stop": int(high + 1 - b.first[r])})
                hits += runs
                items += [sorted({names[i] for i in s if names[i] is not None}) for s in mine]
            return {"n_words": np.concatenate(n_words) if n_words else [], "hits": hits, "items": items}
        return work

    if first:
        return map_texts(docs, text, carry, fields, maker)
    before = docs.withColumnsRenamed({"hits": "__hits_before", "items": "__items_before"})
    both = map_texts(before, text, [*carry, "__hits_before", "__items_before"], fields, maker)
    return both.withColumn("hits", _united(F.concat("__hits_before", "hits"))).withColumn(
        "items", F.array_sort(F.array_union("__items_before", "items"))).drop("__hits_before", "__items_before")


def _united(runs):
    """Overlapping or touching runs as one."""
    kind = "array<struct<begin:long,stop:long>>"
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(F.array_sort(runs), F.array().cast(kind), lambda a, x: F.when(
        (F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["stop"] >= x["begin"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            last(a)["begin"].alias("begin"), F.greatest(last(a)["stop"], x["stop"]).alias("stop"))))
    ).otherwise(F.concat(a, F.array(x))))
