"""Removal of repeated passages with suffix automata of reference shards.

A window of ``size`` words is repeated when the same words start earlier. Equal
windows contain the same anchor (the least of their word-run hashes) at the same
place, so windows with one anchor make a piece, and only pieces that share an
anchor can repeat each other. Pieces that are wholly equal are settled by the
first of them. The others are the reference: they are dealt to shards by
anchor, and in every shard a suffix automaton is grown piece by piece in
document order, after the piece has been streamed through it: where the
matching statistic reaches ``size``, the window has started earlier.

Anchors with very many different pieces (the edges of a common passage) are not
put into one shard; their windows are compared by an aggregate, which combines
equal windows before the shuffle. Nothing is dropped or capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogloom.llm import words as W
from catalogloom.llm.shared import kept

#: Words whose hash can be an anchor.
ANCHOR_WORDS = 8
#: Different pieces of one anchor up to which an automaton takes them.
SHARD_PIECES = 1_000
#: Words after which a shard's automaton is closed at the next anchor.
SHARD_WORDS = 40_000
_LAST = (1 << 63) - 1


class SuffixAutomaton:
    """Substrings of word sequences; sequences are added one after another."""

    def __init__(self):
        self.link, self.length, self.step = [-1], [0], [{}]

    def extend(self, words: list[int]) -> None:
        link, length, step = self.link, self.length, self.step
        last = 0
        for word in words:
            known = step[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known
                continue
            if known is not None:
                last = self._split(last, word, known)
                continue
            new = len(link)
            link.append(0)
            length.append(length[last] + 1)
            step.append({})
            at = last
            while at >= 0 and word not in step[at]:
                step[at][word] = new
                at = link[at]
            if at >= 0:
                found = step[at][word]
                link[new] = found if length[found] == length[at] + 1 else self._split(at, word, found)
            last = new

    def _split(self, at: int, word: int, found: int) -> int:
        """A copy of ``found`` for the shorter strings that end as it does."""
        link, length, step = self.link, self.length, self.step
        copy = len(link)
        link.append(link[found])
        length.append(length[at] + 1)
        step.append(dict(step[found]))
        link[found] = copy
        while at >= 0 and step[at].get(word) == found:
            step[at][word] = copy
            at = link[at]
        return copy

    def matches(self, words: list[int], size: int) -> list[int]:
        """Positions after which the last ``size`` words are a known substring."""
        link, length, step = self.link, self.length, self.step
        state = matched = 0
        out = []
        for i, word in enumerate(words):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
            if matched >= size:
                out.append(i + 1)
        return out


def _pieces(b: W.Block, size: int) -> tuple[np.ndarray, ...]:
    """Row, anchor, content, first window and number of windows of each piece of a block."""
    words = b.words
    none = np.zeros(0, np.int64)
    if len(words) < size:
        return none, none, none, none, none
    anchors, windows = W.grams(words, ANCHOR_WORDS), W.grams(words, size)
    at = np.arange(len(windows))
    row = b.row_of_word()[:len(windows)]
    least = at + np.lib.stride_tricks.sliding_window_view(anchors, size - ANCHOR_WORDS + 1).argmin(axis=1)
    fits = at + size <= b.first[row + 1]
    at, row, least, windows = at[fits], row[fits], least[fits], windows[fits]
    if not len(at):
        return none, none, none, none, none
    new = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])))
    count = np.diff(np.append(new, len(at)))
    place = np.arange(len(at)) - np.repeat(new, count)
    content = W.mix(np.add.reduceat(windows * W.GRAM[place], new) + count.astype(np.uint64))
    return row[new], anchors[least[new]].view(np.int64), content.view(np.int64), at[new] - b.first[row[new]], count


_PIECE = "anchor long, content long, d long, t long, begin int, windows int"


def _all_pieces(rows: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for b in W.word_blocks(batch.column(2)):
                row, anchor, content, begin, count = _pieces(b, size)
                own = row + b.rows.start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(content), pa.array(ids[own]), pa.array(digests[own]),
                     pa.array(begin.astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["anchor", "content", "d", "t", "begin", "windows"])
    return rows.select("d", "t", "text").mapInArrow(run, _PIECE)


def _with_words(rows: DataFrame, pieces: DataFrame, size: int, single: bool) -> DataFrame:
    """The words of pieces, or of each of their windows when ``single``, read from the documents again."""
    wanted = pieces.groupBy("d", "t").agg(F.collect_list(F.struct("anchor", "begin", "windows")).alias("pieces"))
    source = rows.join(wanted, ["d", "t"]).select("d", "t", "text", "pieces")
    length = 1 if single else None

    def run(batches):
        for batch in batches:
            ids, digests, found = batch.column(0), batch.column(1), batch.column(3)
            for b in W.word_blocks(batch.column(2)):
                out = {n: [] for n in ("anchor", "d", "t", "begin", "words")}
                for i, r in enumerate(b.rows):
                    own = b.words[b.first[i]:b.first[i + 1]]
                    for piece in found[r].as_py():
                        total = piece["windows"]
                        for k in range(0, total, length or total):
                            begin = piece["begin"] + k
                            out["anchor"].append(piece["anchor"])
                            out["d"].append(ids[r].as_py())
                            out["t"].append(digests[r].as_py())
                            out["begin"].append(begin)
                            out["words"].append(own[begin:begin + (length or total) + size - 1].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["anchor"], pa.int64()), pa.array(out["d"], pa.int64()), pa.array(out["t"], pa.int64()),
                     pa.array(out["begin"], pa.int32()), pa.array(out["words"], pa.binary())],
                    names=["anchor", "d", "t", "begin", "words"])
    return source.mapInArrow(run, "anchor long, d long, t long, begin int, words binary")


def _streamed(shards: DataFrame, size: int) -> DataFrame:
    """Repeated windows of pieces sorted by anchor and document order, as word runs."""
    def run(batches):
        automaton, held, anchor, before = SuffixAutomaton(), 0, None, None
        for batch in batches:
            out = {n: [] for n in ("d", "t", "begin", "stop")}
            for key, d, t, begin, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if key != anchor:
                    anchor, before = key, None
                    if held > SHARD_WORDS:
                        automaton, held = SuffixAutomaton(), 0
                words = np.frombuffer(raw, np.uint64).tolist()
                for end in automaton.matches(words, size) if (d, t, begin) != before else []:
                    out["d"].append(d)
                    out["t"].append(t)
                    out["begin"].append(begin + end - size)
                    out["stop"].append(begin + end)
                automaton.extend(words)
                held += len(words)
                before = (d, t, begin)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["d"], pa.int64()), pa.array(out["t"], pa.int64()), pa.array(out["begin"], pa.int64()),
                 pa.array(out["stop"], pa.int64())], names=["d", "t", "begin", "stop"])
    return shards.mapInArrow(run, "d long, t long, begin long, stop long")


def repeated_runs(rows: DataFrame, size: int) -> DataFrame:
    """Word runs (d, t, begin, stop) that repeated windows cover; runs may overlap."""
    pieces = _all_pieces(rows, size)
    met = pieces.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = kept(pieces.join(met, "anchor"), "pieces")
    order = F.struct("d", "begin", "t", "windows")
    firsts = kept(shared.groupBy("anchor", "content").agg(F.min(order).alias("first")), "firsts")
    copies = shared.join(firsts, ["anchor", "content"]).where(
        (F.col("d") != F.col("first.d")) | (F.col("begin") != F.col("first.begin"))).select(
        "d", "t", F.col("begin").cast("long").alias("begin"), (F.col("begin") + F.col("windows") + size - 1).cast("long").alias("stop"))
    several = firsts.groupBy("anchor").count().where("count > 1")
    reference = firsts.join(several, "anchor").select("anchor", "first.*", "count")
    few = _with_words(rows, reference.where(F.col("count") <= SHARD_PIECES), size, single=False)
    shards = few.repartition("anchor").sortWithinPartitions("anchor", "d", "begin", "t")
    runs = copies.union(_streamed(shards, size))
    if not several.where(F.col("count") > SHARD_PIECES).isEmpty():
        many = _with_words(rows, reference.where(F.col("count") > SHARD_PIECES), size, single=True).select(
            "d", "t", "begin", F.xxhash64("words").alias("w"), F.xxhash64("words", F.lit(1)).alias("v"))
        first = many.groupBy("w", "v").agg(F.min(F.struct("d", "begin")).alias("first"))
        later = many.join(first, ["w", "v"]).where(F.struct("d", "begin") != F.col("first"))
        runs = runs.union(later.select("d", "t", F.col("begin").cast("long").alias("begin"),
                                       (F.col("begin") + size).cast("long").alias("stop")))
    return runs


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 20) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``.

    Words are runs without white space. A word is removed when a window of
    ``size`` words over it also starts earlier: in a row with a smaller id or
    earlier in the same row. Windows are judged on the input. Kept words are
    joined by one space. A null or empty text has no words and an empty kept
    text. Rows without id come after all others. Repeated rows (same id and
    text) are one document and treated alike. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.coalesce(docs[doc_id].cast("long"), F.lit(_LAST)).alias("d"), docs[text].cast("string").alias("text")).select(
        "d", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("t"), F.coalesce("text", F.lit("")).alias("text"))
    runs = repeated_runs(rows, size).distinct().groupBy("d", "t").agg(
        F.collect_list(F.struct("begin", "stop")).alias("runs"))
    joined = rows.join(runs, ["d", "t"], "left").select("text", "runs", "d")

    def run(batches):
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            for b in W.word_blocks(batch.column(0)):
                gone = np.zeros(len(b.words) + 1, np.int64)
                for i, r in enumerate(b.rows):
                    for x in batch.column(1)[r].as_py() or ():
                        gone[b.first[i] + x["begin"]] += 1
                        gone[b.first[i] + x["stop"]] -= 1
                stays = np.cumsum(gone[:-1]) == 0
                n_words.append(np.diff(b.first))
                upto = np.append(0, np.cumsum(stays))
                n_removed.append(np.diff(b.first) - np.diff(upto[b.first]))
                texts.append(_joined(b, stays))
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(np.concatenate(n_words)), pa.array(np.concatenate(n_removed)),
                 pa.concat_arrays(texts)], names=["d", "n_words", "n_removed", "kept_text"])
    done = joined.mapInArrow(run, "d long, n_words long, n_removed long, kept_text string")
    return done.select(F.when(F.col("d") != _LAST, F.col("d")).cast(kind).alias("doc_id"), "n_words", "n_removed", "kept_text")


def _joined(b: W.Block, stays: np.ndarray) -> pa.Array:
    """Each row's kept words, joined by one space."""
    starts, size = b.starts[stays], (b.ends - b.starts)[stays]
    upto = np.append(0, np.cumsum(stays))[b.first]
    last = np.zeros(len(starts), bool)
    last[upto[1:][upto[1:] > upto[:-1]] - 1] = True
    span = size + ~last
    ends = np.append(0, np.cumsum(span))
    total = int(ends[-1])
    data = b.data[np.minimum(np.arange(total) + np.repeat(starts - ends[:-1], span), max(0, len(b.data) - 1))]
    data[(ends[1:] - 1)[~last]] = 32
    return pa.StringArray.from_buffers(len(b.rows), pa.py_buffer(ends[upto].astype(np.int32).tobytes()),
                                       pa.py_buffer(data.tobytes()))
