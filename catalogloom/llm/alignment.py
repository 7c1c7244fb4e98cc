"""Alignment of two tokenizers' ids at white space, windows memoised by their ids.

Every text is tokenised whole by both sides; as no side joins what a space
between two words separates, its ids are those of its words, and a block of
texts tokenises each distinct word once. Where both sides have a token ending
at the same byte and both go on with a token that begins with a space, the text
is split; a window is the pair of id tuples between two such ends. A block
numbers its distinct windows, aligns each once (groups are cut wherever tokens
of both sides end together, links are tokens whose bytes overlap) and keeps its
texts as window numbers. Only the counts of
linked id pairs, summed within blocks, are summed over the corpus; each block
then takes the counts of its own pairs back and puts its texts together.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogloom.llm import pieces
from catalogloom.llm.shared import kept

#: Parts of texts after which a block is closed; a text is never spread over blocks.
BLOCK_PARTS = 600_000
#: Characters that somebody may take for white space. A space between two others is where byte-level tokenizers cut.
_BLANK = "\\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
_UNSAFE = re.compile(f" (?=[{_BLANK}])|(?<=[{_BLANK}]) | $")
_BLANKS = frozenset(c for c in map(chr, [*range(0x3001), 0xFEFF]) if re.match(f"[{_BLANK}]", c))
_CUT = re.compile(f"(?<=[^{_BLANK}])(?= [^{_BLANK}])")

#: Fixed value: the pattern by which byte-level pre-tokenizers cut text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Side:
    """One tokenizer: ids of parts (without their leading space), and the bytes of each id.

    ``cuts`` tells that it never joins what a safe space separates.
    """

    def __init__(self, encode: Callable[[str], list[int]], raw: list[bytes], cuts: bool):
        self.encode, self.raw, self.cuts = encode, raw, cuts
        self.size = np.array([len(x) for x in raw])
        self.spaced = np.array([x[:1] == b" " for x in raw])
        self.names = {end: np.array([f"{i}{end}" for i in range(len(raw))], object) for end in ",|;\n"}

    def ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one after the other, and how many each has.

        Parts are encoded in rows, which their bytes cut again. Parts with a
        blank at an edge, and rows with a part whose bytes are not kept, are
        encoded one by one.
        """
        alone = [not self.cuts or p[0] in _BLANKS or p[-1] in _BLANKS for p in parts]
        order = np.argsort(alone, kind="stable")
        plain = len(parts) - sum(alone)
        found, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for low in [*range(0, plain, 4096), *([plain] if plain < len(parts) else [])]:
            some = [parts[i] for i in order[low:min(low + 4096, plain) if low < plain else len(parts)].tolist()]
            whole = np.array(self.encode(" ".join(some)) if low < plain else [], "<u4")
            want = np.cumsum(np.fromiter(map(len, map(str.encode, some)), np.int64, len(some)) + 1)
            ends = np.cumsum(self.size[whole])
            at = np.searchsorted(ends, want)
            if len(ends) and ends[-1] == want[-1] and (ends[at] == want).all():
                found.append(whole)
                counts.append(np.diff(np.append(-1, at)))
            else:
                each = [self.encode(p) for p in some]
                found.append(np.array([i for x in each for i in x], "<u4"))
                counts.append(np.array([len(x) for x in each], np.int64))
        flat, have = np.concatenate(found), np.concatenate(counts)
        count, begin = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        count[order], begin[order] = have, np.cumsum(have) - have
        return flat[np.arange(len(flat)) + np.repeat(begin - (np.cumsum(count) - count), count)], count

    def spelt(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def byte_level(path: str) -> Side:
    """A byte-level tokenizer file. Special tokens in texts are plain text.

    Where merges come in the order of their ids, these are ranks, and the
    faster of the two public engines does the same work.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    told = json.loads(tokenizer.to_str())
    before, model = told.get("pre_tokenizer") or {}, told["model"]
    cuts = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get(
        "add_prefix_space") and not told.get("normalizer")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    raw = [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab().items():
        raw[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
    merged = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model.get("merges", [])]
    ranked = cuts and merged == list(range(256, 256 + len(merged))) and not any(
        model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
    if ranked:
        import tiktoken
        engine = tiktoken.Encoding("ranks", pat_str=_PATTERN, special_tokens={},
                                   mergeable_ranks={x: i for i, x in enumerate(raw[:256 + len(merged)])})
        return Side(lambda text: engine.encode_ordinary(" " + text), raw, cuts)
    return Side(lambda text: tokenizer.encode(" " + text, add_special_tokens=False).ids, raw, cuts)


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> Side:
    """A SentencePiece model; it marks a part's start itself."""
    sp = pieces.processor(path)
    raw = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(pieces.MARK, " ").encode()
           for i in range(sp.get_piece_size())]
    return Side(sp.encode, raw, pieces.separable(sp))


def parts_of(text: str | None) -> list[str]:
    """A text cut at its safe spaces, which go."""
    if not text:
        return []
    if not _UNSAFE.search(" " + text):
        return text.split(" ")
    return [p[1:] for p in _CUT.split(" " + text)]


def windows_of(parts: list[str], one: Side, two: Side) -> tuple[list[tuple[bytes, bytes]], np.ndarray]:
    """Windows (packed ids of both sides) of parts, and the count of each; 0 where a side's bytes are not the part's.

    A part begins with a space on both sides, so its ends are always window ends.
    """
    (a, count_a), (b, count_b) = one.ids(parts), two.ids(parts)
    whole = (" " + " ".join(parts)).encode() if parts else b""
    good = np.ones(len(parts), bool)
    if one.spelt(a) != whole or two.spelt(b) != whole:
        cut_a, cut_b = np.split(a, np.cumsum(count_a)[:-1]), np.split(b, np.cumsum(count_b)[:-1])
        good = np.array([one.spelt(x) == two.spelt(y) == (" " + p).encode() for p, x, y in zip(parts, cut_a, cut_b)], bool)
        a, b = a[np.repeat(good, count_a)], b[np.repeat(good, count_b)]
    count = np.zeros(len(parts), np.int64)
    if not len(a):
        return [], count
    end_a, end_b = np.cumsum(one.size[a]), np.cumsum(two.size[b])
    at = np.searchsorted(end_b, end_a)
    shared = np.flatnonzero(end_b[at] == end_a)
    split = one.spaced[a[np.minimum(shared + 1, len(a) - 1)]] & two.spaced[b[np.minimum(at[shared] + 1, len(b) - 1)]]
    split[-1] = True
    cut = shared[split]
    raw_a, raw_b = a.tobytes(), b.tobytes()
    to_a, to_b = (4 * (cut + 1)).tolist(), (4 * (at[cut] + 1)).tolist()
    found = [(raw_a[i:j], raw_b[k:m]) for i, j, k, m in zip([0, *to_a], to_a, [0, *to_b], to_b)]
    last = np.cumsum(count_a[good]) - 1
    count[good] = np.diff(np.append(0, np.searchsorted(cut, last, side="right")))
    return found, count


class Block:
    """Distinct windows laid end to end, so that one pass over their byte ends aligns them all.

    ``size_a`` and ``size_b`` are token counts of the windows, ``a`` and ``b`` their ids.
    """

    def __init__(self, size_a: np.ndarray, size_b: np.ndarray, a: np.ndarray, b: np.ndarray, one: np.ndarray, two: np.ndarray):
        self.size_a, self.size_b, self.a, self.b = size_a, size_b, a, b
        end_a, end_b = np.cumsum(one[a]), np.cumsum(two[b])
        # the bytes between neighbouring ends of either side lie in one token of each
        stops = np.union1d(end_a, end_b)
        i, j = np.searchsorted(end_a, stops), np.searchsorted(end_b, stops)
        self.pair = a[i].astype(np.int64) << 32 | b[j]
        closes = end_a[np.cumsum(size_a) - 1] if len(size_a) else np.zeros(0, np.int64)
        self.link = np.searchsorted(stops, closes, side="right")
        shared = np.flatnonzero((end_a[i] == stops) & (end_b[j] == stops))
        self.cut_a, self.cut_b = i[shared] + 1, j[shared] + 1
        self.group = np.searchsorted(stops[shared], closes, side="right")

    def per_window(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of each link over the links of each window."""
        return np.diff(np.append(0, np.cumsum(values))[np.append(0, self.link)])

    def groups(self, one: Side, two: Side) -> list[str]:
        """The groups of each window as text: names of all tokens with what follows them, put in order and cut again."""
        if not len(self.a):
            return []
        of_a = np.searchsorted(self.cut_a, np.arange(len(self.a)), side="right")
        of_b = np.searchsorted(self.cut_b, np.arange(len(self.b)), side="right")
        every = np.empty(len(self.a) + len(self.b), object)
        every[np.arange(len(self.a)) + np.append(0, self.cut_b)[of_a]] = one.names[","][self.a]
        every[np.arange(len(self.b)) + self.cut_a[of_b]] = two.names[","][self.b]
        every[self.cut_a - 1 + np.append(0, self.cut_b[:-1])] = one.names["|"][self.a[self.cut_a - 1]]
        every[self.cut_b - 1 + self.cut_a] = two.names[";"][self.b[self.cut_b - 1]]
        last = self.group - 1
        every[self.cut_b[last] - 1 + self.cut_a[last]] = two.names["\n"][self.b[self.cut_b[last] - 1]]
        return "".join(every.tolist()).split("\n")[:-1]


def _packed(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed: the high bytes of small numbers take no room."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = pa.decompress(raw[8:], 4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<u4").ravel().astype(np.int64)


def _blocks(docs: DataFrame, text: str, carry: Sequence[str], one: str, two: str) -> DataFrame:
    """Rows (``_1`` ... for carry, ``_block``, ``_from``, ``_count`` of its windows); a block's first row has its windows and pair counts."""
    source = docs.select(docs[text].cast("string").alias("_0"), *[docs[c].alias(f"_{i + 1}") for i, c in enumerate(carry)])
    own = "_block long, _from long, _count long, _data array<binary>, _pairs array<long>, _times array<long>"
    schema = T.StructType([source.schema[f"_{i + 1}"] for i in range(len(carry))] + T._parse_datatype_string(own).fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level(one), sentence_pieces(two)
        cut = parts_of if first.cuts and second.cuts else lambda t: [t] if t else []
        block = TaskContext.get().partitionId() << 32
        number: dict[str, int] = {}
        held: list[pa.Table] = []
        places: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            found, count = windows_of(list(number), first, second)
            known: dict[tuple[bytes, bytes], int] = {}
            of_part = np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, len(found))
            begin = np.cumsum(count) - count
            sizes = np.array([len(p) for p in places], np.int64)
            flat = np.concatenate(places)
            bad = np.append(0, np.cumsum(count[flat] == 0))
            ends = np.cumsum(sizes)
            flat = flat[np.repeat(bad[ends] == bad[ends - sizes], sizes)]
            sizes[bad[ends] > bad[ends - sizes]] = 0
            per_text = np.append(0, np.cumsum(count[flat]))
            ends = np.cumsum(sizes)
            counts = per_text[ends] - per_text[ends - sizes]
            flat = of_part[np.arange(per_text[-1]) + np.repeat(begin[flat] - per_text[:-1], count[flat])]
            times = np.bincount(flat, minlength=len(known))
            order = np.argsort(-times, kind="stable")
            order = order[:np.count_nonzero(times)]
            rank = np.empty(len(known), np.int64)
            rank[order] = np.arange(len(order))
            names = list(known)
            names, times = [names[i] for i in order.tolist()], times[order]
            lengths = [np.array([len(x[side]) // 4 for x in names], np.int64) for side in (0, 1)]
            ids = [np.frombuffer(b"".join([x[side] for x in names]), "<u4") for side in (0, 1)]
            made = Block(*lengths, *ids, first.size, second.size)
            pairs, of = np.unique(made.pair, return_inverse=True)
            linked = np.zeros(len(pairs), np.int64)
            np.add.at(linked, of, np.repeat(times, np.diff(np.append(0, made.link))))
            head = lambda x, kind: pa.array([x] + [None] * (len(places) - 1), pa.list_(kind))
            rows = pa.concat_tables(held).combine_chunks() if carry else None
            return pa.RecordBatch.from_arrays([
                *[rows.column(i).combine_chunks() for i in range(len(carry))],
                pa.array(np.full(len(places), block)), pa.array(np.cumsum(counts) - counts), pa.array(counts),
                head([_packed(x) for x in (rank[flat], *lengths, *ids)], pa.binary()),
                head(pairs, pa.int64()), head(linked, pa.int64())], names=schema.names)

        total = 0
        for batch in batches:
            columns = pa.table(batch.columns[1:], names=schema.names[:len(carry)]) if carry else None
            low = 0
            for at, text in enumerate(batch.column(0)):
                parts = cut(text.as_py())
                places.append(np.fromiter((number.setdefault(p, len(number)) for p in parts), np.int64, len(parts)))
                total += len(parts)
                if total >= BLOCK_PARTS:
                    if carry:
                        held.append(columns.slice(low, at + 1 - low))
                    yield closed()
                    number.clear()
                    low, total, block, held, places = at + 1, 0, block + 1, [], []
            if carry and low < batch.num_rows:
                held.append(columns.slice(low))
        if places:
            yield closed()
    return source.mapInArrow(run, schema)


_STATS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _together(stay: list[str], one: str, two: str, texts: pa.Table, counts: pa.Table) -> pa.Table:
    """The texts of one block from its windows and the corpus counts of its pairs."""
    data = next(x for x in texts["_data"].to_pylist() if x is not None)
    flat, size_a, size_b, a, b = map(_unpacked, data)
    first, second = byte_level(one), sentence_pieces(two)
    block = Block(size_a, size_b, a, b, first.size, second.size)
    order = np.argsort(counts["pair"].to_numpy())
    at = order[np.searchsorted(counts["pair"].to_numpy()[order], block.pair)]
    count, best = counts["count"].to_numpy()[at], counts["best"].to_numpy()[at].astype(np.int64)
    per_window = {"n_a": size_a, "n_b": size_b, "n_groups": np.diff(np.append(0, block.group)),
                  "n_links": np.diff(np.append(0, block.link)), "n_best": block.per_window(best),
                  "count_sum": block.per_window(count)}
    begin = texts["_from"].to_numpy()
    end = begin + texts["_count"].to_numpy()
    columns = [texts[c] for c in stay]
    for name in _STATS:
        total = np.append(0, np.cumsum(per_window[name][flat]))
        columns.append(pa.array(total[end] - total[begin]))
    names, flat = block.groups(first, second), flat.tolist()
    columns.append(pa.array([";".join(map(names.__getitem__, flat[i:j])) for i, j in zip(begin.tolist(), end.tolist())], pa.string()))
    return pa.table(columns, names=[*stay, *_STATS, "groups"])


def aligned(docs: DataFrame, one: str, two: str, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the alignment of a byte-level tokenizer file (``one``) and a SentencePiece model (``two``).

    New columns: ``n_a``, ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best``
    (links whose ids are linked as often as any link of their second id),
    ``count_sum`` (over links, how often their ids are linked in the corpus) and
    ``groups`` (``a1,a2|b1;a3|b2``). ``carry`` names the columns to keep (all
    when None); a kept column of a new name is replaced. A null or empty text,
    and one that a side does not keep byte by byte, has no tokens: zeros and an
    empty string. Repeated rows stay separate rows and count each; an empty
    table gives none.
    """
    new = [*_STATS, "groups"]
    stay = [c for c in (docs.columns if carry is None else carry) if c not in new]
    rows = kept(_blocks(docs, text, stay, one, two), "blocks")
    own = rows.where("_pairs is not null").select("_block", F.explode(F.arrays_zip("_pairs", "_times")).alias("_p")).select(
        F.col("_block").alias("_of"), F.col("_p._pairs").alias("pair"), F.col("_p._times").alias("times"))
    pairs = own.groupBy("pair").agg(F.sum("times").alias("count")).withColumn(
        "second", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    most = pairs.groupBy("second").agg(F.max("count").alias("most"))
    ranked = pairs.join(most, "second").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    found = own.select("_of", "pair").join(ranked, "pair")
    names = [f"_{i + 1}" for i in range(len(stay))]
    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in _STATS]
                          + [T.StructField("groups", T.StringType())])
    made = rows.drop("_pairs", "_times").groupBy("_block").cogroup(found.groupBy("_of")).applyInArrow(
        partial(_together, names, one, two), schema)
    return made.toDF(*stay, *new)
