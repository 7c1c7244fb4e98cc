"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

Documents are tokenised and packed in blocks of ``BLOCK_DOCS`` rows of a
partition, so packing moves no data. Whole windows are cut off a document
first. The rests are differenced: the two partial partitions with the largest
imbalance are merged, large sums against small ones, until one partition into
near-equal windows is left. While a window exceeds the capacity, the window
count rises. The emptiest windows are then cut up to fill the room in the
others, so all windows of a block but one are full, and that one is cut at its
binary digits, because a length that is a power of two needs no padding.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from catalogloom.llm import words as W

CAPACITY = 2048
#: Rows packed together, and tokens after which a block is closed early.
BLOCK_DOCS = 1024
BLOCK_TOKENS = 1 << 22
#: Text encoded at once, and distinct units whose ids a worker remembers.
BLOCK_BYTES = 1 << 22
CACHE_WORDS = 1_500_000
END_ID = 1

PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


_LETTER, _DIGIT, _MARK, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _MARK
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[[ord("'"), ord("|")]] = _OTHER
#: Second bytes after 0xC3 that are letters, and their lower case.
_ACCENTED = np.zeros(256, bool)
_ACCENTED[0x80:0xC0] = True
_ACCENTED[[0x97, 0xB7]] = False


class WordIds:
    """Token ids of texts; a unit between boundaries is encoded once.

    The tokenizer never joins what white space separates. In a word of ASCII
    and Latin-1 letters, digits and marks it also separates runs of letters,
    single digits and runs of marks, and drops case; such words are cut into
    these units. A word with anything else (an apostrophe, a bar as in special
    tokens, another script) is one unit. A text's ids are those of its units.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.memo = W.Memo()
        self.pool = np.zeros(1 << 16, np.uint32)
        self.low = np.zeros(1, np.int64)

    @staticmethod
    def _units(b: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes with case dropped where it does not matter; unit starts and ends; a flag for plain units."""
        data, n = b.data, len(b.data)
        kind = _KIND[data]
        accent = np.flatnonzero((data[:-1] == 0xC3) & _ACCENTED[data[1:]])
        kind[accent] = kind[accent + 1] = _LETTER
        other = np.append(0, np.cumsum(kind == _OTHER))
        ascii_only = np.append(0, np.cumsum(data >= 0x80))
        space = ~W.SPACED[data]
        other -= np.append(0, np.cumsum(space & (kind == _OTHER)))
        plain = other[b.ends] == other[b.starts]
        covered = np.zeros(n, bool)
        span = np.diff(np.append(b.starts, n))
        covered[b.starts[0]:] = np.repeat(plain, span)
        lowered = W.lower(data)
        second = accent + 1
        capital = second[(data[second] >= 0x80) & (data[second] <= 0x9E)]
        lowered[capital] += 0x20
        data = np.where(covered, lowered, data)
        begins = np.zeros(n, bool)
        begins[1:] = covered[1:] & ~space[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        begins[b.starts] = True
        starts = np.flatnonzero(begins)
        ends = np.minimum(np.append(starts[1:], n), b.ends[np.searchsorted(b.starts, starts, side="right") - 1])
        return data, starts, ends, covered[starts] & (ascii_only[starts] == ascii_only[ends])

    def _learn(self, keys: np.ndarray, units: list[bytes], plain: np.ndarray) -> None:
        """Encode new units; ``keys`` are sorted."""
        size = np.zeros(len(units), np.int64)
        ids: list[list[int] | None] = [None] * len(units)
        tokenize = self.encoder.model.tokenize
        for i in np.flatnonzero(plain).tolist():
            ids[i] = [t.id for t in tokenize(units[i].decode())]
        rest = np.flatnonzero(~plain).tolist()
        for low in range(0, len(rest), 4096):
            part = rest[low:low + 4096]
            for i, code in zip(part, self.encoder.encode_batch_fast([units[i].decode() for i in part],
                                                                    add_special_tokens=False)):
                ids[i] = code.ids
        size[:] = [len(x) for x in ids]
        used, total = int(self.low[-1]), int(size.sum())
        if used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), total), np.uint32)])
        self.pool[used:used + total] = [x for part in ids for x in part]
        self.memo.add(keys, np.arange(len(units)) + len(self.low) - 1)
        self.low = np.concatenate([self.low, used + np.cumsum(size)])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, without an end id."""
        for rows, data, offsets in W.byte_blocks(texts, BLOCK_BYTES):
            b = W.cut(rows, data, offsets, W.SPACED, lower=False, hashed=False)
            if not len(b.starts):
                yield from (np.zeros(0, np.uint32) for _ in rows)
                continue
            if len(self.low) > CACHE_WORDS:
                self._clear()
            data, starts, ends, plain = self._units(b)
            keys, at, which = np.unique(W.hashes(data, starts, W.SPACED), return_index=True, return_inverse=True)
            slots = self.memo.find(keys)
            fresh = np.flatnonzero(slots < 0)
            if len(fresh):
                raw, first = data.tobytes(), at[fresh]
                self._learn(keys[fresh], [raw[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())],
                            plain[first])
                slots = self.memo.find(keys)
            slot = slots[which]
            size = self.low[slot + 1] - self.low[slot]
            last = np.cumsum(size)
            ids = self.pool[np.arange(last[-1]) + np.repeat(self.low[slot] - (last - size), size)]
            cuts = np.append(0, last)[np.searchsorted(starts, offsets)]
            yield from (ids[cuts[i]:cuts[i + 1]] for i in range(len(rows)))


def differencing(sizes: np.ndarray, windows: int) -> list[np.ndarray]:
    """Items of each of at most ``windows`` near-equal windows."""
    follow = np.full(len(sizes), -1)
    heap = [(-int(s), i, (np.array([s]), np.array([i]), np.array([i]))) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        a, head, tail = heapq.heappop(heap)[2]
        b, head_b, tail_b = (x[::-1] for x in heapq.heappop(heap)[2])
        alone = min(len(a), windows - len(b))
        both = len(a) - alone
        follow[tail[alone:]] = head_b[:both]
        sums = np.concatenate([a[:alone], a[alone:] + b[:both], b[both:]])
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        head = np.concatenate([head, head_b[both:]])[order]
        tail = np.concatenate([tail[:alone], tail_b])[order]
        if len(sums) == windows:
            sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), serial, (sums, head, tail)))
        serial += 1
    out = []
    for first in heap[0][2][1] if heap else []:
        chain = [first]
        while follow[chain[-1]] >= 0:
            chain.append(follow[chain[-1]])
        out.append(np.array(chain))
    return out


def arrange(counts: np.ndarray, capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) pieces that hold every token once."""
    sequences = [[(i, start, capacity)] for i, n in enumerate(counts.tolist())
                 for start in range(0, n - n % capacity, capacity)]
    rest = counts % capacity
    items = np.flatnonzero(rest)
    if not len(items):
        return sequences
    sizes, least = rest[items], -(-int(rest.sum()) // capacity)
    count = least
    while True:
        groups = differencing(sizes, count)
        loads = np.array([sizes[g].sum() for g in groups])
        if loads.max() <= capacity:
            break
        count += max(1, count // 48)
    piece = lambda i: (int(items[i]), int(counts[items[i]] - sizes[i]), int(sizes[i]))
    order = np.argsort(-loads, kind="stable")
    packed = [[piece(i) for i in groups[g]] for g in order[:least - 1]]
    spare = [piece(i) for g in order[least - 1:] for i in groups[g]][::-1]
    for window, g in zip(packed, order):
        free = capacity - int(loads[g])
        while free:
            item, start, length = spare.pop()
            taken = min(free, length)
            window.append((item, start, taken))
            free -= taken
            if taken < length:
                spare.append((item, start + taken, length - taken))
    return sequences + packed + at_binary_digits(spare[::-1])


def at_binary_digits(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """At most one window of tokens, cut into sequences whose lengths are powers of two."""
    total = sum(p[2] for p in pieces)
    out, left = [], pieces[::-1]
    for digit in range(total.bit_length() - 1, -1, -1):
        need = total & (1 << digit)
        made = []
        while need:
            item, start, length = left.pop()
            taken = min(need, length)
            made.append((item, start, taken))
            need -= taken
            if taken < length:
                left.append((item, start + taken, length - taken))
        if made:
            out.append(made)
    return out


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, where it starts in its document, and where it lies.

    ``tokenizer`` is the path of a tokenizers file that every worker can open.
    A document's ids are its text's, then id 1; a null or empty text is that
    id alone. ``with_ids`` adds the piece's ``ids``. Repeated rows are packed
    separately. Other columns are not read. An empty table gives no rows.
    ``sequence_id`` is the partition and a counter, the same on a retry.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    fields = PIECE + (", ids array<int>" if with_ids else "")
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType),
                           *T._parse_datatype_string(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        encoder = WordIds(tokenizer)
        base, serial = TaskContext.get().partitionId() << 32, 0
        keys, ids, tokens = [], [], 0
        for batch in batches:
            for key, found in zip(batch.column(0), encoder.encode(batch.column(1))):
                keys.append(key)
                ids.append(np.append(found, np.uint32(END_ID)).astype("<u4"))
                tokens += len(ids[-1])
                if len(keys) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                    made, serial = _block(keys, ids, capacity, base, serial, arrow, with_ids)
                    yield made
                    keys, ids, tokens = [], [], 0
        if keys:
            yield _block(keys, ids, capacity, base, serial, arrow, with_ids)[0]

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(run, schema)


def _block(keys, ids, capacity, base, serial, arrow, with_ids):
    """The pieces of one block, and the number of the next sequence."""
    rows = {f.name: [] for f in arrow}
    for sequence in arrange(np.array([len(x) for x in ids]), capacity):
        offset = 0
        for item, start, length in sequence:
            part = ids[item][start:start + length]
            for name, value in zip(arrow.names, (keys[item].as_py(), start, length, zlib.crc32(part.tobytes()),
                                                 len(ids[item]), base + serial, offset, part)):
                rows[name].append(value)
            offset += length
        serial += 1
    if with_ids:
        rows["ids"] = [x.astype(np.int32) for x in rows["ids"]]
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in arrow], schema=arrow), serial
