"""SentencePiece encoding and decoding with a table of distinct marked words.

White space becomes a marker, and a text begins with one. When no piece of the
model reads over the start of a marker run and the model takes text as it is,
the text's segmentation is that of its marked words: runs of markers with what
follows. A task cuts a block of texts into marked words, segments each distinct
one once and joins the ids back by position. For other models the unit is the
whole text. The table stays in the task: no row is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from catalogloom.llm.frames import map_texts

MARK = "▁"
#: Characters of text in a block, and distinct words that a worker remembers before its table starts anew.
BLOCK_CHARS = 1 << 21
REMEMBERED = 500_000
_MARKED = re.compile(" +[^ ]*")


def processor(model: str):
    """The library's processor of a model file."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialized message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else 8 if key & 7 == 1 else 4
            yield key >> 3, raw[at:at + size]
            at += size


def separable(sp) -> bool:
    """Whether marked words can be segmented alone: a plain normaliser with a leading marker, and no piece over a marker's start."""
    model = {k: v for k, v in _fields(sp.serialized_model_proto()) if k in (2, 3)}
    trainer, normalizer = (dict(_fields(model.get(k, b""))) for k in (2, 3))
    plain = (not normalizer.get(2) and normalizer.get(3, 1) == 1 and normalizer.get(4, 1) == 0
             and normalizer.get(5, 1) == 1 and not trainer.get(24, 0))
    return plain and not any(re.search(f"[^{MARK}]{MARK}", sp.id_to_piece(i)) for i in range(sp.get_piece_size()))


def marked_words(text: str) -> list[str]:
    """The marked words of a text, markers as spaces; a literal marker is white space to the model."""
    return _MARKED.findall(" " + text.replace(MARK, " ")) if text else []


def segment(sp, words: list[str]) -> list[list[int]]:
    """Ids of marked words. The library marks a text's start itself, and gives an empty text none."""
    bare = [w[1:] for w in words]
    ids = sp.encode(bare, num_threads=1)
    if "" in bare:
        alone = sp.encode("a ")[len(sp.encode("a")):]
        ids = [x if w else alone for w, x in zip(bare, ids)]
    return ids


class PartTable:
    """Ids of the distinct parts of texts, packed; a new part is encoded once, and a text's ids are joined by position."""

    def __init__(self, parts: Callable[[str], list[str]], encode: Callable[[list[str]], list[list[int]]]):
        self.parts, self.encode, self.known = parts, encode, {}

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cut = [self.parts(t) for t in texts]
        new = list({p for c in cut for p in c if p not in self.known})
        self.known.update(zip(new, (np.array(x, "<u4").tobytes() for x in self.encode(new))) if new else ())
        return [b"".join(map(self.known.__getitem__, c)) for c in cut]


def word_table(sp) -> PartTable:
    """The table of a model's marked words, or of whole texts where these cannot stand alone."""
    if separable(sp):
        return PartTable(marked_words, lambda words: segment(sp, words))
    return PartTable(lambda t: [t] if t else [], lambda texts: sp.encode(texts, num_threads=1))


def blocks(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts of bounded size; a null is an empty text, a longer text a block of its own."""
    block, size = [], 0
    for t in texts:
        block.append(t or "")
        size += len(block[-1])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def encode(docs: DataFrame, model: str, text: str = "text", carry: Sequence[str] | None = None,
           begin: bool = True, end: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (little-endian unsigned 32-bit, packed) and ``n_tokens``, as the library encodes each text.

    ``carry`` names the columns to keep (all when None); a kept column of a new
    name is replaced. A null or empty text has only the begin and end ids that
    are asked for. Repeated rows stay separate rows; an empty table gives none.
    """
    def maker():
        sp = processor(model)
        table = word_table(sp)
        head, tail = (np.array(x, "<u4").tobytes() for x in ([sp.bos_id()] * begin, [sp.eos_id()] * end))

        def work(texts: pa.Array):
            ids = [head + x + tail for block in blocks(texts.to_pylist()) for x in table.ids(block)]
            return {"ids": ids, "n_tokens": [len(x) // 4 for x in ids]}
        return work
    return map_texts(docs, text, carry, "ids binary, n_tokens long", maker)


def decode(coded: DataFrame, model: str, ids: str = "ids", carry: Sequence[str] | None = None) -> DataFrame:
    """``coded`` with ``decoded``: the library's text of each row's packed ids; null or no ids give an empty text.

    An id outside the vocabulary is an error of the library.
    """
    def maker():
        sp = processor(model)

        def work(packed: pa.Array):
            return {"decoded": [sp.decode(np.frombuffer(x, "<u4").tolist()) if x else "" for x in packed.to_pylist()]}
        return work
    return map_texts(coded, ids, carry, "decoded string", maker, kind="binary")
