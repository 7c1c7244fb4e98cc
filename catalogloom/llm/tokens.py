"""Greedy word-piece counts with a linear longest-match automaton.

The vocabulary is a trie with failure links. When a word leaves the trie, the
node's failure link leads to the longest part that can still go on, and the
number of pieces that are complete by then was computed with the link. So every
byte of a word is read once, and pieces are counted, never built.

A word is a run without white space, matched with a space before it, as
byte-level vocabularies write the start of a word.
"""

from __future__ import annotations

import base64
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from catalogloom.llm import words as W
from catalogloom.llm.frames import map_texts

#: Distinct words whose counts a worker remembers.
CACHE_WORDS = 2_000_000


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a rank file: one base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class LongestMatch:
    """The automaton of a vocabulary; single bytes are always pieces."""

    def __init__(self, pieces: list[bytes]):
        self.edges: dict[int, int] = {}
        letters, parents, final = [0], [0], [True]
        for piece in [*[bytes([i]) for i in range(256)], *pieces]:
            node = 0
            for letter in piece:
                key = node << 8 | letter
                if key not in self.edges:
                    self.edges[key] = len(letters)
                    letters.append(letter)
                    parents.append(node)
                    final.append(False)
                node = self.edges[key]
            final[node] = True
        self.link, self.popped = [0] * len(letters), [0] * len(letters)
        below: list[list[int]] = [[] for _ in letters]
        for node in range(1, len(letters)):
            below[parents[node]].append(node)
        queue = deque(below[0])
        while queue:
            node = queue.popleft()
            queue.extend(below[node])
            if final[node]:
                self.popped[node] = 1
                continue
            at, count = self.link[parents[node]], self.popped[parents[node]]
            while (at << 8 | letters[node]) not in self.edges:
                count += self.popped[at]
                at = self.link[at]
            self.link[node], self.popped[node] = self.edges[at << 8 | letters[node]], count

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match."""
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for letter in word:
            step = edges.get(node << 8 | letter)
            while step is None:
                total += popped[node]
                node = link[node]
                step = edges.get(node << 8 | letter)
            node = step
        while node:
            total += popped[node]
            node = link[node]
        return total


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``.

    ``vocabulary`` is the path of a rank file that every worker can open. A
    null or empty text has none of either. Added columns replace kept ones of
    the same name.
    """
    def maker():
        automaton = LongestMatch(read_vocabulary(vocabulary))
        memo = W.Memo()

        def work(texts: pa.Array):
            nonlocal memo
            n_words, n_tokens = [], []
            for b in W.word_blocks(texts):
                if len(memo) > CACHE_WORDS:
                    memo = W.Memo()
                keys, at, which = np.unique(b.words, return_index=True, return_inverse=True)
                counts = memo.find(keys)
                fresh = np.flatnonzero(counts < 0)
                if len(fresh):
                    raw, first = b.data.tobytes(), at[fresh]
                    counts[fresh] = [automaton.count(b" " + raw[i:j]) for i, j in
                                     zip(b.starts[first].tolist(), b.ends[first].tolist())]
                    memo.add(keys[fresh], counts[fresh])
                upto = np.append(0, np.cumsum(counts[which]))[b.first]
                n_words.append(np.diff(b.first))
                n_tokens.append(np.diff(upto))
            return {"n_words": np.concatenate(n_words) if n_words else [],
                    "n_tokens": np.concatenate(n_tokens) if n_tokens else []}
        return work
    return map_texts(docs, text, carry, "n_words long, n_tokens long", maker)
