"""Language identification with error-correcting output codes.

Every language has a codeword. For every bit a binary classifier over hashed
byte trigrams tells the languages with the bit from those without: a log-ratio
of trigram probabilities, learned from counts over all training documents in
one pass. A document is decoded to the codeword with the least weighted loss
of its bit margins; bits that separate the languages well weigh more. When the
best two losses are close, the document is flagged as ambiguous.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogloom.llm import words as W
from catalogloom.llm.frames import map_texts

#: Trigram buckets; with many languages the counts are kept to 2^22 numbers.
BUCKETS = 1 << 16
COUNTS = 1 << 22
#: Text handled at once when bits are predicted.
STEP_BYTES = 1 << 18
UNKNOWN = "und"
#: Below this difference of the mean losses of the two best codewords, a document is ambiguous.
AMBIGUOUS = 0.05

_FOLD = W.lower(np.arange(256, dtype=np.uint8))
_FOLD[:65] = 32
_FOLD[91:97] = 32
_FOLD[123:128] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def codewords(languages: int) -> np.ndarray:
    """One row of +1/-1 bits per language, rows far apart, no two columns alike or opposite."""
    if languages <= 5:
        columns = [c for c in itertools.product((1, -1), repeat=languages) if c[0] == 1 and -1 in c] or [(1,)]
        return np.array(columns).T
    bits = 8 + 4 * int(np.ceil(np.log2(languages)))
    rng, best, far = np.random.default_rng(5), None, -1
    for _ in range(200):
        code = np.where(rng.random((languages, bits)) < 0.5, 1, -1)
        if (abs(code.sum(axis=0)) == languages).any():
            continue
        agree = code @ code.T
        np.fill_diagonal(agree, -bits)
        if (bits - agree.max()) // 2 > far:
            best, far = code, (bits - agree.max()) // 2
    return best


def _grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram that ends at each byte, and the folded bytes; a row starts as after spaces."""
    folded = _FOLD[data].astype(np.uint32)
    one, two = np.full_like(folded, 32), np.full_like(folded, 32)
    one[1:] = folded[:-1]
    two[2:] = folded[:-2]
    first = offsets[:-1][offsets[:-1] < len(data)]
    one[first] = two[first] = 32
    second = first[first + 1 < len(data)] + 1
    two[second] = 32
    h = (folded * np.uint32(0x9E3779B1)) ^ (one * np.uint32(0x85EBCA77)) ^ (two * np.uint32(0xC2B2AE3D))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int64), folded


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """A model from labelled documents: languages, codewords, bit weights and trigram log-ratios.

    Rows with a null language or text are left out. All rows count, in one
    pass; tasks return a bounded table of counts. Without labels the model has
    no language and predicts ``und``.
    """
    labelled = docs.where(docs[lang].isNotNull() & docs[text].isNotNull()).select(
        docs[lang].cast("string").alias("_lang"), docs[text].cast("string").alias("_text"))
    languages = sorted(r[0] for r in labelled.select("_lang").distinct().collect())
    if not languages:
        return {"languages": []}
    n, buckets = len(languages), BUCKETS
    while n * buckets > COUNTS and buckets > 4096:
        buckets //= 2

    def run(batches):
        known = {x: i for i, x in enumerate(languages)}
        counts = np.zeros(n * buckets, np.int64)
        for batch in batches:
            label = batch.column(0).cast(pa.string()).dictionary_encode()
            which = np.array([known[x] for x in label.dictionary.to_pylist()])[label.indices.to_numpy()]
            for rows, data, offsets in W.byte_blocks(batch.column(1)):
                gram, _ = _grams(data, offsets, buckets)
                own = np.repeat(which[rows.start:rows.stop], np.diff(offsets))
                counts += np.bincount(own * buckets + gram, minlength=n * buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["cell", "seen"])

    found = labelled.mapInArrow(run, "cell long, seen long").groupBy("cell").agg(F.sum("seen").alias("seen")).toArrow()
    counts = np.zeros(n * buckets)
    counts[found["cell"].to_numpy()] = found["seen"].to_numpy()
    share = counts.reshape(n, buckets) + 0.5
    share /= share.sum(axis=1, keepdims=True)
    code = codewords(n)
    ratio, scale = [], []
    for bit in code.T:
        yes = share[bit > 0].mean(axis=0)
        no = share[bit < 0].mean(axis=0) if (bit < 0).any() else np.full(buckets, 1 / buckets)
        log = np.log(yes / no)
        means = share @ log
        middle = (means[bit > 0].min() + means[bit < 0].max()) / 2 if (bit < 0).any() else 0.0
        ratio.append(log - middle)
        scale.append(max(1e-3, float((bit * (means - middle)).min())))
    weight = np.array(scale)
    return {"languages": languages, "buckets": buckets, "code": code, "weight": weight / weight.sum(),
            "ratio": (np.array(ratio).T / weight).astype(np.float32)}


def predict(docs: DataFrame, model: dict, text: str = "text", carry: list[str] | None = None,
            ambiguous: float = AMBIGUOUS) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

    A text that is null or has no letter gets ``und``, score 0 and is not
    ambiguous; so does every text if the model knows no language. Ties go to
    the language first in order. Added columns replace kept ones of the same
    name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def maker():
        m = shared.value
        languages = m["languages"]

        def work(texts: pa.Array):
            lang, score, close = [], [], []
            for rows, data, offsets in W.byte_blocks(texts, STEP_BYTES):
                letters = _lettered(data, offsets)
                if not languages or not letters.any():
                    lang += [UNKNOWN] * len(rows)
                    score.append(np.zeros(len(rows)))
                    close.append(np.zeros(len(rows), bool))
                    continue
                best, sure, near = _decode(m, _margins(m, data, offsets), ambiguous)
                lang += [languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
                score.append(np.where(letters, sure, 0.0))
                close.append(letters & near)
            return {"lang_pred": lang, "score": np.concatenate(score) if score else [],
                    "ambiguous": np.concatenate(close) if close else []}
        return work
    return map_texts(docs, text, carry, "lang_pred string, score double, ambiguous boolean", maker)


def _lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows hold a letter of any script."""
    seen = np.append(0, np.cumsum(_ASCII_LETTER[data]))
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    wide = np.append(0, np.cumsum(data >= 0x80))
    for i in np.flatnonzero(~out & (wide[offsets[1:]] > wide[offsets[:-1]])):
        out[i] = any(map(str.isalpha, data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")))
    return out


def _margins(m: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean bit margins over the trigrams that end in a letter or after one; a long text goes in steps."""
    total = np.zeros((len(offsets) - 1, m["code"].shape[1]))
    used = np.zeros(len(offsets) - 1)
    gram, folded = _grams(data, offsets, m["buckets"])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero((folded != 32) | (np.append(np.uint32(32), folded[:-1]) != 32))
    for low in range(0, len(at), STEP_BYTES):
        part = at[low:low + STEP_BYTES]
        first = np.flatnonzero(np.append(True, row[part][1:] != row[part][:-1]))
        total[row[part][first]] += np.add.reduceat(m["ratio"][gram[part]], first, axis=0)
        used += np.bincount(row[part], minlength=len(used))
    return total / np.maximum(used, 1)[:, None]


def _decode(m: dict, margin: np.ndarray, ambiguous: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best codeword by weighted loss, its certainty, and whether the second is close."""
    loss = np.logaddexp(0, -2 * margin[:, None, :] * m["code"][None, :, :]) @ m["weight"]
    best = loss.argmin(axis=1)
    odds = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
    sure = odds[np.arange(len(best)), best] / odds.sum(axis=1)
    two = np.sort(loss, axis=1)[:, :2]
    near = two[:, 1] - two[:, 0] < ambiguous if loss.shape[1] > 1 else np.zeros(len(best), bool)
    return best, sure, near
