"""Quality scores from weak labels.

Overlapping heuristics vote good, bad or nothing on every document.
Expectation-maximisation estimates how often each heuristic is right from how
they agree: the counts of vote patterns over all documents are enough for it,
and there are at most 3^9 patterns. Every pattern then has a posterior, and
these soft labels train a hashed linear scorer: weights are log-ratios of
posterior-weighted feature counts over all documents, added up in one pass.

No human label is used; the labels table only serves to measure.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogloom.llm import words as W
from catalogloom.llm.frames import map_texts

#: name, good up to / bad from (or good from / bad up to when the order is reversed).
HEURISTICS = [
    ("letters", 0.76, 0.70), ("capitals", 0.10, 0.30), ("echoes", 0.04, 0.15), ("symbols", 0.02, 0.10),
    ("marked", 0.03, 0.20), ("short", 0.12, 0.04), ("length", 9.0, 13.0), ("nearby", 0.12, 0.30), ("marks", 0.05, 0.08),
]
#: Bounds of the share of good votes on good and on bad documents: a heuristic seldom blames a good one, and sees some
#: kinds of fault only. Without them the two classes can settle on one kind of fault against all else.
GOOD_RATE = (0.97, 0.999)
BAD_RATE = (0.5, 0.95)
BUCKETS = 1 << 16
STEP_BYTES = 1 << 20
ROUNDS = 100
#: Words from which on the heuristics vote, and how many times worse it is to drop a good document than to keep a bad one.
LEAST_WORDS = 12
DROP_COST = 10

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES < 91)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES < 123)) | (_BYTES >= 128)
_MARK = (_BYTES > 32) & (_BYTES < 128) & ~_LETTER & ~((_BYTES >= 48) & (_BYTES < 58))
_CLASS = (_UPPER * 1 + (_LETTER & ~_UPPER) * 2 + _MARK * 3).astype(np.int64)


def _per_word(b: W.Block) -> dict[str, np.ndarray]:
    """What the heuristics and word features look at, per word."""
    size = b.ends - b.starts
    count = lambda flag: (lambda c: c[b.ends] - c[b.starts])(np.append(0, np.cumsum(flag[b.data])))
    echo = np.zeros(len(b.words), bool)
    echo[1:] = b.words[1:] == b.words[:-1]
    inner = b.first[:-1][b.first[:-1] < len(b.words)]
    echo[inner] = False
    near = echo.copy()
    row = b.row_of_word()
    for back in (2, 3, 4):
        near[back:] |= (b.words[back:] == b.words[:-back]) & (row[back:] == row[:-back])
    letters = count(_LETTER)
    before = np.maximum(b.ends - 2, b.starts)
    return {"size": size, "letters": letters, "capitals": count(_UPPER), "echo": echo, "near": near,
            "marks": count(_MARK), "symbol": letters == 0,
            "marked": (size > 2) & _MARK[b.data[b.ends - 1]] & _MARK[b.data[before]], "short": size <= 3}


def votes(b: W.Block, seen: dict[str, np.ndarray]) -> np.ndarray:
    """Rows by heuristics: 1 good, 0 bad, -1 no vote; a row of very few words has no votes."""
    total = lambda x: (lambda c: c[b.first[1:]] - c[b.first[:-1]])(np.append(0, np.cumsum(x)))
    n = np.maximum(np.diff(b.first), 1)
    size = np.maximum(total(seen["size"]), 1)
    letters = total(seen["letters"])
    value = {"letters": letters / np.maximum(size + n - 1, 1), "capitals": total(seen["capitals"]) / np.maximum(letters, 1),
             "echoes": total(seen["echo"]) / n, "symbols": total(seen["symbol"]) / n, "marked": total(seen["marked"]) / n,
             "short": total(seen["short"]) / n, "length": size / n, "nearby": total(seen["near"]) / n,
             "marks": total(seen["marks"]) / size}
    out = np.full((len(b.rows), len(HEURISTICS)), -1, np.int64)
    for j, (name, good, bad) in enumerate(HEURISTICS):
        sign = 1 if good < bad else -1
        out[sign * value[name] <= sign * good, j] = 1
        out[sign * value[name] >= sign * bad, j] = 0
    out[np.diff(b.first) < LEAST_WORDS] = -1
    return out


def _pattern(vote: np.ndarray) -> np.ndarray:
    return (vote + 1) @ (3 ** np.arange(vote.shape[1]))


def _features(b: W.Block, seen: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and rows of byte trigrams, and of word shapes."""
    data = b.data.astype(np.uint32)
    gram = (data[2:] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA77)) ^ (data[:-2] * np.uint32(0xC2B2AE3D))
    gram ^= gram >> np.uint32(15)
    gram *= np.uint32(0x2C1B3C6D)
    row = np.repeat(np.arange(len(b.rows)), np.diff(b.offsets))
    inside = row[2:] == row[:-2] if len(row) > 2 else np.zeros(0, bool)
    shape = np.minimum(seen["size"], 15) * 4 + _CLASS[b.data[b.starts]]
    shape = (shape * 4 + _CLASS[b.data[b.ends - 1]]) * 2 + seen["echo"]
    shape = (shape * 2 + seen["marked"]) * 2 + (seen["capitals"] == seen["letters"])
    mixed = (W.mix(shape.astype(np.uint64)) >> np.uint64(48)).astype(np.int64)
    return (gram[inside] >> np.uint32(16)).astype(np.int64), row[2:][inside], mixed, b.row_of_word()


def agreement(patterns: dict[int, int]) -> dict:
    """Accuracies by expectation-maximisation over vote pattern counts, and each pattern's posterior."""
    keys = np.array(sorted(patterns), np.int64)
    weight = np.array([patterns[k] for k in keys.tolist()], float)
    vote = (keys[:, None] // 3 ** np.arange(len(HEURISTICS))) % 3 - 1
    cast = vote >= 0
    # Faults are of different kinds, so a bad document is bad to few heuristics: one such vote is the first guess.
    good = np.where((vote == 0).any(axis=1), 0.1, np.where(cast.any(axis=1), 0.9, 0.5))
    for _ in range(ROUNDS):
        chance = float((weight * good).sum() + 1) / (weight.sum() + 2)
        rate = []
        for side, bounds in ((good, GOOD_RATE), (1 - good, BAD_RATE)):
            w = (weight * side)[:, None]
            rate.append(np.clip(((w * (vote == 1)).sum(axis=0) + 1) / ((w * cast).sum(axis=0) + 2), *bounds))
        likely = [np.log(c) + (np.where(vote == 1, np.log(r), np.log(1 - r)) * cast).sum(axis=1)
                  for c, r in ((chance, rate[0]), (1 - chance, rate[1]))]
        good = 1 / (1 + np.exp(np.clip(likely[1] - likely[0], -500, 500)))
    return {"prior": chance, "good_if_good": rate[0].tolist(), "good_if_bad": rate[1].tolist(),
            "posterior": dict(zip(keys.tolist(), good.tolist()))}


def train(docs: DataFrame, text: str = "text") -> dict:
    """A model from texts alone; all documents count. An empty table gives a model that scores 0.5."""
    body = docs.select(docs[text].cast("string").alias("body"))

    def vote_maker():
        def work(texts: pa.Array):
            found = [_pattern(votes(b, _per_word(b))) if len(b.words) else np.zeros(len(b.rows), np.int64)
                     for b in W.word_blocks(texts, limit=STEP_BYTES)]
            return {"pattern": np.concatenate(found) if found else np.zeros(0, np.int64)}
        return work
    counted = map_texts(body, "body", [], "pattern long", vote_maker).groupBy("pattern").count().collect()
    model = agreement({r["pattern"]: r["count"] for r in counted if r["pattern"]})
    shared = docs.sparkSession.sparkContext.broadcast(model["posterior"])

    def run(batches):
        posterior = shared.value
        sums = np.zeros((4, BUCKETS))
        for batch in batches:
            for b in W.word_blocks(batch.column(0), limit=STEP_BYTES):
                if not len(b.words):
                    continue
                seen = _per_word(b)
                good = np.array([posterior.get(k, 0.5) for k in _pattern(votes(b, seen)).tolist()])
                gram, gram_row, shape, shape_row = _features(b, seen)
                for k, (bucket, row) in enumerate(((gram, gram_row), (shape, shape_row))):
                    sums[2 * k] += np.bincount(bucket, good[row], BUCKETS)
                    sums[2 * k + 1] += np.bincount(bucket, 1 - good[row], BUCKETS)
        cell = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(sums.ravel()[cell])], names=["cell", "total"])

    found = body.mapInArrow(run, "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    sums = np.zeros(4 * BUCKETS)
    sums[found["cell"].to_numpy()] = found["total"].to_numpy()
    sums = sums.reshape(4, BUCKETS) + 0.5
    share = sums / sums.sum(axis=1, keepdims=True)
    ratio = [np.log(share[2 * k] / share[2 * k + 1]) for k in (0, 1)]
    middle = [float((share[2 * k] @ r + share[2 * k + 1] @ r) / 2) for k, r in enumerate(ratio)]
    spread = [max(1e-6, float((share[2 * k] - share[2 * k + 1]) @ r) / 2) for k, r in enumerate(ratio)]
    model["weights"] = [((r - m) / s).astype(np.float32) for r, m, s in zip(ratio, middle, spread)]
    model["threshold"] = _threshold(score(body, model, "body", []))
    return model


def _threshold(scored: DataFrame) -> float:
    """The score, in steps of 1/200, that errs least against the soft labels."""
    steps = 200
    bins = scored.where("weak_label is not null").groupBy(F.least(F.floor(F.col("score") * steps), F.lit(steps - 1)).alias(
        "bin")).agg(F.sum("weak_label").alias("good"), F.sum(1 - F.col("weak_label")).alias("bad")).collect()
    good, bad = np.zeros(steps), np.zeros(steps)
    for r in bins:
        good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
    lost = DROP_COST * np.append(0, np.cumsum(good)) + np.append(np.cumsum(bad[::-1])[::-1], 0)
    return float(lost[:-1].argmin()) / steps if len(bins) else 0.5


def score(docs: DataFrame, model: dict, text: str = "text", carry: list[str] | None = None,
          threshold: float | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``weak_label`` (the heuristics' posterior) and ``kept``.

    ``threshold`` is the model's unless given.

    A null, empty or wordless text scores 0 and is not kept; its weak label is
    null. Added columns replace kept ones of the same name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    least = model.get("threshold", 0.5) if threshold is None else threshold

    def maker():
        m = shared.value

        def work(texts: pa.Array):
            scores, labels, worded = [], [], []
            for b in W.word_blocks(texts, limit=STEP_BYTES):
                n = len(b.rows)
                some = np.diff(b.first) > 0
                worded.append(some)
                if not some.any():
                    scores.append(np.zeros(n))
                    labels += [None] * n
                    continue
                seen = _per_word(b)
                labels += [m["posterior"].get(k, 0.5) if ok else None
                           for k, ok in zip(_pattern(votes(b, seen)).tolist(), some)]
                gram, gram_row, shape, shape_row = _features(b, seen)
                mean = np.zeros(n)
                for weights, bucket, row in zip(m["weights"], (gram, shape), (gram_row, shape_row)):
                    mean += np.bincount(row, weights[bucket], n) / np.maximum(np.bincount(row, minlength=n), 1)
                scores.append(np.where(some, 1 / (1 + np.exp(-2 * mean)), 0.0))
            every = np.concatenate(scores) if scores else np.zeros(0)
            return {"score": every, "weak_label": labels, "kept": (every >= least) & np.concatenate(worded) if worded else []}
        return work
    return map_texts(docs, text, carry, "score double, weak_label double, kept boolean", maker)
