"""Block scans against a plain sequential reading."""

import random

import pytest
from pyspark.sql import functions as F

from catalogloom.operators.blocks import scan_blocks


def _plain(lines):
    """Rows (key, at, kind, number, opens, closes) in order: numbers of the visible numbered lines of each block."""
    state, out = {}, []
    for key, at, kind, opens, closes in sorted(lines, key=lambda r: r[1]):
        active, seen, over, depth = state.get(key, (False, False, False, 0))
        if depth:
            depth = max(0, depth + opens - closes)
        else:
            if kind == "n" and opens:
                depth = max(0, opens - closes)
            if kind == "h":
                active = active or not over
            elif active and not over:
                if kind == "n":
                    seen = True
                    out.append((key, at))
                elif kind == "o" and seen:
                    over = True
        state[key] = (active, seen, over, depth)
    return out


def _scan(df):
    is_kind = lambda k: F.col("kind") == k
    return scan_blocks(df, ["key"], [F.col("at")], is_kind("h"), F.when(is_kind("n"), F.col("at") * 10), F.col("opens"),
                       F.col("closes"), is_kind("b"))


def _lines(rng, n, keys, other):
    kinds = rng.choices("nbho", [10, 3, 0.02, other], k=n)
    pick = lambda one: rng.choices([0, 1, 2], [20, one, 0.3])[0]
    return [(rng.choice(keys), i, k, pick(2), pick(3)) for i, k in enumerate(kinds)]


@pytest.mark.parametrize("seed", range(4))
def test_short_keys_equal_a_sequential_reading(spark, seed):
    rng = random.Random(seed)
    lines = _lines(rng, 1500, [f"k{i}" for i in range(40)] + [None], 0.2)
    lines = [(k, i, "h" if rng.random() < 0.05 else x, o, c) for k, i, x, o, c in lines]
    df = spark.createDataFrame(lines, "key string, at int, kind string, opens int, closes int").withColumn("number", F.lit("clash"))
    got = _scan(df.repartition(5)).collect()
    assert sorted((str(r.key), r.at) for r in got) == sorted((str(k), a) for k, a in _plain(lines)) and got
    assert all(r.number == r.at * 10 for r in got)


def test_one_key_of_many_lines_spreads_over_tasks(spark):
    """Nested depth included: lists opened in one chunk are closed many chunks later."""
    rng = random.Random(9)
    lines = [("one", 0, "h", 0, 0)] + [("one", i + 1, k, o, c) for _, i, k, o, c in _lines(rng, 200_000, ["one"], 0.00001)]
    lines += [("none", i, "n", 0, 0) for i in range(300_000, 300_050)]
    lines[50_000] = ("one", lines[50_000][1], "n", 3000, 0)
    rows = spark.sparkContext.parallelize(lines, 16)
    df = spark.createDataFrame(rows, "key string, at int, kind string, opens int, closes int")
    got = sorted((r.key, r.at) for r in _scan(df).select("key", "at").collect())
    assert got == sorted(_plain(lines)) and len(got) > 1000


def test_empty_and_headless_tables(spark):
    schema = "key string, at int, kind string, opens int, closes int"
    assert _scan(spark.createDataFrame([], schema)).count() == 0
    assert _scan(spark.createDataFrame([("a", 1, "n", None, None), ("a", 2, None, 1, 1)], schema)).count() == 0
    assert [r.number for r in _scan(spark.createDataFrame([("a", 2, "n", None, None), ("a", 1, "h", 1, 0)], schema)).collect()] == [20]
