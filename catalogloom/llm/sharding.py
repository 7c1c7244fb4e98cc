"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Rows have a home partition. How many rows each partition sends to each shard is
drawn first: a multivariate hypergeometric matrix whose row sums are the
partition sizes and whose column sums are the shard sizes. Then every partition
permutes its rows and deals them by its matrix row, the rows are exchanged, and
every shard permutes what it received. Any order of all rows is equally likely,
and shard sizes differ by one at most.

Only the matrix (at most ``MAX_HOMES`` rows of counts) is drawn on the driver;
rows are handled by DataFrame functions alone. All randomness comes from hashes
of the seed and the row, so a lost task repeats what it did.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows aimed at in a home partition, and the bound of the matrix.
HOME_ROWS = 100_000
MAX_HOMES = 16_384
#: Rows aimed at in a bucket of the second permutation.
BUCKET_ROWS = 4_096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good + bad`` are good; sound for populations of any size."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mean = draws * (good / total)
    spread = max(1.0, (mean * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5)
    low, high = max(low, int(mean - 12 * spread) - 8), min(high, int(mean + 12 * spread) + 8)
    x = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - x) + np.log(draws - x) - np.log(x + 1) - np.log(bad - draws + x + 1)
    weight = np.append(0.0, np.cumsum(ratio))
    mass = np.cumsum(np.exp(weight - weight.max()))
    return low + min(int(np.searchsorted(mass, rng.random() * mass[-1], side="right")), high - low)


def communication_matrix(homes: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Counts from each home partition to each shard, with the given row and column sums."""
    rng, left, matrix = np.random.default_rng(seed), list(sizes), []
    for count in homes:
        row, rest, population = [], count, sum(left)
        for capacity in left[:-1]:
            sent = hypergeometric(rng, capacity, population - capacity, rest) if rest else 0
            row.append(sent)
            rest -= sent
            population -= capacity
        row.append(rest)
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def _random(seed: int, *parts: Column) -> Column:
    return F.xxhash64(F.lit(seed), *parts)


def shuffle(rows: DataFrame, shards: int, identity: list[str], seed: int = 17) -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard).

    ``identity`` names the columns that tell rows apart; rows equal in all of
    them are interchangeable. Nulls are values like others. Shard sizes differ
    by one at most, also with fewer rows than shards; an empty table stays
    empty. Existing columns named ``shard`` or ``slot`` are replaced.
    """
    spark = rows.sparkSession
    own = [c for c in rows.columns if c not in ("shard", "slot")]
    keys = [F.col(c) for c in identity]
    n = rows.count()
    homes = min(MAX_HOMES, max(shards, -(-n // HOME_ROWS)))
    at_home = rows.select(*own, F.pmod(_random(seed, *keys), F.lit(homes)).cast("int").alias("__home"))
    counts = dict(at_home.groupBy("__home").count().collect())
    n = sum(counts.values())
    sizes = [n // shards + (s < n % shards) for s in range(shards)]
    matrix = communication_matrix([counts.get(h, 0) for h in range(homes)], sizes, seed)
    dealt = json.dumps(np.cumsum(np.array(matrix, dtype=np.int64).reshape(homes, shards), axis=1).tolist())
    table = F.broadcast(spark.range(1).select(
        F.posexplode(F.from_json(F.lit(dealt), "array<array<bigint>>")).alias("__home", "__upto")))

    order = [_random(seed + 1, *keys), *keys]
    permuted = at_home.withColumn("__rank", F.row_number().over(Window.partitionBy("__home").orderBy(*order)))
    sent = permuted.join(table, "__home").select(
        *own, F.size(F.filter("__upto", lambda c: c < F.col("__rank"))).alias("shard"))

    buckets = max(1, -(-n // (shards * BUCKET_ROWS)))
    again = _random(seed + 2, F.col("shard"), *keys)
    inner = Window.partitionBy("shard", "__bucket")
    received = sent.withColumn("__bucket", F.pmod(again, F.lit(buckets)).cast("int")).select(
        "*", F.row_number().over(inner.orderBy(_random(seed + 3, *keys), *keys)).alias("__place"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = received.groupBy("shard", "__bucket").agg(F.max("__place").cast("long").alias("__n")).select(
        "shard", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return received.join(offsets, ["shard", "__bucket"]).select(
        *own, "shard", (F.col("__offset") + F.col("__place") - 1).alias("slot"))
