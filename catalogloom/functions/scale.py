"""Grouping and ordering helpers that hold when one key owns a third of the rows.

Nothing here sorts or collects a whole group in one task:

* the first row of a group is an aggregate (``min_by``), so map-side partial
  results shrink a hot group before the shuffle;
* running totals are computed per (key, chunk) and the totals of earlier chunks
  of the same key are added as an offset, so the largest sort is one chunk;
  chunks are order statistics of the rows, so each has about as many of them;
* bounded top-N uses ``row_number() <= n``, which Spark turns into a partial
  ``WindowGroupLimit`` below the exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

LITERAL_ROWS_LIMIT = 2_000


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A rule table written in code; marked for broadcast while it is small, else Spark chooses the join."""
    table = spark.createDataFrame(list(rows), schema)
    return F.broadcast(table) if len(rows) <= LITERAL_ROWS_LIMIT else table


def once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """New columns that are computed once a row, however often later steps name them.

    A filter or join condition on a plain column is moved below it with a copy
    of its whole expression for each mention; it is not moved below a generator.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    rows = df.select("*", F.explode(F.array(made)).alias("_once"))
    return rows.select("*", *[F.col(f"_once.{name}").alias(name) for name in columns]).drop("_once")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the smallest by ``order``. Partial aggregation, no window."""
    payload = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("_first"))
    return picked.select(*keys, "_first.*")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
          rank: str | None = None) -> DataFrame:
    """At most ``n`` rows per key; the limit is applied below the exchange too."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


#: Chunks at most, and rows of the sample on which the borders of one rest.
MOST_CHUNKS, SAMPLED = 512, 64


def _literal(value, kind: T.DataType) -> Column:
    """A collected value as a literal of its type."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    return F.lit(value).cast(kind)


def order_borders(df: DataFrame, order: Sequence[Column], chunks: int | None = None) -> list[Column]:
    """Literals that cut the rows of ``df``, in ascending order of ``order``, into parts of about equal size.

    They are order statistics of a random sample of ``SAMPLED`` rows a chunk,
    gathered by one aggregate over at most ``MOST_CHUNKS * SAMPLED`` narrow
    rows. The cut is exact for any borders; the sample only evens the sizes.
    """
    if chunks is None:
        chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, min(MOST_CHUNKS, chunks))
    narrow = df.select(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)]).alias("_place"))
    share = SAMPLED * chunks / max(1, narrow.count())
    picked = narrow.where(F.rand(17) < share) if share < 1 else narrow
    every = F.sort_array(F.collect_list("_place"))
    found = picked.agg(every.alias("_all")).select(F.expr(
        f"transform(sequence(1, {chunks}), i -> get(_all, cast(floor(i * size(_all) / {chunks}D) as int)))").alias("_all")).first()[0]
    kind = narrow.schema["_place"].dataType
    distinct = [x for i, x in enumerate(found) if x is not None and (i == 0 or x != found[i - 1])]
    return [_literal(x, kind) for x in distinct]


def chunk_between(place: Column, borders: Sequence[Column]) -> Column:
    """How many of the ascending ``borders`` are not above ``place``: a balanced tree of comparisons."""
    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(place < borders[middle], below(low, middle)).otherwise(below(middle + 1, high))
    return below(0, len(borders))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Mapping[str, Column],
                   totals: Mapping[str, str] | None = None, chunk: Column | str | None = None) -> DataFrame:
    """Inclusive running sums per key, in two levels.

    Rows are cut into chunks by order statistics of ``order`` (ascending), so a
    chunk holds about as many rows as any other, whatever values are common;
    only rows equal in the whole of ``order`` stay together. A caller that
    knows a good non-decreasing function of ``order`` (a line number range), or
    has it as a column, may name it as ``chunk`` and spares the sample. Level one sums each
    (key, chunk) with map-side combine; level two adds the sums of the key's
    earlier chunks. Rows are shuffled once, by (key, chunk), so a hot key
    spreads over as many tasks as it has chunks.

    ``totals`` maps a new column to the name in ``sums`` whose whole-key total
    it should carry. A null key or chunk is a value like others: rows meet in
    a struct of key and chunk, in which nulls are equal.
    """
    if chunk is None:
        borders = order_borders(df, order)
        place = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
        placed = df.withColumn("_place", place)
        chunked = placed.withColumn("_chunk_no", chunk_between(F.col("_place"), borders)).drop("_place")
        return running_totals(chunked, keys, order, sums, totals, "_chunk_no").drop("_chunk_no")
    keys = list(keys)
    named = isinstance(chunk, str)
    c = chunk if named else "_chunk"
    base = (df if named else df.withColumn(c, chunk)).withColumn("_cell", F.struct(*keys, c))
    per_chunk = base.groupBy("_cell").agg(*[F.sum(expr).alias(f"_sum_{name}") for name, expr in sums.items()])
    whole = Window.partitionBy(*([F.col("_cell")[k] for k in keys] or [F.lit(0)]))
    earlier = whole.orderBy(F.col("_cell")[c]).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(
        "_cell",
        *[F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}")
          for name in sums],
        *[F.sum(f"_sum_{name}").over(whole).alias(new) for new, name in (totals or {}).items()])
    inside = (Window.partitionBy("_cell").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The sums inside a chunk come first: their order serves the join as well, so a task sorts its rows once.
    within = base.select("*", *[F.sum(expr).over(inside).alias(f"_inside_{name}") for name, expr in sums.items()])
    joined = within.join(carried, "_cell", "left")
    out = joined.select("*", *[
        (F.coalesce(F.col(f"_before_{name}"), F.lit(0)) + F.coalesce(F.col(f"_inside_{name}"), F.lit(0)))
        .alias(name) for name in sums])
    return out.drop("_cell", *([] if named else [c]), *[f"{kind}_{name}" for name in sums for kind in ("_before", "_inside")])


def ordered_text(value: str, order: str, sep: str = " ") -> Column:
    """Concatenate a bounded group in order."""
    return F.expr(f"listagg({value}, '{sep}') within group (order by {order})")
