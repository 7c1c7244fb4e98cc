"""Blocks of numbered lines on keys of any length (WIN4): an automaton run as a scan over chunks.

A heading opens the block of a key; the first numbered line after it starts the
list, and the first other line after that ends it. A numbered line that opens
a list of its own hides what follows until that list is closed. Where a line
stands in this is a state (phase and hidden depth), so lines cannot be judged
alone. But what a whole chunk of lines does to any state is a small table.
Chunks are order statistics, each reduced to its table by one task; the tables
of a key (at most ``MOST_CHUNKS``) are applied in order, which gives the state
before every chunk; then each chunk runs once more from its state.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import chunk_between, order_borders

IDLE, OPEN, INSIDE, CLOSED = range(4)
BLANK, OTHER, HEADING, NUMBERED = range(4)
#: The phase after a visible line, by its kind and the phase before.
_NEXT = {
    BLANK: (IDLE, OPEN, INSIDE, CLOSED), OTHER: (IDLE, OPEN, CLOSED, CLOSED),
    HEADING: (OPEN, OPEN, INSIDE, CLOSED), NUMBERED: (IDLE, INSIDE, INSIDE, CLOSED)}
_TABLE = "_cell string, balance int, depths array<int>, phases array<array<int>>"


class _Effect:
    """What the lines read so far do to a state: for each depth before, the depth after and the phase after each phase.

    A depth beyond the table has been hidden throughout, and only changes by ``balance``.
    """

    def __init__(self):
        self.balance, self.depths, self.phases = 0, [0], [(IDLE, OPEN, INSIDE, CLOSED)]

    def read(self, kind: int, change: int, parent: bool) -> None:
        after = _NEXT[kind]
        for k, depth in enumerate(self.depths):
            if depth:
                self.depths[k] = max(0, depth + change)
            else:
                self.phases[k] = tuple([after[p] for p in self.phases[k]])
                if parent:
                    self.depths[k] = max(0, change)
        self.balance += change
        while len(self.depths) <= -self.balance:
            self.depths.append(0)
            self.phases.append((IDLE, OPEN, INSIDE, CLOSED))


def _lines(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _effects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per cell from rows (cell, kind, change, parent) in order."""
    done: list[tuple[str, _Effect]] = []

    def rows() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([
            pa.array([c for c, _ in done], pa.string()), pa.array([e.balance for _, e in done], pa.int32()),
            pa.array([e.depths for _, e in done], pa.list_(pa.int32())),
            pa.array([[list(p) for p in e.phases] for _, e in done], pa.list_(pa.list_(pa.int32())))],
            names=["_cell", "balance", "depths", "phases"])
        done.clear()
        return made
    at, effect = None, None
    for cell, kind, change, parent in _lines(batches):
        if cell != at:
            if effect is not None:
                done.append((at, effect))
            if len(done) >= 1000:
                yield rows()
            at, effect = cell, _Effect()
        effect.read(kind, change, parent)
    if effect is not None:
        done.append((at, effect))
        yield rows()


def _marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``_in`` (a numbered line of the block) and ``_hidden`` to rows that begin with cell, kind, change, parent, depth, phase."""
    at, depth, phase = None, 0, IDLE
    for batch in batches:
        inside, hidden = [], []
        for cell, kind, change, parent, first_depth, first_phase in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if cell != at:
                at, depth, phase = cell, first_depth, first_phase
            hidden.append(depth > 0)
            inside.append(not depth and kind == NUMBERED and phase in (OPEN, INSIDE))
            if depth:
                depth = max(0, depth + change)
            else:
                phase = _NEXT[kind][phase]
                if parent:
                    depth = max(0, change)
        yield pa.RecordBatch.from_arrays([*batch.columns[6:], pa.array(inside, pa.bool_()), pa.array(hidden, pa.bool_())],
                                         names=[*batch.schema.names[6:], "_in", "_hidden"])


def scan_blocks(lines: DataFrame, keys: Sequence[str], order: Sequence[Column], heading: Column, number: Column,
                opens: Column | None = None, closes: Column | None = None, blank: Column | None = None) -> DataFrame:
    """The visible numbered lines of each key's block, with ``number``.

    ``number`` is null for other lines; a heading is never a numbered line.
    ``opens`` and ``closes`` count the lists that a line opens and closes;
    closing more than is open is ignored. ``blank`` lines change nothing. Keys
    may be null and of any length, and ``order`` must tell the lines of a key
    apart. A key without a heading has no block, and a block may stay open.
    """
    zero, no = F.lit(0), F.lit(False)
    kind = (F.when(F.coalesce(blank, no) if blank is not None else no, BLANK).when(F.coalesce(heading, no), HEADING)
            .when(number.isNotNull(), NUMBERED).otherwise(OTHER))
    opened = F.coalesce(opens, zero).cast("int") if opens is not None else zero
    change = opened - (F.coalesce(closes, zero).cast("int") if closes is not None else zero)
    place = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
    staged = lines.withColumns({
        "_kind": kind, "_change": change, "_parent": (opened > 0) & number.isNotNull() & ~F.coalesce(heading, no),
        "_number": number, "_place": place, "_key": F.struct(*keys) if keys else F.struct(F.lit(0).alias("_"))})
    borders = order_borders(lines, order)
    cell = F.md5(F.to_json(F.struct("_key", "_chunk"), {"ignoreNullFields": "false"}).cast("binary"))
    chunked = staged.withColumn("_chunk", chunk_between(F.col("_place"), borders)).withColumn("_cell", cell)
    cells = chunked.groupBy("_key", "_chunk").agg(F.first("_cell").alias("_cell"))
    in_order = ["_cell", "_place"]
    effects = chunked.repartition("_cell").sortWithinPartitions(*in_order).select(
        "_cell", "_kind", "_change", "_parent").mapInArrow(_effects, _TABLE)
    tables = cells.join(effects, "_cell").groupBy("_key").agg(F.sort_array(F.collect_list(
        F.struct("_chunk", "_cell", "balance", "depths", "phases"))).alias("_tables"))
    known = "s.depth < size(t.depths)"
    states = tables.select(F.explode(F.expr(f"""aggregate(_tables,
        named_struct('depth', 0, 'phase', 0, 'before', cast(array() as array<struct<_cell:string,_depth:int,_phase:int>>)),
        (s, t) -> named_struct(
            'depth', if({known}, t.depths[s.depth], s.depth + t.balance), 'phase', if({known}, t.phases[s.depth][s.phase], s.phase),
            'before', array_append(s.before, named_struct('_cell', t._cell, '_depth', s.depth, '_phase', s.phase))),
        s -> s.before)""")).alias("_s")).select("_s.*")
    # The join may split a large cell over tasks, and a shuffle by the join's own key would be left out as done.
    ready = chunked.join(states, "_cell").repartition("_cell", "_chunk").sortWithinPartitions(*in_order).select(
        "_cell", "_kind", "_change", "_parent", "_depth", "_phase", *[F.col(c).alias(f"c_{i}") for i, c in enumerate(lines.columns)],
        F.col("_number").alias("c_number"))
    fields = [f"c_{i} {f.dataType.simpleString()}" for i, f in enumerate(lines.schema)]
    fields += [f"c_number {ready.schema['c_number'].dataType.simpleString()}", "_in boolean", "_hidden boolean"]
    marked = ready.mapInArrow(_marks, ", ".join(fields))
    kept = [c for c in lines.columns if c != "number"]
    return marked.where("_in").select(*[F.col(f"c_{lines.columns.index(c)}").alias(c) for c in kept], F.col("c_number").alias("number"))
