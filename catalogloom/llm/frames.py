"""Running a batch function over documents, with the columns that stay."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Makes the function of one task, so that what it holds is built once a task.
Maker = Callable[[], Callable[[pa.Array], dict[str, object]]]


def map_texts(docs: DataFrame, text: str, carry: Sequence[str] | None, fields: str, maker: Maker,
              kind: str = "string") -> DataFrame:
    """``docs`` with new columns computed from a text column (or one of another ``kind``), batch by batch.

    ``carry`` names the columns to keep (all when None). A new column replaces
    a kept one of the same name. Rows keep their partition and their order, so
    repeated rows stay separate rows.
    """
    new = T._parse_datatype_string(fields)
    names = [f.name for f in new.fields]
    kept = [c for c in (docs.columns if carry is None else carry) if c not in names]
    schema = T.StructType([docs.schema[c] for c in kept] + list(new.fields))
    arrow = to_arrow_schema(new)
    source = docs.select(docs[text].cast(kind).alias("_0"), *[docs[c].alias(f"_{i + 1}") for i, c in enumerate(kept)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = maker()
        for batch in batches:
            made = work(batch.column(0))
            columns = [batch.column(i + 1) for i in range(len(kept))]
            columns += [v if isinstance(v := made[f.name], pa.Array) else pa.array(v, f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, names=kept + names)

    return source.mapInArrow(run, schema)
