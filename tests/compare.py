"""Compare a registered query with its SQL on DuckDB (order-insensitive, by column name)."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else int(number) if number == int(number) else round(number, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def _widths(df, found) -> str:
    """Columns whose integer widths differ between the two sides (values are equal)."""
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    sql = {d[0]: str(d[1]) for d in found.description}
    odd = [f"{c}:{kind}/{sql[c]}" for c, kind in df.dtypes if kinds.get(kind, kind) != sql[c]]
    return f" [{', '.join(odd)}]" if odd else ""


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    if not sql:
        return True, f"rows-only {len(got)} rows {seconds:.1f}s"
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, found.fetchall())
    if a == b:
        return True, f"{len(got)} rows{_widths(df, found)} {seconds:.1f}s"
    only_a, only_b = list((a - b).items()), list((b - a).items())
    return False, (f"{sum(a.values())} vs {sum(b.values())} rows; {sorted(names)}\n   spark only {len(only_a)}: "
                   f"{str(only_a[:2])[:500]}\n   sql only {len(only_b)}: {str(only_b[:2])[:500]}")


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from catalogloom.session import build_session
    sf = sys.argv[1]
    wanted = sys.argv[2:]
    session = build_session("local[8]", spark_sql_shuffle_partitions=8, spark_driver_memory="12g")
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls, bad = entry.oracle_sql(), 0
    for key, fn in entry.queries().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        try:
            ok, note = compare(session, con, key, fn, sqls.get(key), sf)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + key, note, flush=True)
    print("failed:", bad)
