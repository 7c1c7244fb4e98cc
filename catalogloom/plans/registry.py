"""Named queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


# SQL counts, positions and lengths are wider than the engine's; the same values
# are compared at the engine's width.
WIDTHS = {
    "src1_read_pages": {"characters": "bigint"}, "src3_explode_playlist": {"position": "int"},
    "src4_embedded_parts": {"position": "int"}, "ext2_links_from_text": {"pos": "int"},
    "ext2_links_from_nodes": {"pos": "int"}, "ext4_link_kinds": {"rank": "int"},
    "agg2_first_distinct_labels": {"pos": "int"}, "ext7_labelled_lines": {"label_seq": "int"},
    "win4_event_segments": {"segment": "bigint"}, "srt3_top_parts_per_brand": {"rank": "int"},
    "src6_record_digests": {"bytes": "int"}, "str10_overlap_audit": {"seen": "int", "stored": "int"},
    "udx1_links_by_source_spec": {"rank": "int"}, "str1_streamed_links": {"pos": "int"},
    "cln1_clean_documents": {"characters": "int"}, "jn7_passages_in_documents": {"shared": "int", "words": "int"},
    "flt5_release_metadata": {"no": "int"}, "set3_token_sets": {"shared": "int", "united": "int"},
    "srt3_truncated_text": {"message": "int", "whole": "int"},
}


def sized_sql() -> dict[str, str]:
    """All SQL with result columns at the engine's integer widths."""
    out = dict(SQL)
    for name, columns in WIDTHS.items():
        casts = ", ".join(f"{column}::{kind} as {column}" for column, kind in columns.items())
        out[name] = f"select * replace ({casts}) from ({SQL[name]}) t"
    return out


def query(name: str, sql: str | None = None) -> Callable[[Callable[["Tables"], DataFrame]], Query]:
    """Register ``fn(tables)`` under a name, with equivalent SQL when there is one."""
    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, sf_dir))
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return register


class Tables:
    """The given tables, read lazily as Parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"
