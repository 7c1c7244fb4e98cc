"""The published feed: canonical text, digests, bundles and verification (SRC6, SRC7, AGG6, AGG7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_VERSION = "catalog.feed/v1"
MANIFEST_VERSION = "catalog.feed-manifest/v1"
#: Hex digits that digests of one bucket share, level by level.
DIGEST_LEVELS = (8, 4)


def _sorted_value(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        inner = F.struct(*[_sorted_value(col[f.name], f.dataType).alias(f.name)
                           for f in sorted(dtype.fields, key=lambda f: f.name)])
        return F.when(col.isNotNull(), inner)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return F.transform(col, lambda x: _sorted_value(x, dtype.elementType))
    return col


def canonical_json(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """One JSON text per row: keys sorted at every level, compact, nulls kept."""
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    body = F.struct(*[_sorted_value(F.col(f.name), f.dataType).alias(f.name)
                      for f in sorted(fields, key=lambda f: f.name)])
    return F.to_json(body, {"ignoreNullFields": "false"})


def record_digests(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    return df.select(*keys, canonical_json(df, cols).alias("body")).withColumn(
        "sha256", F.sha2(F.col("body").cast("binary"), 256))


def run_digest(digests: DataFrame, keys: Sequence[str] = (), digest: str = "sha256", body: str = "body",
               levels: Sequence[int] = DIGEST_LEVELS) -> DataFrame:
    """One digest per run, independent of partitioning and row order.

    Equal digests are counted (map-side); the distinct ones are hashed in order
    in buckets of their first hex digits, the bucket digests in wider buckets,
    and those of the run last. With 16^8 buckets below 16^4, a task hashes some
    dozens of lines at 10^11 records, and 65,536 at each higher step.
    """
    keys = list(keys)
    counted = digests.groupBy(*keys, digest).agg(
        F.count("*").alias("_n"), F.sum(F.octet_length(body) + 1).alias("_bytes"))
    line = F.concat_ws(":", digest, F.col("_n").cast("string"))
    level = counted.select(*keys, F.col(digest).alias("_at"), line.alias("_line"), "_n", "_bytes")
    for prefix in levels:
        level = level.withColumn("_at", F.substring("_at", 1, prefix)).groupBy(*keys, "_at").agg(
            F.sha2(F.expr("listagg(_line, '\n') within group (order by _line)").cast("binary"), 256).alias("_line"),
            F.sum("_n").alias("_n"), F.sum("_bytes").alias("_bytes"))
    return level.groupBy(*keys).agg(
        F.sha2(F.expr("listagg(_line, '\n') within group (order by _line)").cast("binary"), 256).alias("sha256"),
        F.sum("_n").alias("records"), F.sum("_bytes").alias("bytes"))


FEED_PARTS = ("records", "tombstones", "rejects")


def feed_id(source: Column, run_id: Column) -> Column:
    return F.concat_ws(":", source, run_id)


def write_feed_bundle(path: str, run_id: str, source: str, records: DataFrame, tombstones: DataFrame,
                      rejects: DataFrame) -> DataFrame:
    """Write one run: canonical JSON lines per part, then the manifest.

    Every executor writes its own partitions; the manifest is written last, so a
    bundle without one is not published. Re-running a run overwrites it.
    """
    spark = records.sparkSession
    for name, frame in zip(FEED_PARTS, (records, tombstones, rejects)):
        frame.select(canonical_json(frame).alias("value")).write.mode("overwrite").text(f"{path}/run_id={run_id}/{name}")
    manifest = bundle_digest(spark, path, run_id).select(
        F.lit(MANIFEST_VERSION).alias("schema_version"), feed_id(F.lit(source), F.lit(run_id)).alias("feed_id"),
        F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), "part", "records", "sha256", "bytes",
        F.current_timestamp().alias("generated_at"))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/run_id={run_id}/manifest")
    return spark.read.parquet(f"{path}/run_id={run_id}/manifest")


def bundle_digest(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Digest, row count and bytes of each part as stored."""
    stored = None
    for name in FEED_PARTS:
        lines = spark.read.text(f"{path}/run_id={run_id}/{name}").select(F.lit(name).alias("part"), "value")
        stored = lines if stored is None else stored.unionByName(lines)
    digests = stored.select("part", F.col("value").alias("body"),
                            F.sha2(F.col("value").cast("binary"), 256).alias("sha256"))
    found = run_digest(digests, ["part"])
    every = spark.createDataFrame([(n,) for n in FEED_PARTS], "part string")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return every.join(found, "part", "left").select(
        "part", F.coalesce("sha256", empty).alias("sha256"), F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"))


def read_feed(spark: SparkSession, path: str, run_id: str, schema: T.StructType | str,
              part: str = "records") -> DataFrame:
    """One part of a stored run with an explicit schema."""
    return spark.read.schema(schema).json(f"{path}/run_id={run_id}/{part}")


def verify_feed(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Recompute every part's digest: ``(run_id, part, ok, expected, actual)``."""
    expected = spark.read.parquet(f"{path}/run_id={run_id}/manifest").select(
        "part", F.col("sha256").alias("expected"))
    actual = bundle_digest(spark, path, run_id).select("part", F.col("sha256").alias("actual"))
    return expected.join(actual, "part", "full_outer").select(
        F.lit(run_id).alias("run_id"), "part", F.col("expected").eqNullSafe(F.col("actual")).alias("ok"),
        "expected", "actual")


def run_summary(routed: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """AGG6: counts of a run's outcomes per source."""
    return routed.groupBy(*keys).agg(
        F.count("*").alias("items_seen"), F.count_if(F.col("outcome") == "record").alias("records"),
        F.count_if(F.col("outcome") == "tombstone").alias("tombstones"),
        F.count_if(F.col("outcome") == "reject").alias("rejects"), F.bool_or("blocking").alias("held"))


def reason_report(routed: DataFrame, keys: Sequence[str] = ("source", "reason")) -> DataFrame:
    """AGG6 as a report: subtotals over source and reason."""
    return routed.rollup(*keys).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


# Statuses of one enrichment attempt.
STATUSES = ["attempted", "enriched", "confirmed", "replay_pending", "known", "deferred", "failed"]


def processing_stats(log: DataFrame, keys: Sequence[str] = (), status: str = "status") -> DataFrame:
    """AGG7: counts per status, for the run or per worker."""
    return log.groupBy(*keys).agg(*[F.count_if(F.col(status) == s).alias(s) for s in STATUSES])
