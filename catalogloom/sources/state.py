"""Versioned state tables (SRC8)."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import positive_int

CURSOR_SCHEMA = "source string, listing_id string, deep_page int, last_page int, complete boolean"
KEY_SCHEMA = "source string, content_key string, successes int, confirmed boolean"


def clean_cursors(raw: DataFrame) -> DataFrame:
    """Typed cursors: a page that is not an integer >= 1 becomes null."""
    return raw.select(
        "source", F.col("listing_id").cast("string").alias("listing_id"),
        positive_int(F.col("deep_page")).alias("deep_page"), positive_int(F.col("last_page")).alias("last_page"),
        F.coalesce(F.col("complete").cast("boolean"), F.lit(False)).alias("complete"))


def valid_key(c: Column) -> Column:
    key = F.lower(F.trim(c))
    return F.when(key.rlike("^[0-9a-f]{40}$"), key)


def clean_keys(raw: DataFrame) -> DataFrame:
    """One row per valid key; a confirmed key has no pending count.

    Invalid keys and counts below 1 are dropped; confirmed wins over pending.
    """
    typed = raw.select("source", valid_key(F.col("content_key")).alias("content_key"),
                       F.coalesce(F.col("successes").cast("string").try_cast("int"), F.lit(0)).alias("successes"),
                       F.coalesce(F.col("confirmed").cast("boolean"), F.lit(False)).alias("confirmed"))
    merged = typed.where(F.col("content_key").isNotNull()).groupBy("source", "content_key").agg(
        F.max("successes").alias("successes"), F.bool_or("confirmed").alias("confirmed"))
    return merged.where(F.col("confirmed") | (F.col("successes") > 0)).select(
        "source", "content_key", F.when(F.col("confirmed"), 0).otherwise(F.col("successes")).alias("successes"),
        "confirmed")


_COMMIT = "version bigint, run_id string, folder string"


class StateConflict(RuntimeError):
    """Another run committed the version that this one was based on; nothing of this run was committed."""


def _commits(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_COMMIT).json(f"{path}/commits")
    except AnalysisException:
        return spark.createDataFrame([], _COMMIT)


def state_version(spark: SparkSession, path: str) -> int:
    """Newest committed version, 0 when there is none yet."""
    return _commits(spark, path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def load_version(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, int]:
    """The newest committed state with its version; an empty table and 0 when there is none yet."""
    newest = _commits(spark, path).agg(F.max_by(F.struct("version", "folder"), "version").alias("c")).first().c
    if newest is None:
        return spark.createDataFrame([], schema), 0
    return spark.read.schema(schema).parquet(f"{path}/data/{newest.folder}"), newest.version


def load_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return load_version(spark, path, schema)[0]


def _create_commit(spark: SparkSession, path: str, version: int, run_id: str, folder: str) -> bool:
    """Make the version's commit file unless there is one; whoever makes it owns the version.

    The file is written beside its place and moved there without overwriting,
    which a shared file system does in one step, so no reader sees half of it.
    """
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place, beside = fs.Path(f"{path}/commits/{version:020d}.json"), fs.Path(f"{path}/beside/{folder}.json")
    files = place.getFileSystem(conf)
    files.mkdirs(place.getParent())
    out = files.create(beside, True)
    out.write(bytearray(json.dumps({"version": version, "run_id": run_id, "folder": folder}).encode() + b"\n"))
    out.close()
    whole = files.makeQualified(place)
    context = fs.FileContext.getFileContext(whole.toUri(), conf)
    none = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(beside), whole, none)
        return True
    except Py4JJavaError as error:
        files.delete(beside, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise


def _folder(run_id: str) -> str:
    """A new folder for every attempt of a run."""
    return f"{hashlib.sha256(run_id.encode()).hexdigest()[:32]}-{uuid.uuid4().hex[:8]}"


def save_state(df: DataFrame, path: str, run_id: str, base: int | None = None) -> int:
    """Write a run's state, then commit it as the version after ``base`` (the newest when None).

    Readers follow the commit files, so a crash in between leaves the old state
    in force. The commit is a compare and swap: of several runs from one
    version one commits, and every other raises :class:`StateConflict`.
    """
    spark = df.sparkSession
    version = (state_version(spark, path) if base is None else base) + 1
    folder = _folder(run_id)
    df.write.parquet(f"{path}/data/{folder}")
    if not _create_commit(spark, path, version, run_id, folder):
        raise StateConflict(f"version {version} of {path} is committed; {run_id} is not")
    return version


def update_state(spark: SparkSession, path: str, run_id: str, schema: str, change: Callable[[DataFrame], DataFrame],
                 attempts: int = 10) -> int:
    """Apply a change to the newest state; a run that loses its version reads the winner's and applies the change again."""
    for left in range(attempts - 1, -1, -1):
        stored, version = load_version(spark, path, schema)
        try:
            return save_state(change(stored), path, run_id, version)
        except StateConflict:
            if not left:
                raise
    raise ValueError("attempts must be at least 1")


def is_committed(spark: SparkSession, path: str, run_id: str) -> bool:
    return not _commits(spark, path).where(F.col("run_id") == run_id).isEmpty()
