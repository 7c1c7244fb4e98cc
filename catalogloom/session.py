"""Session settings and durable cut points."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "catalogloom", **conf) -> SparkSession:
    """A session with the settings the engine is designed for.

    On a cluster leave ``master`` unset and let the launcher decide sizes;
    everything here may be overridden by keyword (``_`` for ``.``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    defaults.update({k.replace("_", "."): str(v) for k, v in conf.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let the workers import this package wherever they run; once for each context."""
    context = spark.sparkContext
    if getattr(context, "_catalogloom_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="catalogloom-"), "catalogloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("catalogloom", os.path.relpath(full, top)))
    context.addPyFile(path)
    context._catalogloom_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session of a single process without that setting gets a folder of its own; a
    cluster must name one, because executors cannot see each other's disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="catalogloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint (survives lost executors)."""
    spark = df.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared root for one run's tables."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Rows written once as compressed columns in the shared folder: for wide tables of which a step reads few columns."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
