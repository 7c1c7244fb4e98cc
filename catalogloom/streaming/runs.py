"""Structured Streaming runs: pages (STR1), confirmation (STR4), change feed (STR5), dedupe (STR6), commit order (STR7)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import apply_changes
from ..sources.state import is_committed, save_state, update_state


def run_available(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """One scheduled run: everything that is new, in micro-batches, then stop."""
    query = (df.writeStream.trigger(availableNow=True).outputMode(mode).option("checkpointLocation", checkpoint)
             .foreachBatch(handle).start())
    query.awaitTermination()


def publish_batches(df: DataFrame, path: str, checkpoint: str,
                    build: Callable[[DataFrame], dict[str, DataFrame]]) -> None:
    """STR1, STR7: each batch is written under its own id before anything else moves.

    A batch that is replayed after a failure overwrites its own folder, so the
    output holds every row once; the stream's checkpoint commits afterwards.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        for name, frame in build(batch).items():
            frame.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")

    run_available(df, checkpoint, handle)


def dedupe_stream(df: DataFrame, keys: list[str], event_time: str, horizon: str) -> DataFrame:
    """STR6: the first delivery of a key within the horizon; state is bounded by it."""
    timed = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(keys)


def stream_confirmations(df: DataFrame, key: str, n: int, path: str, checkpoint: str) -> None:
    """STR4: the running success count of every key a batch touches, with its status, published per batch.

    Counts are a streaming aggregate: partial counts combine before the shuffle
    and the state is one number a key. A key is ``confirmed`` in the batch that
    brings it to ``n`` and ``known`` once an earlier batch has published that. A
    replayed batch overwrites its own folder and looks at earlier ones only.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("successes"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = batch.withColumn("status", F.lit("replay_pending"))
        if batch_id:
            log_schema = f"{log.schema[key].simpleString().replace(':', ' ', 1)}, successes bigint, status string, batch_id bigint"
            earlier = spark.read.schema(log_schema).parquet(path).where(
                (F.col("batch_id") < batch_id) & (F.col("status") == "confirmed")).select(key).distinct().withColumn("_known", F.lit(True))
            log = batch.join(earlier, key, "left")
        known = F.coalesce(F.col("_known"), F.lit(False)) if batch_id else F.lit(False)
        log.select(key, "successes", F.when(known, "known").when(F.col("successes") >= n, "confirmed").otherwise(
            "replay_pending").alias("status")).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run_available(counts, checkpoint, handle, "update")


def stream_changes(df: DataFrame, state_path: str, checkpoint: str, schema: str, keys: list[str], order: str,
                   values: list[str]) -> None:
    """STR5: fold a stream of deliveries into versioned catalog states.

    ``df`` has (keys, order, gone boolean, values). A replayed batch finds its
    own commit and is skipped, so each batch is applied exactly once.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, state_path, f"batch-{batch_id}"):
            return
        update_state(spark, state_path, f"batch-{batch_id}", schema, lambda catalog: apply_changes(
            catalog, batch.where(~F.col("gone")), batch.where("gone"), keys, order, values))

    run_available(df, checkpoint, handle)


def commit_after_publish(spark: SparkSession, run_id: str, publish: Callable[[], None], next_state: DataFrame,
                         state_path: str, advance: bool = True, base: int | None = None) -> bool:
    """STR7 for a batch run: output first, state last.

    A run that is already committed is not repeated; one that must not advance
    publishes and leaves the state as it was. ``base`` is the version that
    ``next_state`` was made from; if another run has moved on from it, the
    commit fails loudly and the run is repeated from the newer state.
    """
    if is_committed(spark, state_path, run_id):
        return False
    publish()
    if advance:
        save_state(next_state, state_path, run_id, base)
    return advance
