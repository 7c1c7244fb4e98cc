"""Incremental runs as table operations: planning, budgets, confirmation, change feed, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scale import first_by, running_totals


def plan_cursor(state: DataFrame, backfill: int | Column) -> DataFrame:
    """STR2: pages to read and next cursor per listing.

    Page 1 always, then a finite descending backfill that never wraps. Adds
    ``pages`` (array), ``next_deep`` and ``next_complete``.
    """
    size = F.lit(backfill) if isinstance(backfill, int) else backfill
    staged = state.withColumns({
        "_last": F.greatest(F.coalesce("last_page", F.lit(1)), F.lit(1)),
        "_size": F.greatest(size, F.lit(0))})
    staged = staged.withColumn("_start", F.when(
        F.col("deep_page").between(2, F.col("_last")), F.col("deep_page")).otherwise(F.col("_last")))
    staged = staged.withColumn("_end", F.greatest(F.lit(2), F.col("_start") - F.col("_size") + 1))
    done = F.coalesce("complete", F.lit(False)) | (F.col("_last") == 1)
    idle = F.col("_size") == 0
    back = F.sequence(F.col("_start"), F.col("_end"), F.lit(-1))
    return staged.withColumns({
        "pages": F.when(done | idle, F.array(F.lit(1))).otherwise(F.concat(F.array(F.lit(1)), back)),
        "next_deep": F.when(done, F.lit(None).cast("int")).when(idle, F.coalesce("deep_page", "_last"))
                      .when(F.col("_end") == 2, F.lit(None).cast("int")).otherwise(F.col("_end") - 1),
        "next_complete": F.when(done, True).when(idle, False).otherwise(F.col("_end") == 2),
    }).drop("_last", "_size", "_start", "_end")


def plan_pages(state: DataFrame, backfill: int | Column, keys: Sequence[str] = ("source", "listing_id")) -> DataFrame:
    """One row per page to read, in reading order."""
    return plan_cursor(state, backfill).select(*keys, F.posexplode("pages").alias("ord", "page"))


def advance_or_hold(state: DataFrame, plan: DataFrame, outcomes: DataFrame,
                    keys: Sequence[str] = ("source", "listing_id"), advance: bool | Column = True) -> DataFrame:
    """STR3: the next cursor of every listing.

    A blocked row off page 1 holds the deepest such page; one on page 1 keeps
    the cursor; otherwise the plan applies. ``last_page`` is refreshed in all
    three. A run that must not advance changes nothing. ``plan`` has (keys,
    last_page, next_deep, next_complete), ``outcomes`` (keys, page, blocking).
    """
    keys = list(keys)
    held = outcomes.groupBy(*keys).agg(
        F.max(F.when(F.col("blocking") & (F.col("page") != 1), F.col("page"))).alias("_hold"),
        F.coalesce(F.bool_or("blocking"), F.lit(False)).alias("_blocked"))
    planned = plan.select(*keys, F.col("last_page").alias("_last"), "next_deep", "next_complete")
    joined = state.join(planned, keys, "left").join(held, keys, "left")
    go = (F.lit(advance) if isinstance(advance, bool) else advance) & F.col("_last").isNotNull()
    blocked = F.coalesce("_blocked", F.lit(False))
    decision = (F.when(~go, "unchanged").when(F.col("_hold").isNotNull(), "held")
                .when(blocked, "kept").otherwise("advanced"))
    staged = joined.withColumn("decision", decision)
    choose = lambda held_value, kept, advanced: (
        F.when(F.col("decision") == "held", held_value).when(F.col("decision") == "advanced", advanced).otherwise(kept))
    return staged.select(
        *keys, choose(F.col("_hold"), F.col("deep_page"), F.col("next_deep")).alias("deep_page"),
        F.when(F.col("decision") == "unchanged", F.col("last_page")).otherwise(F.col("_last")).alias("last_page"),
        choose(F.lit(False), F.col("complete"), F.col("next_complete")).alias("complete"), "decision")


def cap_by_budget(rows: DataFrame, order: Sequence[Column], is_unknown: Column, budget: int,
                  keys: Sequence[str] = ()) -> DataFrame:
    """WIN3: process the first N unknown rows in traversal order, defer the rest.

    Two phases: unknown rows per chunk, then the offset of each chunk, so only
    one row per chunk meets in the ordered step. Known rows are never deferred.
    """
    counted = running_totals(rows.withColumn("_u", is_unknown.cast("int")), list(keys), order, {"_seen": F.col("_u")})
    return counted.withColumn("status", F.when(F.col("_u") == 0, "known").when(
        F.col("_seen") <= budget, "process").otherwise("deferred")).drop("_u", "_seen")


def confirm_after_n(deliveries: DataFrame, key: str, order: Column, n: int) -> DataFrame:
    """STR4, batch: each delivery's count so far and status; confirmed at the n-th.

    ``replay_pending`` before, ``confirmed`` at, ``known`` after the n-th success.
    """
    counted = running_totals(deliveries, [key], [order], {"successes": F.lit(1)})
    return counted.withColumn("status", F.when(F.col("successes") < n, "replay_pending").when(
        F.col("successes") == n, "confirmed").otherwise("known"))


def key_state_after(deliveries: DataFrame, key: str, n: int, before: DataFrame | None = None) -> DataFrame:
    """State of every key after the deliveries: pending count or confirmed.

    A plain count with map-side combine; the state before the run is one more
    summand.
    """
    counts = deliveries.groupBy(key).agg(F.count("*").alias("successes"))
    if before is not None:
        counts = counts.unionByName(before.select(key, F.when(F.col("confirmed"), F.lit(n)).otherwise(
            F.col("successes")).cast("bigint").alias("successes"))).groupBy(key).agg(
            F.sum("successes").alias("successes"))
    return counts.select(key, "successes", (F.col("successes") >= n).alias("confirmed"))


def merge_confirmed(confirmed: DataFrame, newly: DataFrame, pending: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """SET2: confirmed keys united, and pending keys without them."""
    united = confirmed.select(key).union(newly.select(key)).distinct()
    return united, pending.join(united, key, "left_anti")


def apply_changes(catalog: DataFrame, records: DataFrame, tombstones: DataFrame, keys: Sequence[str],
                  order: str, values: Sequence[str]) -> DataFrame:
    """STR5: latest delivery wins per key; a tombstone removes, a later record restores.

    A poor delivery never erases a richer row: each value is the last non-null
    one, falling back to the stored value. On equal order the tombstone wins.
    The catalog has (keys, order, values, gone); removed items stay as rows
    marked ``gone``, so an older record that arrives late cannot revive them.
    Folding deliveries in one batch or in several gives the same catalog.
    """
    keys = list(keys)
    deltas = records.select(*keys, order, F.lit(False).alias("_gone"), *values).unionByName(
        tombstones.select(*keys, order, F.lit(True).alias("_gone"),
                          *[F.lit(None).cast(records.schema[v].dataType).alias(v) for v in values]))
    latest = deltas.groupBy(*keys).agg(
        F.max(order).alias("_order"), F.max_by("_gone", F.struct(order, "_gone")).alias("_gone"),
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(f"_new_{v}") for v in values])
    joined = catalog.join(latest, keys, "full_outer")
    newer = F.col("_order").isNotNull() & (F.col(order).isNull() | (F.col("_order") >= F.col(order)))
    pick = lambda new, old: F.when(newer, F.coalesce(new, old)).otherwise(F.coalesce(old, new))
    return joined.select(
        *keys, F.greatest("_order", order).alias(order),
        *[pick(F.col(f"_new_{v}"), F.col(v)).alias(v) for v in values],
        F.coalesce(F.when(newer, F.col("_gone")).otherwise(F.col("gone")), F.lit(False)).alias("gone"))


def live(catalog: DataFrame) -> DataFrame:
    """The catalog without removed items."""
    return catalog.where(~F.col("gone")).drop("gone")


def retry_queue(open_items: DataFrame, failures: DataFrame, terminal: DataFrame, keys: Sequence[str]) -> DataFrame:
    """STR8: items still to be retried with attempts, transient and permanent counted apart.

    ``failures`` has (keys, permanent boolean); a terminal outcome closes an item.
    """
    keys = list(keys)
    fresh = failures.groupBy(*keys).agg(
        F.count_if(~F.col("permanent")).alias("transient"), F.count_if(F.col("permanent")).alias("permanent"))
    united = open_items.select(*keys, "transient", "permanent").unionByName(fresh)
    summed = united.groupBy(*keys).agg(F.sum("transient").alias("transient"), F.sum("permanent").alias("permanent"))
    return summed.join(terminal.select(*keys).distinct(), keys, "left_anti").withColumn(
        "attempts", F.col("transient") + F.col("permanent"))


def health_report(runs: DataFrame, source: str = "source", run: str = "run", records: str = "records",
                  rejects: str = "rejects", deep_page: str | None = None, jump: float = 2.0) -> DataFrame:
    """STR9: per-run alerts against the run before of the same source.

    ``runs`` is already one row per source and run.
    """
    before = Window.partitionBy(source).orderBy(run)
    staged = runs.withColumn("previous_rejects", F.lag(rejects).over(before))
    alerts = [F.when(F.col(records) == 0, F.lit("zero_records")),
              F.when(F.col(rejects) > F.col("previous_rejects") * jump, F.lit("rejects_jump"))]
    if deep_page:
        alerts.append(F.when(F.col(deep_page) == F.lag(deep_page).over(before), F.lit("cursor_stuck")))
    return staged.withColumn("alerts", F.array_join(F.array_compact(F.array(*alerts)), ","))


def sample_by_hash(df: DataFrame, keys: Sequence[str], one_in: int, salt: str = "") -> DataFrame:
    """Deterministic sample: the same rows on every run and any partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(salt))
    bucket = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.where(bucket % one_in == 0)


def overlap_audit(rescanned: DataFrame, catalog: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    """STR10: differences between re-read items and the catalog.

    ``catalog`` must be limited to the same pages; missed items are only in the
    re-scan, vanished ones only in the catalog.
    """
    keys = list(keys)
    a = rescanned.select(*keys, F.col(status).alias("seen"))
    b = catalog.select(*keys, F.col(status).alias("stored"))
    finding = (F.when(F.col("stored").isNull(), "missed").when(F.col("seen").isNull(), "vanished")
               .when(F.col("seen") != F.col("stored"), "changed"))
    return a.join(b, keys, "full_outer").withColumn("finding", finding).where(F.col("finding").isNotNull())


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """AGG1: first row per key in traversal order, as an aggregate."""
    return first_by(df, keys, order)
