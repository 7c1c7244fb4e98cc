"""Queries that run whole jobs: sources by spec, bundles, streams and versioned state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import chunk_between, order_borders
from ..operators import incremental, nodes
from ..session import durable, scratch_dir
from ..sources import feed, state
from ..streaming import runs
from . import specs
from .page_queries import _CLEAN, _LINKS_SQL
from .registry import Tables, query
from .table_queries import _ROUTED_SQL, CATALOG_SCHEMA, CHANGES_SQL, _routed, deliveries, stored_catalog

_SPECS = [
    specs.SourceSpec("cards", ("example.com",), (("author", "/t", 5), ("series", "/e", 1))),
    specs.SourceSpec("playlist", ("example.net",), (("author", "/a", 2), ("genre", "/o", 3)), requires_parts=False),
    specs.SourceSpec("posts", ("example.org", "example.com"), (("narrator", "/i", 8),)),
]
_SOURCE_SQL = "case page_id % 3 when 0 then 'cards' when 1 then 'playlist' else 'posts' end"


def _source(key: str):
    return F.when(F.col(key) % 3 == 0, "cards").when(F.col(key) % 3 == 1, "playlist").otherwise("posts")


@query("udx1_links_by_source_spec", _LINKS_SQL + r"""
, rules(source, kind, pattern, keep) as (values ('cards','author','/t',5), ('cards','series','/e',1), ('playlist','author','/a',2), ('playlist','genre','/o',3), ('posts','narrator','/i',8)),
s as (select *, """ + _SOURCE_SQL + r""" as source from l),
c as (select source, page_id, kind, keep, """ + _CLEAN.format("text") + r""" as label, min(pos) as pos from s join rules using (source)
  where contains(href, pattern) and trim(text) <> '' and not regexp_full_match(trim(text), '\d+') group by all),
r as (select *, row_number() over (partition by page_id, kind order by pos) as rank from c)
select source, page_id, kind, rank, label from r where rank <= keep""")
def udx1(t: Tables):
    found = nodes.extract_links_from_text(t.pages).withColumn("source", _source("page_id"))
    return specs.classify_links_by_source(found, specs.link_rules(t.spark, _SPECS))


@query("udx2_host_policy", r"""
with p as (select page_id, url, """ + _SOURCE_SQL + r""" as source, regexp_extract(url, '^https?://([^/?#:]+)', 1) as host from pages)
select page_id, source, source <> 'playlist' as requires_parts, case source when 'cards' then host like '%.example.com' when 'playlist' then host like '%.example.net'
 else host like '%.example.org' or host like '%.example.com' end as allowed from p""")
def udx2(t: Tables):
    pages = t.pages.select("page_id", "url", _source("page_id").alias("source"))
    return specs.check_hosts(pages, specs.host_policy(t.spark, _SPECS)).drop("url")


@query("src7_verified_bundle", _ROUTED_SQL + """
select p.part, true as ok, count(r.event_id) as records from (select unnest(['records','tombstones','rejects']) as part, unnest(['record','tombstone','reject']) as outcome) p
left join r on r.outcome = p.outcome group by p.part""")
def src7(t: Tables):
    """Write a whole run as a bundle, then recompute every digest from storage."""
    routed = _routed(t).drop("ts")
    path = scratch_dir(t.spark, "bundle")
    manifest = feed.write_feed_bundle(
        path, "20240101T000000Z-000000000000", "events", routed.where(F.col("outcome") == "record").drop("reason", "blocking"),
        routed.where(F.col("outcome") == "tombstone").drop("blocking"), routed.where(F.col("outcome") == "reject"))
    checked = feed.verify_feed(t.spark, path, "20240101T000000Z-000000000000")
    return checked.select("part", "ok").join(manifest.select("part", "records"), "part")


@query("src7_read_feed", _ROUTED_SQL + "select event_id, source, reason from r where outcome = 'tombstone'")
def src7_read(t: Tables):
    routed = _routed(t).drop("ts").where(F.col("outcome") == "tombstone")
    path = scratch_dir(t.spark, "bundle")
    empty = routed.where(F.lit(False))
    feed.write_feed_bundle(path, "r1", "events", empty, routed, empty)
    return feed.read_feed(t.spark, path, "r1", "event_id bigint, source string, reason string", "tombstones")


@query("str1_streamed_links", _LINKS_SQL + "select page_id, pos, href, origin || href as url from l")
def str1(t: Tables):
    """Pages as a stream, extracted per micro-batch, read back from the published table."""
    root = scratch_dir(t.spark, "pages-run")
    # A pattern, so that the table may be one file or a folder of files: a stream's plain path must be a folder.
    stream = t.spark.readStream.schema("page_id bigint, url string, html string").parquet(f"{t.dir}/[p]ages.parquet")
    runs.publish_batches(stream, root, f"{root}/checkpoint", lambda batch: {
        "links": nodes.extract_links_from_text(batch), "pages": batch.select("page_id", "url")})
    return t.spark.read.parquet(f"{root}/links").select("page_id", "pos", "href", "url")


def _delivered(rows: DataFrame, order: Column, folder: str, run) -> None:
    """Three deliveries of rows in order; after each one arrives, a scheduled run takes all its files as one micro-batch."""
    dealt = durable(rows.withColumn("_delivery", chunk_between(F.struct(order.alias("_0")), order_borders(rows, [order], 3))))
    for day in range(4):  # three borders may leave rows on both sides
        dealt.where(F.col("_delivery") == day).drop("_delivery").write.mode("append").parquet(folder)
        run(rows.sparkSession.readStream.schema(rows.schema).parquet(folder))


@query("str4_streamed_confirmations", """
select user_id, count(*) as successes, count(*) >= 13 as confirmed from events where event_type = 'purchase' group by 1""")
def str4_stream(t: Tables):
    root = scratch_dir(t.spark, "confirm")
    bought = t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id")
    _delivered(bought, F.col("event_id"), f"{root}/in", lambda stream: runs.stream_confirmations(
        stream, "user_id", 13, f"{root}/out", f"{root}/checkpoint"))
    log = t.spark.read.schema("user_id bigint, successes bigint, status string").parquet(f"{root}/out")
    return log.groupBy("user_id").agg(F.max("successes").alias("successes"), F.bool_or(F.col("status") == "confirmed").alias("confirmed"))


@query("str5_streamed_changes", CHANGES_SQL)
def str5_stream(t: Tables):
    root = scratch_dir(t.spark, "changes")
    state.save_state(stored_catalog(t), f"{root}/state", "start")
    _delivered(deliveries(Tables(t.spark, t.dir)), F.col("event_id"), f"{root}/in", lambda stream: runs.stream_changes(
        stream, f"{root}/state", f"{root}/checkpoint", CATALOG_SCHEMA, ["user_id"], "event_id", ["kind", "cents"]))
    return incremental.live(state.load_state(t.spark, f"{root}/state", CATALOG_SCHEMA))


@query("str6_deduplicated_stream", "select event_id, user_id, event_type from events")
def str6(t: Tables):
    """Events in the order of their time, each three times; a key is remembered for an hour of event time."""
    root = scratch_dir(t.spark, "dedupe")

    def run(stream: DataFrame) -> None:
        doubled = stream.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).drop("_copy")
        unique = runs.dedupe_stream(doubled, ["event_id"], "ts", "1 hour").select("event_id", "user_id", "event_type")
        unique.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").format("parquet").start(
            f"{root}/out").awaitTermination()
    _delivered(t.events, F.col("ts"), f"{root}/in", run)
    return t.spark.read.parquet(f"{root}/out")


@query("str7_commit_after_publish", """
select 'cards' as source, c_nationkey::varchar as listing_id, 1 as deep_page, count(*)::int as last_page, false as complete, 2 as version, count(*) as published from customer group by c_nationkey""")
def str7(t: Tables):
    """Publish, then commit; a repeated run does nothing, a held run keeps the state."""
    root = scratch_dir(t.spark, "commit")
    rows = t.customer.groupBy("c_nationkey").agg(F.count("*").cast("int").alias("n"))
    cursor = lambda deep: rows.select(
        F.lit("cards").alias("source"), F.col("c_nationkey").cast("string").alias("listing_id"), F.lit(deep).alias("deep_page"),
        F.col("n").alias("last_page"), F.lit(False).alias("complete"))
    publish = lambda run: lambda: t.customer.write.mode("overwrite").parquet(f"{root}/out/run={run}")
    for run, deep, advance in [("a", 7, True), ("a", 9, True), ("b", 1, True), ("c", 5, False)]:
        runs.commit_after_publish(t.spark, run, publish(run), cursor(deep), f"{root}/state", advance)
    published = t.spark.read.parquet(f"{root}/out").where(F.col("run") == "c").groupBy(
        F.col("c_nationkey").cast("string").alias("listing_id")).agg(F.count("*").alias("published"))
    stored = state.load_state(t.spark, f"{root}/state", state.CURSOR_SCHEMA)
    return stored.withColumn("version", F.lit(state.state_version(t.spark, f"{root}/state"))).join(published, "listing_id")
