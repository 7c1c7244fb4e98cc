"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogloom.llm import (alignment, decontaminate, language, near_dedup, packing, pieces, quality, secrets, sharding,
                              simhash, substring_dedup, tokens, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query("op6_decontamination", r"""
with dw as (select doc_id, generate_subscripts(w, 1) as pos, unnest(w) as word, len(w) as n from (
       select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents) t),
iw as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item_windows as (select distinct item_id, least(10, len(w)) as size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from iw where len(w) > 0) t),
sizes as (select distinct size from item_windows),
docs as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
doc_windows as (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as win
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from docs, sizes where len(w) >= size) t),
found as (select doc_id, item_id, i, size from doc_windows join item_windows using (win, size)),
hit as (select doc_id, count(distinct p) as n_hit from (
  select doc_id, unnest(range(i, i + size)) as p from found) t group by doc_id),
named as (select doc_id, count(distinct item_id) as n_items,
  string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from found group by doc_id)
select doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
""")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against ten-word windows of the benchmark."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                        carry=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def _vocabulary(name: str, given: str | None = None) -> str:
    """The path given, or that of a public tokenizer file."""
    if given is None:
        import public_tokenizers
        return public_tokenizers.path(name)
    return given


@_query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Documents in sequences of at most 2048 tokens."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer)


@_query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards, counts at most one apart."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    return sharding.shuffle(rows, 8, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@_query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from the documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    model = language.train(docs.where(rest != 2))
    found = language.predict(docs.select("doc_id", "text"), model, carry=["doc_id"])
    return found.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score",
                        "ambiguous")


@_query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Words and greedy word pieces of all documents."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tokens.token_counts(_table(spark, sf_dir, "documents"), vocabulary, carry=["doc_id"])


@_query("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in all documents; weak parts only with their complements."""
    strong = F.filter("spans", lambda x: x["strong"])
    count = lambda kind: F.size(F.filter(strong, lambda x: x["kind"] == kind)).cast("long")
    return secrets.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.STRONG],
        F.sha2(secrets.listing(strong), 256).alias("base_sha256"), secrets.listing(F.col("spans")).alias("spans"))


@_query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of all texts and their edited forms; near documents of every fiftieth id."""
    prints = simhash.edited_fingerprints(_table(spark, sf_dir, "documents"))
    near = simhash.near_counts(prints.withColumnRenamed("own", "bits"), F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False)),
                               simhash.NEAR_BITS)
    return prints.join(near.withColumnRenamed("bits", "own"), "own", "left").select(
        "doc_id", "n_chars", "edited_sha256", simhash.as_text(F.col("own")).alias("fingerprint"),
        simhash.as_text(F.col("edited")).alias("edited_fingerprint"),
        simhash.likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        simhash.likeness(F.col("own"), F.col("following")).alias("near_next"),
        F.when(F.col("doc_id") % 50 == 0, F.col("near")).alias("near_documents"))


@_query("op1_near_duplicates", r"""
with words as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x20\x09-\x0D]+') as w from documents),
shingles as (select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as i from words where len(w) > 0) t),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as common from shingles a join shingles b using (s)
  where a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * common >= 80 * (p.n + q.n - common)),
edges as (select x, y from links union all select y, x from links),
reach as (with recursive r(doc_id, other) as (select doc_id, doc_id from documents
  union select r.doc_id, e.y from r join edges e on e.x = r.other) select doc_id, min(other) as low from r group by doc_id)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, low as component_id, d.doc_id = low as kept
from documents d left join sizes using (doc_id) join reach on reach.doc_id = d.doc_id
""")
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their two-word shingles."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


@_query("op8_substring_dedup", r"""
with docs as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as win
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from docs where len(w) >= 20) t),
repeated as (select doc_id, i from (
  select doc_id, i, row_number() over (partition by win order by doc_id, i) as no from windows) t where no > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from repeated),
words as (select doc_id, generate_subscripts(w, 1) as p, unnest(w) as word from docs),
stays as (select doc_id, count(*) as n, string_agg(word, ' ' order by p) as txt
  from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
  sha256(coalesce(txt, '')) as kept_sha256
from docs left join stays using (doc_id)
""")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of twenty-word windows that started earlier."""
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from heuristics that label them."""
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs), carry=["doc_id"])


@_query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str, one: str | None = None, two: str | None = None) -> DataFrame:
    """Tokens of two vocabularies aligned in all documents, with corpus-wide counts of linked ids."""
    found = alignment.aligned(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json", one),
                              _vocabulary("piece_bpe_32k.model", two), carry=["doc_id"])
    return found.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")


@_query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the sixteen strongest directions, each of variance one."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), carry=["vec_id"], components=16)


@_query("op13_pieces")
def op13_pieces(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """All documents as pieces with begin and end ids, and back."""
    model = _vocabulary("piece_bpe_32k.model", model)
    coded = pieces.encode(_table(spark, sf_dir, "documents"), model, carry=["doc_id"])
    return pieces.decode(coded, model).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                              F.sha2("decoded", 256).alias("decoded_sha256"))
