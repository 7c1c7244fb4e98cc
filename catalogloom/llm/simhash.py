"""Document fingerprints: SimHash over weighted term hashes.

A term is a run of five words; its weight is how often it occurs. Every term
votes for the 128 bits of its hash, and a bit is set when most of the weight is
for it. Terms are counted where their document lies: the grouping follows the
partitioning of the rows, and eight bits' votes are added in one long, so a
term costs sixteen additions in generated code.

Near fingerprints are found by comparing the asked ones with all, block by
block. Texts of similarity 0.8 differ in about 19 of the 128 bits and 99 % of
them within ``NEAR_BITS``; at that radius block tables hold more candidates
than there are pairs (435 tables with keys of 8.5 bits, or 35,960 with 16), so
none are built and no pair within the radius is missed.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogloom.llm.shared import kept

#: Words in a term; bits of a fingerprint.
TERM_WORDS = 5
BITS = 128
#: Terms whose votes fit into eight bits next to each other, sign bit excluded.
_LANES = 127
_ONES = 0x0101010101010101
#: Two of these eight-bit sums in one long, 32 bits apart.
_PAIR = 0x000000FF000000FF
#: Low bits of the ids in a chunk of neighbours, and of the chunks in a group of chunks.
CHUNK_BITS = 6
GROUP_BITS = 12
#: Bits within which texts are near: 99 % of pairs whose five-word runs have a Jaccard similarity of 0.8 differ in no more.
NEAR_BITS = 29
#: Asked fingerprints that are broadcast at a time, and comparisons in a task.
ASKED_BLOCK = 1 << 18
TASK_PAIRS = 1 << 30


def terms(text: Column) -> Column:
    """Structs ``w0`` to ``w4``, the word hashes of each run of five words; of a shorter sequence one hash as ``w0``.

    A term's hash is ``xxhash64`` of the five. A text without words has none.
    """
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        n = F.size(h)
        names = [f"w{k}" for k in range(TERM_WORDS)]
        shifted = [F.slice(h, F.lit(k + 1), F.greatest(n - (TERM_WORDS - 1), F.lit(0))).alias(name)
                   for k, name in enumerate(names)]
        short = F.array(F.struct(F.xxhash64(h).alias("w0"), *[F.lit(None).cast("long").alias(x) for x in names[1:]]))
        return F.when(n >= TERM_WORDS, F.arrays_zip(*shifted)).when(n > 0, short)
    return F.element_at(F.transform(F.array(hashes), runs), 1)


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``bits`` (two longs ``a`` and ``b``) of every row with words; without words all bits are zero.

    ``keys`` tell the rows apart. Rows that are already dealt by some of the
    keys are not shuffled.
    """
    spread = rows.select(*keys, F.posexplode(terms(F.coalesce(F.col(text), F.lit("")))).alias("_at", "_term"))
    term = F.xxhash64(*[F.col(f"_term.w{k}") for k in range(TERM_WORDS)])
    hashed = spread.select(*keys, F.floor(F.col("_at") / _LANES).alias("_part"), term.alias("_a")).withColumn("_b", F.xxhash64("_a", F.lit(1)))
    vote = lambda half, i: F.sum(F.shiftrightunsigned(F.col(half), i).bitwiseAND(F.lit(_ONES)))
    packed = hashed.groupBy(*keys, "_part").agg(
        F.count("*").alias("_n"),
        *[vote(half, i).alias(f"{half}{i}") for half in ("_a", "_b") for i in range(8)])
    pair = lambda half, i, s: F.sum(F.shiftrightunsigned(F.col(f"{half}{i}"), 8 * s).bitwiseAND(F.lit(_PAIR)))
    wide = packed.groupBy(*keys).agg(F.sum("_n").alias("_n"), *[
        pair(half, i, s).alias(f"{half}{i}{s}") for half in ("_a", "_b") for i in range(8) for s in range(4)])

    def word(half: str) -> Column:
        """Bit ``8 * lane + i`` is set when its votes are more than half; lanes s and s + 4 share a sum."""
        out = F.lit(0).cast("long")
        for i in range(8):
            for s in range(4):
                both = F.col(f"{half}{i}{s}")
                for lane, votes in ((s, both.bitwiseAND(F.lit(0xFFFFFFFF))), (s + 4, F.shiftrightunsigned(both, 32))):
                    bit = 1 << (8 * lane + i)
                    out = out.bitwiseOR(F.when(votes * 2 > F.col("_n"), F.lit(bit - (1 << 64) if bit >> 63 else bit))
                                        .otherwise(F.lit(0)).cast("long"))
        return out
    return wide.select(*keys, F.struct(word("_a").alias("a"), word("_b").alias("b")).alias("bits"))


def as_text(bits: Column) -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(bits["a"]), 16, "0"), F.lpad(F.hex(bits["b"]), 16, "0")))


def distance(x: Column, y: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return F.bit_count(x["a"].bitwiseXOR(y["a"])) + F.bit_count(x["b"].bitwiseXOR(y["b"]))


def likeness(x: Column, y: Column) -> Column:
    return 1 - distance(x, y) / F.lit(float(BITS))


def with_next(rows: DataFrame, doc_id: str, order: list[str]) -> DataFrame:
    """``rows`` with ``following``: the row that follows in ascending id order, after the last the first.

    Rows with equal ids follow in the given order; null ids come first. Rows
    move once, to chunks of neighbouring ids; the first row of each chunk goes
    to the chunk before as well. ``_chunk`` and ``_no`` tell the rows apart.
    """
    own = rows.columns
    chunked = rows.withColumn("_chunk", F.coalesce(F.shiftright(F.col(doc_id), CHUNK_BITS), F.lit(-(1 << 60))))
    inside = Window.partitionBy("_chunk").orderBy(F.col(doc_id).asc_nulls_first(), *order)
    heads = chunked.withColumn("_no", F.row_number().over(inside)).where("_no = 1").select(
        F.col("_chunk").alias("_following"), F.struct(*own).alias("_head"))
    opening = heads.join(_chunk_order(chunked), "_following").select("_chunk", "_head")
    ahead = chunked.select("*", F.row_number().over(inside).alias("_no"), F.lead(F.struct(*own)).over(inside).alias("_lead"))
    return ahead.join(opening, "_chunk", "left").select(
        "_chunk", "_no", *own, F.coalesce("_lead", "_head").alias("following"))


def _chunk_order(rows: DataFrame) -> DataFrame:
    """Every chunk and the one that follows it, after the last the first; chunk numbers only."""
    chunks = rows.select("_chunk").distinct().withColumn("_group", F.shiftright("_chunk", GROUP_BITS))
    groups = chunks.groupBy("_group").agg(F.min("_chunk").alias("_low"))
    whole = Window.orderBy("_group")
    first = F.min("_low").over(Window.partitionBy())
    groups = groups.select("_group", F.coalesce(F.lead("_low").over(whole), first).alias("_low"))
    return chunks.join(groups, "_group").select("_chunk", F.coalesce(
        F.lead("_chunk").over(Window.partitionBy("_group").orderBy("_chunk")), "_low").alias("_following"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, whose second half is the next text's beginning.

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``own`` and ``edited``
    (fingerprints) and ``following`` (the next text's). Null texts are empty;
    repeated rows stay; a single row follows itself.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - half),
                      F.substr(F.col("following.text"), F.lit(1), half)).alias("edited_text")
    texts = with_next(rows, "doc_id", ["text"]).select(
        "_chunk", "_no", "doc_id", "text", n.cast("long").alias("n_chars"), edited)
    forms = texts.select("_chunk", "_no", F.inline(F.array(
        F.struct(F.lit(0).alias("_form"), F.col("text").alias("text")), F.struct(F.lit(1).alias("_form"), F.col("edited_text").alias("text")))))
    bits = fingerprints(forms, ["_chunk", "_no", "_form"]).groupBy("_chunk", "_no").agg(*[
        F.max(F.when(F.col("_form") == form, F.col(f"bits.{half}"))).alias(f"{name}_{half}")
        for form, name in ((0, "own"), (1, "edited")) for half in "ab"])
    facts = texts.select("_chunk", "_no", "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"))
    made = kept(facts.join(bits, ["_chunk", "_no"], "left").select("doc_id", "n_chars", "edited_sha256", *[
        F.struct(*[F.coalesce(f"{name}_{half}", F.lit(0).cast("long")).alias(half) for half in "ab"]).alias(name)
        for name in ("own", "edited")],
        "_no"), "fingerprints")
    return with_next(made.withColumnRenamed("_no", "_place"), "doc_id", ["_place"]).select(
        "doc_id", "n_chars", "edited_sha256", "own", "edited", F.col("following.own").alias("following"))


def near_counts(prints: DataFrame, asked: Column, radius: int = 3) -> DataFrame:
    """For the fingerprints of the asked rows: ``bits`` and ``near``, rows within ``radius`` bits of it.

    ``prints`` has a column ``bits``. Equal fingerprints are one entry with a
    count, so copies never meet each other. Every asked entry is compared with
    every entry: blocks of at most about ``ASKED_BLOCK`` asked ones are
    broadcast, and the entries are dealt so that a task makes about
    ``TASK_PAIRS`` comparisons.
    """
    entries = kept(prints.groupBy("bits").agg(F.count("*").alias("_n"), F.max(asked).alias("_asked")).select(
        F.col("bits.a").alias("_a"), F.col("bits.b").alias("_b"), "_n", "_asked"), "entries")
    total, wanted = entries.agg(F.count("*"), F.count(F.when(F.col("_asked"), 1))).first()
    blocks = max(1, math.ceil(wanted / ASKED_BLOCK))
    tasks = max(prints.sparkSession.sparkContext.defaultParallelism, math.ceil(total * wanted / blocks / TASK_PAIRS))
    dealt = entries.select("_a", "_b", "_n").repartition(tasks, "_a", "_b")
    queries = entries.where("_asked").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    found = []
    for block in range(blocks):
        some = queries.where(F.pmod(F.xxhash64("a", "b"), F.lit(blocks)) == block)
        apart = F.bit_count(F.col("_a").bitwiseXOR(F.col("a"))) + F.bit_count(F.col("_b").bitwiseXOR(F.col("b")))
        found.append(dealt.join(F.broadcast(some), apart <= radius).groupBy("a", "b").agg(F.sum("_n").alias("near")))
    return reduce(DataFrame.unionByName, found).select(F.struct("a", "b").alias("bits"), "near")
