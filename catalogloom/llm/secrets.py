"""Secret scanning with multipart credential linking.

Strong parts stand alone: assignments to secret names, access ids, long hex
runs. Weak parts (account names, secret-like runs, endpoints) are noise alone;
one is reported only when a complementary part lies within ``SCOPE`` code
points, found by an interval join of the parts of a document. The join meets
in cells of the scope's width, so a cell holds a bounded number of parts and no
document, however long, pairs all its parts.

Texts are scanned once; only positions are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogloom.llm.shared import kept

#: Code points within which parts belong together.
SCOPE = 200

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, role, pattern, a cheap test that every match passes, and group with its least length.
PARTS = [
    ("assign", "secret", _ASSIGN, None, (2, 6)),
    ("access", "identifier", r"AKIA[A-Z0-9]{16,}", "AKIA", None),
    ("hex", "secret", r"[0-9a-f]{24,}", None, None),
    ("account", "identifier",
     r"""(?i)(?<![a-z0-9_])(user(?:name|_id)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[a-z0-9._@-]{3,}""",
     None, None),
    ("material", "secret", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_=-])", None,
     None),
    ("endpoint", "endpoint", r"""(?i)(?<![a-z0-9])[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{3,}""", "://", None),
]
STRONG = ("assign", "access", "hex")
#: A weak kind is reported when a part of one of these roles is near.
COMPLEMENTS = {"account": ("secret",), "material": ("identifier", "endpoint"), "endpoint": ("secret",)}

_FOUND = "array<struct<kind:int,no:int,gap:int,len:int,valid:boolean>>"


def _matches(text: Column, kind: int) -> Column:
    """Leftmost matches of a kind, each with the number of code points since the match before."""
    _, _, pattern, literal, group = PARTS[kind]
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group[0])) if group else hits
    made = F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("no"), x["gap"].alias("gap"), F.char_length(x["hit"]).alias("len"),
        (F.char_length(x["value"]) >= (group[1] if group else 0)).alias("valid")))
    some = text.rlike(pattern) if literal is None else F.contains(text, F.lit(literal)) & text.rlike(pattern)
    return F.when(some, F.filter(made, lambda m: m["len"].isNotNull())).otherwise(F.array().cast(_FOUND))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE,
         carry: list[str] | None = None) -> DataFrame:
    """Every document row with ``spans``: (begin, kind order, kind, end, strong), ordered.

    Positions are code points, ends exclusive. A null or empty text has no
    spans. Matches of one kind do not overlap; those of different kinds may.
    Repeated rows each get their spans. ``carry`` names the columns to keep
    (``doc_id`` alone when None); a kept column named ``spans`` is replaced.
    """
    own = [c for c in (carry or [doc_id]) if c != "spans"]
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    row = F.md5(F.concat(F.coalesce(docs[doc_id].cast("string"), F.lit("-")), F.lit("\n"), body))
    table = kept(docs.select(*[docs[c] for c in own], row.alias("__row"),
                             F.concat(*[_matches(body, k) for k in range(len(PARTS))]).alias("__found")), "secrets")
    spans = linked(parts(table), scope).groupBy("__row").agg(F.array_sort(F.collect_list(F.struct(
        "begin", "order", "kind", "end", "strong"))).alias("spans"))
    nothing = F.array().cast("array<struct<begin:bigint,order:int,kind:string,end:bigint,strong:boolean>>")
    return table.join(spans, "__row", "left").select(*own, F.coalesce("spans", nothing).alias("spans"))


def parts(table: DataFrame) -> DataFrame:
    """One row per match that holds, with its position; repeated rows count once."""
    single = table.where(F.size("__found") > 0).groupBy("__row").agg(F.first("__found").alias("__found"))
    before = Window.partitionBy("__row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    placed = single.select("__row", F.inline("__found")).select(
        "__row", "kind", "len", "valid", F.sum(F.col("gap").cast("long") + F.col("len")).over(before).alias("end"))
    names = F.array(*[F.lit(p[0]) for p in PARTS])
    roles = F.array(*[F.lit(p[1]) for p in PARTS])
    return placed.where("valid").select(
        "__row", F.col("kind").alias("order"), names[F.col("kind")].alias("kind"), roles[F.col("kind")].alias("role"),
        (F.col("kind") < len(STRONG)).alias("strong"), (F.col("end") - F.col("len")).alias("begin"), "end")


def linked(found: DataFrame, scope: int) -> DataFrame:
    """Strong parts, and weak parts with a complementary part in scope."""
    cell = lambda c: F.floor(c / scope)
    weak = found.where(~F.col("strong")).withColumn(
        "_cell", F.explode(F.sequence(cell(F.col("begin")), cell(F.col("end")))))
    near = found.select(
        F.col("__row").alias("_other"), F.col("role").alias("_role"), F.col("begin").alias("_begin"),
        F.col("end").alias("_end"),
        F.explode(F.sequence(cell(F.col("begin")) - 1, cell(F.col("end")) + 1)).alias("_at"))
    fits = reduce(lambda a, b: a | b, [(F.col("kind") == kind) & F.col("_role").isin(*roles)
                                       for kind, roles in COMPLEMENTS.items()])
    in_scope = (F.col("begin") - F.col("_end") <= scope) & (F.col("_begin") - F.col("end") <= scope)
    joined = weak.join(near, (F.col("__row") == F.col("_other")) & (F.col("_cell") == F.col("_at")) & fits & in_scope,
                       "left_semi").drop("_cell").dropDuplicates(["__row", "order", "begin"])
    return found.where("strong").unionByName(joined)


def listing(spans: Column) -> Column:
    """Spans as text: kind:begin:end, comma-joined, by begin and then kind."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every maximal run of overlapping spans replaced by a mark.

    One pass over the spans: what lies between the end reached so far and the
    next span is kept.
    """
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.array().cast("array<string>").alias("out"))
    step = lambda a, s: F.struct(
        F.greatest(a["upto"], s["end"]).alias("upto"),
        F.when((s["begin"] >= a["upto"]) & (s["end"] > a["upto"]), F.concat(a["out"], F.array(
            F.substr(text, (a["upto"] + 1).cast("int"), (s["begin"] - a["upto"]).cast("int")), F.lit(mark))))
        .otherwise(a["out"]).alias("out"))
    done = F.aggregate(spans, start, step, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substr(text, (a["upto"] + 1).cast("int"), F.char_length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
